"""Near-duplicate documents by a multi-index Hamming join of MinHash signatures
(operator 1).

A document is its set of word shingles.  Documents with equal sets form one class,
of which only one goes on.  A signature holds ``CHUNKS * CHUNK`` minima of 14 bits
each; the Hamming distance of two signatures counts the places that differ.  By the
pigeonhole principle, signatures that differ in at most ``2 * CHUNKS - 1`` places
have a chunk with at most one error.  So each chunk is indexed under ``CHUNK`` keys,
each leaving out one place: all pairs within that distance share a key.  At a
similarity of 0.8 a place differs with a chance of 0.2, so a pair misses all keys
with a chance of (1 - 0.8^5 - 5 * 0.2 * 0.8^4)^14, less than 1 in 100 million.

Candidates whose signatures differ in at most ``MOST_ERRORS`` places are confirmed on the
full sets; at a similarity of 0.8 more than that has a chance below 1 in a million.
(Up to 27 places the index finds every pair, up to 32 nearly every one.)  Within a key
all members are compared with one of them first; what these links connect need not be
compared again, so a large group of near copies costs one comparison per member, not one
per pair.  Only members that are still unconnected are compared with each other
(``_remaining``): signatures first, then the sets of those that are close to another.

Tables are deleted as soon as no later step reads them, and so are the shuffles behind
them, so the disk holds one step's keys or sets at a time.

Special cases: no words, or a null text, make an empty set, linked with nothing;
fewer words than a shingle has are one shingle; repeated rows are one document; rows
that share an id but not the text are judged each by its own text (the component is
named by the smallest id, the kept row is the one with that id and, of several, the
smallest digest); a row without ``doc_id`` cannot be named, so it belongs to no group and
stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from offerquarry.llm.common import WordHashes, mixed, read_table, shingle_hashes, utf8
from offerquarry.llm.components import components
from offerquarry.operators.dedupe import keep_first
from offerquarry.operators.ordering import with_position
from offerquarry.sources.shared import drop_stored, free_shuffles, ship_code, write_and_read

SHINGLE = 5
SIMILAR = 80  # percent
CHUNKS, CHUNK = 14, 5
MOST_ERRORS = 32
BLOCK = 256
LANES = 18  # longs of four places in 15 bits each, the last two places unused
BITS = 14

_PLACES = np.arange(1, CHUNKS * CHUNK + 1, dtype=np.uint64)
_FACTORS = (mixed(_PLACES * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1))[:, None]
_SHIFTS = mixed(_PLACES * np.uint64(0xD1B54A32D192ED03))[:, None]
_AT_ONCE = 2048
_SHIFT = np.arange(4, dtype=np.uint64) * np.uint64(BITS + 1)
_ONES = np.uint64(sum(((1 << BITS) - 1) << shift for shift in _SHIFT.tolist()))
_SPARE = np.uint64(sum(1 << (shift + BITS) for shift in _SHIFT.tolist()))


def signature(shingles: np.ndarray) -> np.ndarray:
    """BITS of the least hash value of each hash function, packed into LANES longs."""
    least = np.full(len(_PLACES), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), _AT_ONCE):
        block = shingles[None, start : start + _AT_ONCE]
        np.minimum(least, (block * _FACTORS + _SHIFTS).min(axis=1), out=least)
    places = np.zeros(4 * LANES, np.uint64)
    places[: len(least)] = mixed(least) >> np.uint64(64 - BITS)
    return (places.reshape(LANES, 4) << _SHIFT).sum(axis=1, dtype=np.uint64)


def index_keys(signatures: np.ndarray) -> np.ndarray:
    """Keys of all chunks, each with one place left out: a row per signature."""
    places = (signatures[:, :, None] >> _SHIFT) & np.uint64((1 << BITS) - 1)
    places = places.reshape(len(signatures), 4 * LANES)[:, : CHUNKS * CHUNK]
    chunks = places.reshape(-1, CHUNKS, CHUNK)
    keys = np.empty((len(chunks), CHUNKS, CHUNK), np.uint64)
    number = np.arange(CHUNKS, dtype=np.uint64) * np.uint64(CHUNK)
    for left_out in range(CHUNK):
        key = np.zeros(chunks.shape[:2], np.uint64)
        for place in range(CHUNK):
            if place != left_out:
                key = (key << np.uint64(BITS)) | chunks[:, :, place]
        keys[:, :, left_out] = mixed(key) ^ mixed(number + np.uint64(left_out + 1))
    return keys.reshape(len(chunks), -1).view(np.int64)


def _shingles(text: bytes | None, size: int, hashes: WordHashes) -> np.ndarray:
    return shingle_hashes(hashes.of_text((text or b"").lower()), size)  # A-Z only


def _lists(rows: list[np.ndarray]) -> pa.Array:
    """A list column of whole numbers."""
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    values = np.concatenate(rows) if rows else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def described(size: int, text: str = "text") -> Column:
    """Struct of a text: its number of shingles, a digest of the set, a signature."""

    @F.arrow_udf("n long, digest binary, signature array<long>")
    def describe(texts: pa.Array) -> pa.Array:
        hashes, sizes, digests, signatures = WordHashes(), [], [], []
        for text in texts:
            shingles = _shingles(text.as_py(), size, hashes)
            sizes.append(len(shingles))
            digests.append(_digest(shingles))
            signatures.append(signature(shingles).view(np.int64))
        columns = [pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), _lists(signatures)]
        return pa.StructArray.from_arrays(columns, ["n", "digest", "signature"])

    return describe(utf8(text))


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def shingle_set(size: int, text: str = "text") -> Column:
    """Struct of a text: all its shingles as sorted hashes, and their digest."""

    @F.arrow_udf("digest binary, shingles array<long>")
    def shingles(texts: pa.Array) -> pa.Array:
        hashes = WordHashes()
        sets = [_shingles(t.as_py(), size, hashes) for t in texts]
        digests = pa.array([_digest(s) for s in sets], pa.binary())
        lists = _lists([s.view(np.int64) for s in sets])
        return pa.StructArray.from_arrays([digests, lists], ["digest", "shingles"])

    # Else Spark would test the digests of a later join before an earlier semi-join.
    return shingles.asNondeterministic()(utf8(text))


@F.arrow_udf(ArrayType(LongType()))
def _keys(signatures: pa.Array) -> pa.Array:
    lanes = np.ascontiguousarray(signatures.flatten().to_numpy(), np.int64)
    return _lists(list(index_keys(lanes.view(np.uint64).reshape(-1, LANES))))


def _classes(described: DataFrame) -> DataFrame:
    """One row per distinct set: ``node`` (its number), ``doc`` (its smallest doc_id),
    ``digest`` and ``signature``."""
    sets = described.where("doc_id IS NOT NULL AND n > 0")
    classes = sets.groupBy("digest").agg(
        F.min("doc_id").alias("doc"), F.any_value("signature").alias("signature")
    )
    return classes.select(F.monotonically_increasing_id().alias("node"), "doc", "digest", "signature")


def _not_sent(table: DataFrame) -> DataFrame:
    """A table that joins shuffle: Spark takes an array for one item, and ``explode`` for no
    growth, so it may send such a table to the driver and all tasks though it is large."""
    return table.hint("merge")


def _close(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose signatures differ in at most ``MOST_ERRORS`` places."""
    for side in "ab":
        named = nodes.select(F.col("node").alias(side), F.col("signature").alias(f"signature_{side}"))
        pairs = pairs.join(_not_sent(named), side)
    ones, spare = int(_ONES.view(np.int64)), int(_SPARE.view(np.int64))
    differing = F.zip_with(
        "signature_a", "signature_b",
        lambda x, y: F.bit_count(((x.bitwiseXOR(y)) + F.lit(ones)).bitwiseAND(F.lit(spare))),
    )
    total = F.aggregate(differing, F.lit(0), lambda s, d: s + d)
    return pairs.where(total <= MOST_ERRORS).select("a", "b")


def _sets(texts: DataFrame, nodes: DataFrame, needed: DataFrame, size: int) -> DataFrame:
    """``node, shingles`` of the nodes in ``needed``, each once."""
    wanted = write_and_read(nodes.join(needed, "node", "left_semi").select("node", "doc", "digest"), "wanted")
    rows = texts.join(wanted.select(F.col("doc").alias("doc_id")).distinct(), "doc_id", "left_semi")
    found = rows.select(shingle_set(size).alias("s")).select("s.digest", "s.shingles")
    once = found.join(wanted.select("digest", "node"), "digest").groupBy("node")
    return write_and_read(once.agg(F.any_value("shingles").alias("shingles")), "sets")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough.

    Sets travel in blocks of ``BLOCK`` documents that lie side by side when ordered
    by candidate cluster, with the pairs between two blocks: a set in thousands of
    pairs is sent once for each block of partners, not once for each partner; pairs
    within a block need it once.
    """
    spark = pairs.sparkSession
    connected = components(pairs)
    placed = with_position(connected, [F.col("component"), F.col("node")])
    placed = write_and_read(placed.select("node", F.expr("position div %d" % BLOCK).alias("block")), "placed")
    blocks = (
        sets.join(placed, "node")
        .groupBy("block")
        .agg(F.collect_list(F.struct("node", "shingles")).alias("sets"))
    )
    blocks = write_and_read(blocks, "blocks")
    free_shuffles(spark)

    def side(x: str, table: DataFrame, key: str) -> DataFrame:
        return table.select([F.col(c).alias(x if c == key else f"{c}_{x}") for c in table.columns])

    located = pairs.join(side("a", placed, "node"), "a").join(side("b", placed, "node"), "b")
    grouped = located.groupBy("block_a", "block_b").agg(
        F.collect_list(F.struct("a", "b")).alias("pairs")  # at most BLOCK * BLOCK
    )
    grouped = write_and_read(grouped, "grouped")
    none = F.expr("slice(sets_block_a, 1, 0)").alias("sets_block_b")
    first = grouped.join(side("block_a", blocks, "block"), "block_a")
    within = first.where("block_a = block_b").select("pairs", "sets_block_a", none)
    across = first.where("block_a <> block_b").join(side("block_b", blocks, "block"), "block_b")
    both = within.unionByName(across.select("pairs", "sets_block_a", "sets_block_b"))
    links = write_and_read(both.mapInArrow(_compare, "a long, b long"), "confirmed")
    drop_stored(spark, placed, blocks, grouped, connected)
    return links


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of two blocks of sets (no second one: within the first), a row each: yields
    the similar pairs."""
    for batch in batches:
        for row in range(batch.num_rows):
            pairs, *sides = (c.slice(row, 1).flatten() for c in batch.columns)
            found = [[], []]
            of = []
            for side in sides:
                rows = _slices(side.field("shingles"))
                of.append(dict(zip(side.field("node").to_pylist(), rows)))
            of_a, of_b = of[0], of[1] or of[0]
            for a, b in zip(pairs.field("a").to_pylist(), pairs.field("b").to_pylist()):
                if _alike(of_a[a], of_b[b]):
                    found[0].append(a)
                    found[1].append(b)
            yield pa.RecordBatch.from_arrays([pa.array(f, pa.int64()) for f in found], ["a", "b"])


def _alike(x: np.ndarray, y: np.ndarray) -> bool:
    """Are two full sets similar enough?"""
    if 100 * min(len(x), len(y)) < SIMILAR * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= SIMILAR * (len(x) + len(y) - both)


def _slices(lists: pa.ListArray) -> list[np.ndarray]:
    ends, values = lists.offsets.to_numpy(), lists.values.to_numpy()
    return [values[i:j] for i, j in zip(ends[:-1], ends[1:])]


def _remaining(shared: DataFrame, labels: DataFrame, nodes: DataFrame, sets: Callable) -> DataFrame:
    """Links between members of a common key that are not connected yet.

    Members are laid in blocks of ``BLOCK``, those that met the same hub side by side.
    Two blocks (or a block and itself) with a common key meet in one task, which computes
    the distances of all their signatures and names the members that are close to one of
    another component.  Where there are any, their sets follow (``sets`` makes the table
    of those needed) and are compared in one task for the two blocks.  No row is made for
    a pair unless it is a link.
    """
    spark = shared.sparkSession
    component = F.coalesce("component", "node").alias("component")
    members = shared.join(labels, "node", "left").select("key", "node", "hub", component)
    open_keys = members.groupBy("key").agg(
        F.min("component").alias("first"), F.max("component").alias("last")
    )
    open_keys = write_and_read(open_keys.where("first <> last").select("key"), "open_keys")
    members = write_and_read(members.join(open_keys, "key"), "members")
    near = members.groupBy("node").agg(
        F.min("hub").alias("near"), F.min("component").alias("component")
    )
    placed = with_position(near, [F.col("near"), F.col("node")])
    placed = placed.select("node", "component", F.expr(f"position div {BLOCK}").alias("block"))
    placed = write_and_read(placed, "placed")
    described = placed.join(_not_sent(nodes.select("node", "signature")), "node")
    described = write_and_read(described, "described")
    content = F.struct("node", "component", "signature")
    blocks = write_and_read(described.groupBy("block").agg(F.collect_list(content).alias("members")), "blocks")
    places = members.select("key", "node").join(placed, "node").select("key", "block").distinct()
    places = write_and_read(places, "places")
    met = places.withColumnRenamed("block", "a").join(places.withColumnRenamed("block", "b"), "key")
    met = write_and_read(met.where("a <= b").select("a", "b").distinct(), "met")
    drop_stored(spark, members, places, open_keys)
    both = met.join(blocks.toDF("a", "members_a"), "a").join(blocks.toDF("b", "members_b"), "b")
    close = both.select("a", "b", "members_a", "members_b").mapInArrow(_close_members, "a long, b long, nodes array<long>")
    close = write_and_read(close, "close")
    drop_stored(spark, blocks, met)
    asked = close.select("a", "b", F.explode("nodes").alias("node"))
    asked = write_and_read(asked, "asked")
    full = sets(asked.select("node").distinct())
    rows = asked.join(described, "node").join(full, "node")
    content = F.struct("node", "component", "signature", "shingles")
    groups = rows.groupBy("a", "b").agg(F.collect_list(content).alias("sets"))  # two blocks at most
    links = groups.select("sets").mapInArrow(_compare_members, "a long, b long")
    links = write_and_read(links, "more").distinct()
    drop_stored(spark, close, asked, full, placed, described)
    return links


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances of all signatures of two blocks: places that differ.

    Adding all ones to the difference of a place sets its spare bit unless it is 0.
    """
    total = np.zeros((len(a), len(b)), np.uint8)
    for lane in range(LANES):
        differing = (a[:, lane, None] ^ b[None, :, lane]) + _ONES
        total += np.bitwise_count(differing & _SPARE)
    return total


def _signatures(members: pa.StructArray) -> np.ndarray:
    return members.field("signature").flatten().to_numpy().view(np.uint64).reshape(-1, LANES)


def _close_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of two blocks: the members close to one of another component, if any."""
    for batch in batches:
        for row in range(batch.num_rows):
            one, two = (column.slice(row, 1).flatten() for column in batch.columns[2:])
            components_ = [side.field("component").to_numpy() for side in (one, two)]
            close = components_[0][:, None] != components_[1][None, :]
            if close.any():
                close &= distances(_signatures(one), _signatures(two)) <= MOST_ERRORS
            nodes = np.concatenate([one.field("node").to_numpy()[close.any(1)], two.field("node").to_numpy()[close.any(0)]])
            if len(nodes):
                columns = [*batch.slice(row, 1).columns[:2], pa.array([np.unique(nodes)], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["a", "b", "nodes"])


def _compare_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between close members of a group that are of different components."""
    for batch in batches:
        for row in range(batch.num_rows):
            members = batch.column(0).slice(row, 1).flatten()
            nodes, of = members.field("node").to_numpy(), members.field("component").to_numpy()
            signatures, sets = _signatures(members), _slices(members.field("shingles"))
            close = np.triu((of[:, None] != of[None, :]) & (distances(signatures, signatures) <= MOST_ERRORS), 1)
            found = [(nodes[i], nodes[j]) for i, j in np.argwhere(close).tolist() if _alike(sets[i], sets[j])]
            columns = [pa.array(c, pa.int64()) for c in (zip(*found) if found else ((), ()))]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b"])


def _judged(docs: DataFrame, shingle: int) -> tuple[DataFrame, DataFrame]:
    """Described rows (``doc_id, n, digest``), and for each distinct set its ``digest``,
    its component's smallest id and ``first``, the digest of the row that is kept."""
    spark = docs.sparkSession
    ship_code(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    found = texts.select("doc_id", described(shingle).alias("d")).select("doc_id", "d.*")
    found = write_and_read(found, "described")
    nodes = write_and_read(_classes(found), "nodes")
    rows = nodes.select("node", F.explode(_keys("signature")).alias("key"))
    # Keys with several members, and the smallest member, to compare all others with.
    hubs = rows.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("top"))
    hubs = write_and_read(hubs.where("hub <> top").select("key", "hub"), "hubs")
    free_shuffles(spark)
    shared = write_and_read(_not_sent(rows).join(hubs, "key").select("key", "node", "hub"), "shared")
    drop_stored(spark, hubs)

    pairs = shared.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    pairs = write_and_read(_close(pairs.distinct(), nodes), "pairs")
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    sets = _sets(texts, nodes, ends, shingle)  # full sets of candidates only
    free_shuffles(spark)
    links = _confirmed(pairs, sets)
    drop_stored(spark, sets, pairs)
    labels = components(links)
    more = _remaining(shared, labels, nodes, lambda needed: _sets(texts, nodes, needed, shingle))
    if not more.isEmpty():
        labels = components(links.union(more))
    drop_stored(spark, shared)

    of = nodes.join(labels, "node", "left").select(
        "digest", "doc", F.coalesce("component", "node").alias("component")
    )
    of = write_and_read(of, "of")
    least = of.groupBy("component").agg(F.min(F.struct("doc", "digest")).alias("least"))
    classes = of.join(least, "component").select(
        "digest", F.col("least.doc").alias("of_class"), F.col("least.digest").alias("first")
    )
    return found.select("doc_id", "n", "digest"), write_and_read(classes, "classes")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs``."""
    found, classes = _judged(docs, shingle)
    component = F.when(F.col("n") > 0, F.coalesce("of_class", "doc_id")).otherwise(F.col("doc_id"))
    return found.join(classes, "digest", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The rows of ``docs``, one of each group of near duplicates, with all columns.

    Of rows with the same id and the same set one stays; rows without an id or without
    words stay.  Ids that occur once are looked up in a table of ids; only rows with
    repeated ids are looked up by their sets.
    """
    found, classes = _judged(docs, shingle)
    named = found.where("doc_id IS NOT NULL").join(classes, "digest", "left")
    stays = F.col("of_class").isNull() | ((F.col("doc_id") == F.col("of_class")) & (F.col("digest") == F.col("first")))
    by_id = named.groupBy(F.col("doc_id").alias("id")).agg(
        F.count("*").alias("rows"), F.count_if(stays).alias("stay")
    )
    by_id = write_and_read(by_id.where("rows > 1 OR stay = 0"), "by_id")
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.struct("*").alias("row"))
    once = rows.join(by_id.select("id"), "id", "left_anti")
    again = rows.join(by_id.where("rows > 1 AND stay > 0").select("id"), "id", "left_semi")
    again = again.withColumn("text", F.col("row.text")).withColumn("d", shingle_set(shingle))
    again = again.select("id", "row", "text", F.col("d.digest").alias("digest"), F.size("d.shingles").alias("n"))
    empty = again.where("n = 0")
    judged = again.where("n > 0").join(classes, "digest")
    judged = keep_first(judged.where("id = of_class AND digest = first"), ["id"], ["text"])
    return once.select("row.*").unionAll(empty.select("row.*")).unionAll(judged.select("row.*"))


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), shingle=2)
