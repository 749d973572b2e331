"""Vector code compression: product codes trained with norm-of-sum bounds (operator 13).

A vector's components become whole numbers, floor(256 * x), and the vector is cut into
``PARTS`` equal parts.  Each part position has a codebook of at most ``ENTRIES`` entries,
which starts as that part of the smallest vec_ids; a round assigns every part to the
nearest entry and replaces each entry by the mean of its parts.

Most distances of a round need not be computed.  For each part a row keeps its entry, and
for each of ``GROUPS`` groups of entries a lower bound: the distance to the nearest other
entry of the group, with the round in which it was found.  All earlier codebooks are
retained, so a bound of round T is lowered by how far the group's entries really lie from
where they were in round T (the norm of the sum of their moves), not by the sum of the
lengths of their moves, which is never smaller.  Only if the lowered bound does not
exceed the exact distance to the row's own entry is the group scanned again, exactly, in
whole numbers; a tie therefore always leads to a scan, and goes to the lower index.

The rows and their bounds are a stored table per round; the table of the round before is
deleted once the next is written.  Tasks add up their parts by entry before the shuffle,
so codebooks cost a few thousand rows a task.  The driver holds codebooks only: their
size is PARTS * ENTRIES entries for each round, whatever the data.

Special cases: rows whose vector is null or holds null or non-finite components are
dropped, and so are vectors that cannot be cut like the first one: those of another
length, or any if ``PARTS`` does not divide it.  A null vec_id comes after all others when
the first codebook is taken; rows with equal ids are taken in the order of their vectors,
and each row has its own result.  Fewer than ``ENTRIES`` rows make smaller codebooks.
Components are held within +-2^27, so that errors fit in a long.  No rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerquarry.llm.common import read_table
from offerquarry.sources.shared import drop_stored, ship_code, write_and_read

PARTS = 16
ENTRIES = 64
ROUNDS = 2
GROUPS = 4
SCALE = 256
MOST = 1 << 27

_EXACT = 1 << 52  # sums of products below this are exact in doubles


def whole(values: np.ndarray) -> np.ndarray:
    """Components as whole numbers."""
    return np.clip(np.floor(values.astype(np.float64) * SCALE), -MOST, MOST).astype(np.int64)


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``x`` to all entries."""
    largest = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * x.shape[1] * largest * largest < _EXACT:
        a, b = x.astype(np.float64), entries.astype(np.float64)
        sums = (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]
        return sums.astype(np.int64)
    result = np.zeros((len(x), len(entries)), np.int64)
    for at in range(x.shape[1]):
        result += (x[:, at, None] - entries[None, :, at]) ** 2
    return result


def _downwards(values: np.ndarray) -> np.ndarray:
    """Doubles as floats that are not larger."""
    short = values.astype(np.float32)
    return np.where(short > values, np.nextafter(short, np.float32(-np.inf)), short)


def groups_of(entries: int) -> list[np.ndarray]:
    """Neighbouring indexes; the last groups are empty if there are few entries."""
    return np.array_split(np.arange(entries), GROUPS)


def net_moves(history: list[np.ndarray]) -> np.ndarray:
    """For each earlier round and group: the longest way of an entry from then to now.

    ``history`` holds the codebook (entries x components) of each round.
    """
    now = history[-1].astype(np.float64)
    ways = [np.sqrt(((now - then) ** 2).sum(1)) * (1 + 1e-9) for then in history]
    return np.array([[w[g].max(initial=0.0) for g in groups_of(len(now))] for w in ways])


def reassigned(
    x: np.ndarray, codes: np.ndarray, bounds: np.ndarray, stamps: np.ndarray, history: list[np.ndarray]
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Assign parts to the newest codebook of ``history``, scanning where bounds fail.

    Returns codes, bounds, stamps, exact squared distances and how many distances to
    entries were computed beyond those to the rows' own entries.
    """
    entries, now, rows = history[-1], len(history) - 1, np.arange(len(x))
    own = ((x - entries[codes]) ** 2).sum(1)
    lowered = bounds - net_moves(history)[stamps, np.arange(GROUPS)]
    best, nearest, scanned = own.copy(), codes.astype(np.int64), 0
    near = np.full((len(x), GROUPS), np.inf)  # nearest entry of a scanned group, squared
    second = near.copy()
    first = np.full((len(x), GROUPS), -1)
    failed = lowered <= np.sqrt(own.astype(np.float64))[:, None] * (1 + 1e-9)
    for g, members in enumerate(groups_of(len(entries))):
        at = np.flatnonzero(failed[:, g])
        if not len(members) or not len(at):
            continue
        distances = squared(x[at], entries[members])
        scanned += distances.size
        place = distances.argmin(1)
        here = np.arange(len(at))
        least = distances[here, place]
        closer = (least < best[at]) | ((least == best[at]) & (members[place] < nearest[at]))
        best[at[closer]], nearest[at[closer]] = least[closer], members[place[closer]]
        near[at, g], first[at, g] = least, members[place]
        rest = distances.astype(np.float64)
        rest[here, place] = np.inf
        second[at, g] = rest.min(1)
    # A bound is about the entries of a group other than the row's own.
    found = np.sqrt(np.where(first == nearest[:, None], second, near)) * (1 - 1e-9)
    group_of = np.repeat(np.arange(GROUPS), [len(g) for g in groups_of(len(entries))])
    old = group_of[codes]
    left = (nearest != codes) & ~failed[rows, old]  # the old entry becomes one of the others
    new_bounds = np.where(failed, _downwards(found), bounds)
    new_stamps = np.where(failed, now, stamps)
    at = np.flatnonzero(left)
    both = np.minimum(lowered[at, old[at]], np.sqrt(own[at].astype(np.float64)) * (1 - 1e-9))
    new_bounds[at, old[at]], new_stamps[at, old[at]] = _downwards(both), now
    return nearest, new_bounds, new_stamps, best, scanned


def _vectors(column: pa.Array, length: int) -> np.ndarray:
    return whole(column.flatten().to_numpy(zero_copy_only=False)).reshape(len(column), length)


def _round(batches: Iterator[pa.RecordBatch], histories: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """One assignment of all parts; ``histories`` by part position."""
    width = histories[0][0].shape[1]
    first = len(histories[0]) == 1
    parts = len(histories)
    for batch in batches:
        n = batch.num_rows
        x = _vectors(batch.column("embedding"), width * parts)
        if first:
            codes = np.zeros((n, parts), np.uint8)
            bounds = np.full((n, parts, GROUPS), -np.inf, np.float32)
            stamps = np.zeros((n, parts, GROUPS), np.uint8)
        else:
            codes, bounds, stamps = (
                np.frombuffer(b"".join(batch.column(name).to_pylist()), kind).reshape(n, parts, *shape)
                for name, kind, shape in (("codes", np.uint8, ()), ("bounds", "<f4", (GROUPS,)), ("stamps", np.uint8, (GROUPS,)))
            )
        out = [[], [], []]
        error, scanned = np.zeros(n, np.int64), 0
        for p, history in enumerate(histories):
            part = x[:, p * width : (p + 1) * width]
            *state, best, more = reassigned(part, codes[:, p], bounds[:, p], stamps[:, p], history)
            for kept, new in zip(out, state):
                kept.append(new)
            error += best
            scanned += more
        packed = [
            np.stack(kept, 1).astype(kind)
            for kept, kind in zip(out, (np.uint8, "<f4", np.uint8))
        ]
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(name) for name in ("vec_id", "label", "embedding")),
                *(pa.array([row.tobytes() for row in kept], pa.binary()) for kept in packed),
                pa.array(error),
                pa.array(np.full(n, scanned / max(n, 1))),
            ],
            ["vec_id", "label", "embedding", "codes", "bounds", "stamps", "error", "scanned"],
        )


def _sums(batches: Iterator[pa.RecordBatch], parts: int, entries: int, length: int) -> Iterator[pa.RecordBatch]:
    """Sums and numbers of the parts of each entry, once for each task."""
    width = length // parts
    totals, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
    for batch in batches:
        n = batch.num_rows
        x = _vectors(batch.column("embedding"), length).reshape(n, parts, width)
        codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(n, parts)
        for p in range(parts):
            np.add.at(totals[p], codes[:, p], x[:, p])
            counts[p] += np.bincount(codes[:, p], minlength=entries)
    used = np.argwhere(counts > 0)
    sums = pa.FixedSizeListArray.from_arrays(pa.array(totals[counts > 0].ravel()), width).cast(pa.list_(pa.int64()))
    columns = [pa.array(used[:, 0]), pa.array(used[:, 1]), sums, pa.array(counts[counts > 0])]
    yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "sums", "n"])


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vec_id, label, embedding`` of the rows whose components are all finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kind = vectors.schema[vector].dataType.simpleString()
    kept = vectors.where(F.col(vector).isNotNull() & ~bad)
    return kept.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").alias("label"),
        F.col(vector).cast(kind if kind == "array<float>" else "array<double>").alias("embedding"),
    )


def train_and_encode(
    vectors: DataFrame, vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[DataFrame, list[np.ndarray]]:
    """Codes of all rows, and the final codebook of each part position.

    The rows are ``vec_id, label, embedding, codes`` (a byte for each part), ``error``
    and ``scanned``, the mean number of distances that the last assignment computed for
    a row of the batch besides those to the rows' own entries.
    """
    spark = vectors.sparkSession
    ship_code(spark)
    rows = usable(vectors, vector)
    seeds = rows.orderBy(F.col("vec_id").asc_nulls_last(), "embedding")
    length = len((seeds.select("embedding").first() or [[]])[0])
    if length == 0 or length % parts:
        empty = rows.where("false").selectExpr("*", "cast(null AS binary) codes", "0L error", "0D scanned")
        return empty, []
    rows = rows.where(F.size("embedding") == length)
    seeds = seeds.where(F.size("embedding") == length).select("embedding").limit(entries).collect()
    start = whole(np.array([r[0] for r in seeds], np.float64)).reshape(len(seeds), parts, length // parts)
    histories = [[start[:, p].copy()] for p in range(parts)]
    label = rows.schema["label"].dataType.simpleString()
    element = rows.schema["embedding"].dataType.simpleString()
    state = f"vec_id long, label {label}, embedding {element}, codes binary, bounds binary, stamps binary, error long, scanned double"

    def assigned(table: DataFrame) -> DataFrame:
        known = [list(h) for h in histories]
        return table.mapInArrow(lambda batches: _round(batches, known), state)

    table, before = write_and_read(assigned(rows), "assigned"), None
    for done in range(1, rounds + 1):
        if before is not None:
            drop_stored(spark, before)
        n = len(seeds)
        sums = table.select("embedding", "codes").mapInArrow(
            lambda batches: _sums(batches, parts, n, length), "part long, entry long, sums array<long>, n long"
        )
        each = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(length // parts)]
        means = sums.groupBy("part", "entry").agg(*each, F.sum("n").alias("n"))
        books = [h[-1].copy() for h in histories]
        for part, entry, *totals, count in means.collect():  # PARTS * ENTRIES rows at most
            books[part][entry] = [int(total) // count for total in totals]
        for history, book in zip(histories, books):
            history.append(book)
        before = table
        if done < rounds:
            table = write_and_read(assigned(table), "assigned")
    return assigned(table), [h[-1] for h in histories]


def codebooks_digest(books: list[np.ndarray]) -> str:
    numbers = ",".join(str(v) for book in books for v in book.ravel().tolist())
    return hashlib.sha256(numbers.encode()).hexdigest()


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` for each usable row."""
    found, books = train_and_encode(read_table(spark, sf_dir, "embeddings"))
    code = F.lower(F.hex("codes")).alias("code")
    rows = write_and_read(found.select("vec_id", "label", code, "error"), "codes")
    by_label = rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return rows.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256")
    )


def _oracle() -> str:
    """The same by plain rounds that compute all distances."""
    steps = []
    for r in range(ROUNDS + 1):
        distance = "list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
        steps.append(f"""
nearest{r} AS (
    SELECT r, part, (arg_min(entry, d * {ENTRIES} + entry))::BIGINT AS entry, min(d)::BIGINT AS d
    FROM (SELECT p.r, p.part, b.entry, {distance} AS d
          FROM parts p JOIN book{r} b ON p.part = b.part)
    GROUP BY r, part
)""")
        if r < ROUNDS:
            steps.append(f"""
means{r} AS (
    SELECT part, entry, list(v ORDER BY pos) AS x
    FROM (SELECT part, entry, pos, floor(sum(v)::DECIMAL(38, 0) / count(*))::BIGINT AS v
          FROM (SELECT n.part, n.entry, unnest(range(1, len(p.x) + 1)) AS pos, unnest(p.x) AS v
                FROM nearest{r} n JOIN parts p ON n.r = p.r AND n.part = p.part)
          GROUP BY part, entry, pos)
    GROUP BY part, entry
), book{r + 1} AS (
    SELECT b.part, b.entry, coalesce(m.x, b.x) AS x
    FROM book{r} b LEFT JOIN means{r} m ON b.part = m.part AND b.entry = m.entry
)""")
    return f"""
WITH kept AS (
    SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
           list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS x
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
    SELECT r, part, x[part * (len(x) // {PARTS}) + 1 : (part + 1) * (len(x) // {PARTS})] AS x
    FROM kept, (SELECT unnest(range({PARTS})) AS part)
), book0 AS (
    SELECT part, r - 1 AS entry, x FROM parts WHERE r <= {ENTRIES}
),{",".join(steps)},
coded AS (
    SELECT r, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
    FROM nearest{ROUNDS} GROUP BY r
), digest AS (
    SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, pos)) AS codebooks_sha256
    FROM (SELECT part, entry, unnest(range(1, len(x) + 1)) AS pos, unnest(x) AS v FROM book{ROUNDS})
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), digest"""


ORACLE = _oracle()
