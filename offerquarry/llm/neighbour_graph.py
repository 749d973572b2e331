"""Approximate nearest neighbours on robust-pruned directed graphs (operator 8).

Distinct vectors are dealt to shards of about ``SHARD`` vectors by a hash.  In each shard
a directed graph is built: batches of vectors search the graph built so far greedily, the
visited vertices become neighbour candidates, and robust pruning keeps a candidate only
if no kept one is closer to it by the factor ``ALPHA``, so edges stay diverse and few.
Back edges are added and overfull vertices are pruned again.  Queries, in blocks, search
every shard by beam search; the best of all shards are ranked.

A shard's graph is a row of a stored table.  Building and searching take one shard (and
one block of queries) at a time, so memory does not depend on the data.

Special cases: vectors that are null, empty, zero or hold null, NaN or infinite values,
and rows without id, take no part; equal vectors are one vertex, which stands for its
``k + 1`` smallest ids (more can never be among the nearest); rows repeated with the same
id and vector count once; vectors of another length than the query's are not compared
(each length has its own shards); fewer candidates than ``k`` are all returned; ties go
to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerquarry.llm.common import read_table
from offerquarry.sources.shared import ship_code, write_and_read

K = 5
SHARD = 2048
DEGREE, BEAM, ALPHA = 32, 64, 1.2
BATCH = 256
QUERY_BLOCK = 1024
QUERY_BEAM = 96


def beam_search(x, edges, start, queries, beam):
    """Greedy search of all ``queries`` at once: nearest vertices found, and visited ones.

    ``x`` holds unit vectors, ``edges`` a row of vertices (or -1) for each.  Returns the
    ids and similarities of the ``beam`` best per query, best first.
    """
    n, q = len(x), len(queries)
    rows = np.arange(q)
    ids = np.full((q, beam), -1)
    sims = np.full((q, beam), -np.inf, np.float32)
    done = np.ones((q, beam), bool)
    ids[:, 0], sims[:, 0], done[:, 0] = start, queries @ x[start], False
    seen = np.zeros((q, n), bool)
    seen[:, start] = True
    while True:
        waiting = ~done
        active = rows[waiting.any(axis=1)]
        if not len(active):
            return ids, sims
        at = waiting[active].argmax(axis=1)  # beams are sorted: the best one not expanded
        done[active, at] = True
        near = edges[ids[active, at]]
        fresh = (near >= 0) & ~seen[active[:, None], near]
        near_sims = np.einsum("qed,qd->qe", x[near], queries[active])
        near_sims = np.where(fresh, near_sims, -np.inf).astype(np.float32)
        seen[active[:, None], np.where(fresh, near, start)] = True
        all_ids = np.hstack([ids[active], np.where(fresh, near, -1)])
        all_sims = np.hstack([sims[active], near_sims])
        all_done = np.hstack([done[active], ~fresh])
        best = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
        ids[active] = np.take_along_axis(all_ids, best, 1)
        sims[active] = np.take_along_axis(all_sims, best, 1)
        done[active] = np.take_along_axis(all_done, best, 1)


def robust_prune(x, vertex, candidates, degree, alpha):
    """Diverse out-neighbours of a vertex, nearest first.

    A candidate goes if a kept neighbour is nearer to it, by the factor ``alpha``, than
    the vertex is.  Distances are squared ones of unit vectors: 2 - 2 * similarity.
    """
    candidates = np.unique(candidates[(candidates >= 0) & (candidates != vertex)])
    if not len(candidates):
        return candidates
    points = x[candidates]
    own = np.maximum(2 - 2 * (points @ x[vertex]), 0)
    order = np.argsort(own, kind="stable")
    candidates, points, own = candidates[order], points[order], own[order]
    between = np.maximum(2 - 2 * (points @ points.T), 0)
    alive, kept = np.ones(len(candidates), bool), []
    for i in range(len(candidates)):
        if alive[i]:
            kept.append(i)
            if len(kept) == degree:
                break
            alive &= alpha * alpha * between[i] > own
    return candidates[kept]


def build(x):
    """Edges of the graph over unit vectors, and the vertex where searches start."""
    n = len(x)
    start = int(np.argmax(x @ x.mean(axis=0)))
    edges = np.full((n, DEGREE), -1)
    random = np.random.default_rng(8)
    for vertex in range(n if n > 1 else 0):  # a sparse random graph to begin with
        near = random.choice(n, min(8, n - 1), replace=False)
        near = near[near != vertex]
        edges[vertex, : len(near)] = near
    for alpha in (1.0, ALPHA):
        order = random.permutation(n)
        for begin in range(0, n, BATCH):
            batch = order[begin : begin + BATCH]
            found, _ = beam_search(x, edges, start, x[batch], min(BEAM, n))
            back: dict[int, list[int]] = {}
            for vertex, ids in zip(batch.tolist(), found):
                kept = robust_prune(x, vertex, np.concatenate([ids, edges[vertex]]), DEGREE, alpha)
                edges[vertex] = -1
                edges[vertex, : len(kept)] = kept
                for other in kept.tolist():
                    back.setdefault(other, []).append(vertex)
            for other, new in back.items():
                own = edges[other][edges[other] >= 0]
                new = np.setdiff1d(np.array(new), own)
                both = np.concatenate([own, new])
                if len(both) > DEGREE:
                    both = robust_prune(x, other, both, DEGREE, alpha)
                edges[other] = -1
                edges[other, : len(both)] = both
    return edges, start


def scaled(vectors):
    """Vectors by powers of two, which keeps angles, so that no square over- or underflows."""
    exponents = np.frexp(np.abs(vectors).max(axis=1, initial=0.0))[1]
    return np.ldexp(vectors, -exponents[:, None])


def unit(vectors):
    vectors = scaled(vectors)
    return (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)


_GRAPH = "shard int, dim int, vectors binary, edges binary, start int, ids array<array<long>>"


def _build_shard(table: pa.Table) -> pa.Table:
    # In an order that does not depend on the shuffle, so that reruns agree.
    table = table.take(pa.array(np.argsort([m[0] for m in table.column("ids").to_pylist()], kind="stable")))
    dim = table.column("dim")[0].as_py()
    vectors = np.array(table.column("vector").to_pylist(), np.float64).reshape(-1, dim)
    edges, start = build(unit(vectors))
    return pa.table(
        {
            "shard": pa.array([table.column("shard")[0].as_py()], pa.int32()),
            "dim": pa.array([dim], pa.int32()),
            "vectors": [vectors.tobytes()],
            "edges": [edges.astype(np.int32).tobytes()],
            "start": pa.array([start], pa.int32()),
            "ids": pa.array([table.column("ids").to_pylist()], pa.list_(pa.list_(pa.int64()))),
        }
    )


def _build_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The graphs of all shards of a partition."""
    batches = [b for b in batches if b.num_rows]
    if batches:
        table = pa.Table.from_batches(batches)
        for shard in table.column("shard").unique():
            yield from _build_shard(table.filter(pc.equal(table.column("shard"), shard))).to_batches()


def usable(rows: DataFrame, id_column: str, vector: str) -> DataFrame:
    """``id, vector`` (doubles) ``, dim`` of the rows that take part, each once."""
    chosen = rows.select(
        F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector")
    ).where("id IS NOT NULL AND size(vector) > 0")
    fit = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    chosen = chosen.where(fit).where(F.exists("vector", lambda v: v != 0))
    return chosen.withColumn("dim", F.size("vector"))


def index(vectors: DataFrame, k: int = K) -> DataFrame:
    """A row per shard with its graph; ``vectors`` as ``usable`` returns them.

    Equal vectors are cut to their smallest ids before the shuffle, so one vector held by
    a third of all rows is no heavier than another.
    """
    ship_code(vectors.sparkSession)
    place = F.dense_rank().over(Window.partitionBy("vector", "dim").orderBy("id"))
    classes = (
        vectors.withColumn("place", place)
        .where(F.col("place") <= k + 1)
        .groupBy("vector", "dim")
        .agg(F.sort_array(F.collect_set("id")).alias("ids"))
    )
    classes = write_and_read(classes, "vectors")
    wanted = F.greatest(F.round(F.count("*") / SHARD), F.lit(1)).cast("long")
    sizes = classes.groupBy("dim").agg(wanted.alias("wanted"))
    before = Window.orderBy("dim").rowsBetween(Window.unboundedPreceding, -1)  # a row per length
    sizes = sizes.select("*", F.coalesce(F.sum("wanted").over(before), F.lit(0)).alias("first"))
    sizes = write_and_read(sizes, "sizes")
    shards = sizes.agg(F.sum("wanted")).first()[0] or 1
    number = F.col("first") + F.pmod(F.xxhash64(F.col("ids")[0], "vector"), F.col("wanted"))
    dealt = classes.join(sizes, "dim").select(number.cast("int").alias("shard"), "dim", "vector", "ids")
    dealt = dealt.repartitionById(shards, F.col("shard"))  # a task for each graph
    return write_and_read(dealt.mapInArrow(_build_shards, _GRAPH), "graphs")


def _search(k: int, beam: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                dim, members = row["dim"], row["ids"]
                vectors = np.frombuffer(row["vectors"]).reshape(-1, dim)
                edges = np.frombuffer(row["edges"], np.int32).reshape(-1, DEGREE)
                ids = [q["id"] for q in row["queries"]]
                queries = np.array([q["vector"] for q in row["queries"]]).reshape(-1, dim)
                width = min(max(beam, k + 1), len(vectors))
                found, _ = beam_search(unit(vectors), edges, row["start"], unit(queries), width)
                out = [[], [], []]
                vectors, queries = scaled(vectors), scaled(queries)
                lengths = np.sqrt((vectors * vectors).sum(axis=1))
                for i, query in enumerate(ids):
                    at = found[i][found[i] >= 0]
                    own = np.sqrt((queries[i] * queries[i]).sum())
                    score = (vectors[at] * queries[i]).sum(axis=1) / (lengths[at] * own)
                    pairs = [(-s, m) for s, a in zip(score.tolist(), at.tolist()) for m in members[a] if m != query]
                    for s, m in sorted(pairs)[:k]:
                        for column, value in zip(out, (query, m, -s)):
                            column.append(value)
                kinds = [pa.int64(), pa.int64(), pa.float64()]
                columns = [pa.array(c, t) for c, t in zip(out, kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])

    return search


def nearest(graphs: DataFrame, queries: DataFrame, k: int = K, beam: int = QUERY_BEAM) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest of each query.

    ``queries`` as ``usable`` returns them, with distinct ids.  Every block of queries
    meets every shard of its length; both are rows of bounded size.
    """
    queries = queries.dropDuplicates(["id"])
    n_blocks = F.greatest(F.lit(1), F.ceil(F.count("*") / QUERY_BLOCK))
    counts = write_and_read(queries.groupBy("dim").agg(n_blocks.cast("long").alias("blocks")), "counts")
    number = F.pmod(F.xxhash64("id"), F.col("blocks"))
    blocks = (
        queries.join(counts, "dim")
        .groupBy("dim", number.alias("block"))
        .agg(F.collect_list(F.struct("id", "vector")).alias("queries"))
    )
    searched = (
        graphs.join(counts, "dim")
        .withColumn("block", F.explode(F.expr("sequence(0L, blocks - 1)")))
        .join(write_and_read(blocks, "blocks"), ["dim", "block"])
        .select("dim", "vectors", "edges", "start", "ids", "queries")
    )
    found = searched.repartition("dim", F.xxhash64("vectors", "queries")).mapInArrow(
        _search(k, beam), "query_id long, vec_id long, score double"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op8_neighbour_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = usable(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return nearest(index(vectors), vectors.where("id % 50 = 0"))
