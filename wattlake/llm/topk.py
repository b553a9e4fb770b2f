"""Exact top-k search by inner product: block-at-a-time pruning.

The dimensions are the terms.  Rows in id order are cut into blocks; a block keeps its rows' components
(its forward index) and the largest and smallest component of every dimension.  For a query, the sum
of the larger of query * maximum and query * minimum over the dimensions bounds every score of a
block.  Each query visits its blocks by falling bound and stops as soon as a bound is below its k-th
score; equal bounds are visited, since a smaller id may win a tie.  Queries and blocks meet in tasks of one
group of queries and one shard of blocks; the tasks' winners are ranked together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlake.llm.shared import register, stored, table
from wattlake.llm.vectors import matrix, usable

K = 5
SCALE = 256
QUERY_STEP = 50
BLOCK_ROWS = 256
#: Blocks of a shard and queries of a group, about: what one task holds.
SHARD_BLOCKS, GROUP_QUERIES = 128, 4096
#: Scores and components are 64-bit numbers.
LONG = (1 << 63) - 1


def quantised(raw: np.ndarray) -> np.ndarray:
    scaled = np.floor(SCALE * raw)
    if np.abs(scaled).max(initial=0) >= float(1 << 62):
        raise OverflowError("a component is beyond 64 bits")
    return scaled.astype(np.int64)


def _sums(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows: in doubles where these hold all sums exactly, in whole numbers of any
    size where 64 bits may not."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if top < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T if top < 1 << 61 else a.astype(object) @ b.astype(object).T


def _inner(a: np.ndarray, b: np.ndarray, out: np.ndarray) -> np.ndarray:
    """Scores; where ``out`` holds there is none."""
    sums = _sums(a, b)
    sums[out] = 0
    if sums.dtype == object and sums.size and max(sums.max(), -sums.min()) > LONG:
        raise OverflowError("a score is beyond 64 bits")
    return sums.astype(np.int64)


def _bounds(queries: np.ndarray, blocks: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """No score of a block is larger; bounds beyond 64 bits end there."""
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    sums = _sums(up, np.stack([r.max(0) for _, r in blocks])) + _sums(down, np.stack([r.min(0) for _, r in blocks]))
    return np.clip(sums, -LONG, LONG).astype(np.int64)


def search_blocks(queries: np.ndarray, query_ids: np.ndarray, blocks: list[tuple[np.ndarray, np.ndarray]], k: int):
    """(scores, ids) of the best ``k`` rows of all blocks per query, best first; unused places have id -1.

    A block is (ids, integer rows).  Rows with the query's own id are left out."""
    n, none = len(queries), np.iinfo(np.int64).min
    scores, ids = np.full((n, k), none), np.full((n, k), -1, np.int64)
    if not blocks:
        return scores, ids, 0
    bound = _bounds(queries, blocks)
    order = np.argsort(-bound, 1, kind="stable")
    live, scored = np.arange(n), 0
    for turn in range(len(blocks)):
        chosen = order[live, turn]
        # an unfilled list has no k-th score and takes whatever comes
        go = (bound[live, chosen] >= scores[live, -1]) | (ids[live, -1] < 0)
        live, chosen = live[go], chosen[go]
        if not len(live):
            break
        for b in np.unique(chosen):
            who = live[chosen == b]
            own_ids, rows = blocks[b]
            own = query_ids[who][:, None] == own_ids[None, :]
            found = _inner(queries[who], rows, own)
            scored += found.size
            found[own] = none
            better = (found >= scores[who, -1:]).any(1)
            who, found = who[better], found[better]
            if not len(who):
                continue
            all_scores = np.concatenate([scores[who], found], 1)
            all_ids = np.concatenate([ids[who], np.where(found == none, -1, np.broadcast_to(own_ids, found.shape))], 1)
            # rows left out come last among all others
            best = np.lexsort((all_ids, -all_scores, all_ids < 0))[:, :k]
            scores[who], ids[who] = np.take_along_axis(all_scores, best, 1), np.take_along_axis(all_ids, best, 1)
    return scores, ids, scored


def _packed(rows: DataFrame, vector: str, most: int) -> DataFrame:
    """Packs of ``most`` rows of one length, in the order of the input: (pack, dims, ids, numbers)."""

    def pack_up(ids: np.ndarray, raw: np.ndarray, name: int) -> pa.RecordBatch:
        numbers = quantised(raw)
        return pa.RecordBatch.from_arrays(
            [pa.array([name], pa.int64()), pa.array([raw.shape[1]], pa.int32()), pa.array([ids.tolist()], pa.list_(pa.int64())), pa.array([numbers.astype("<i8").tobytes()], pa.binary())],
            ["pack", "dims", "ids", "numbers"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, made = TaskContext.get().partitionId() << 32, 0
        held: dict[int, list] = {}
        for batch in batches:
            sizes = np.diff(batch.column(vector).offsets.to_numpy())
            for dims in np.unique(sizes).tolist():
                some = batch.filter(pa.array(sizes == dims))
                ids, raw = some.column("vec_id").to_numpy(), matrix(some.column(vector))
                if dims in held:
                    ids, raw = np.concatenate([held[dims][0], ids]), np.concatenate([held[dims][1], raw])
                at = 0
                while len(ids) - at >= most:
                    yield pack_up(ids[at : at + most], raw[at : at + most], base + made)
                    at, made = at + most, made + 1
                held[dims] = [ids[at:], raw[at:]]
        for ids, raw in held.values():
            if len(ids):
                yield pack_up(ids, raw, base + made)
                made += 1

    return rows.select("vec_id", vector).mapInArrow(run, "pack long, dims int, ids array<long>, numbers binary")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, vector: str = "embedding", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows of ``vectors`` for each row of ``queries``.

    Components become floor(256 * x); the score is their integer inner product, ties go to the smaller
    vec_id.  A row with the query's own vec_id is no candidate, nor is one of another length.  Vectors
    that are null or empty or hold null or non-finite components take no part, nor do rows without
    a vec_id; zero vectors do.  Sums are exact; a component or a score beyond 64 bits raises an error.  Repeated rows are candidates each; of a repeated query id the
    smallest vector asks.  Fewer candidates than ``k`` are all returned.  Other columns are not looked at.
    """
    spark = vectors.sparkSession
    ok = usable(vector) & F.col("vec_id").isNotNull()
    rows = vectors.where(ok).select(F.col("vec_id").cast("long").alias("vec_id"), vector)
    asked = queries.where(ok).select(F.col("vec_id").cast("long").alias("vec_id"), vector).groupBy("vec_id").agg(F.min(vector).alias(vector))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = stored(_packed(rows.repartitionByRange(tasks, "vec_id").sortWithinPartitions("vec_id"), vector, block_rows), "blocks")
    groups = stored(_packed(asked.repartition(max(1, tasks // 4)), vector, GROUP_QUERIES), "queries")
    # as many shards as hold SHARD_BLOCKS blocks each, and as many places for groups as there are groups
    shards, places = max(tasks, -(-blocks.count() // SHARD_BLOCKS)), max(1, groups.count())
    pick = lambda n: F.pmod(F.xxhash64("pack"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    sides = groups.select(pick(places).alias("place"), each(shards).alias("shard"), "dims", "ids", "numbers", F.lit(True).alias("asks"))
    met = blocks.select(each(places).alias("place"), pick(shards).alias("shard"), "dims", "ids", "numbers", F.lit(False).alias("asks"))

    def run(part: pa.Table) -> pa.Table:
        packs = [
            (asks, d, np.asarray(i, np.int64), np.frombuffer(b, "<i8").reshape(-1, d))
            for asks, i, b, d in zip(*(part.column(c).to_pylist() for c in ("asks", "ids", "numbers", "dims")), strict=True)
        ]
        out = [(np.zeros(0, np.int64),) * 3]
        for query_ids, asked_rows, d in [(i, r, d) for asks, d, i, r in packs if asks]:
            scores, ids, _ = search_blocks(asked_rows, query_ids, [(i, r) for asks, of, i, r in packs if not asks and of == d], k)
            q, r = np.nonzero(ids >= 0)
            out.append((query_ids[q], ids[q, r], scores[q, r]))
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, zip(*out, strict=True)), strict=True)))

    found = sides.unionByName(met).groupBy("place", "shard").applyInArrow(run, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = f"""
WITH rows AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM rows q JOIN rows c ON q.vec_id % {QUERY_STEP} = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {K}
"""


@register("op9_topk", SQL)
def op9_topk(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where(F.col("vec_id") % QUERY_STEP == 0))
