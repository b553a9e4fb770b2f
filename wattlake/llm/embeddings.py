"""Near-duplicate embeddings: a subspace pigeonhole join.

Unit vectors are rotated and split into blocks of ``block_dims`` coordinates.  A pair with a cosine
of c has squared distance 2 - 2c, so in at least one block its squared distance is within the block's
share of that, by dimensions.  Each block is range-joined: a grid over its first ``grid_dims`` coordinates,
of cells twice as wide as the block's range, sends every vector to its own cell and to those of half of the cells around
that its range reaches into.  Candidates are verified by the cosine in double precision, and belong to the first block
that finds them.

Equal vectors are one class.  Links are counted and united where they are found; of each chunk a row for a vector
with links leaves the task, never its pairs.  Cells are dealt in chunks of ``chunk`` vectors; a larger table has larger
chunks, not more for each cell, so the rows sent to tasks grow as the table does until chunks fill a task's memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.graph import components
from wattlake.llm.shared import register, stored, table
from wattlake.llm.vectors import kind_of, matrix, usable

COSINE = 0.95
BLOCK_DIMS, GRID_DIMS, SEED = 16, 2, 5
#: Width of a cell, in ranges.
WIDE = 2
#: Rows of each side that are compared at once.
TILE = 1024
#: A chunk is this share of all vectors, if it is no fewer and no more bytes (of two doubles a component).
SHARES, LEAST_CHUNK, CHUNK_BYTES = 12, 2048, 128 << 20


def rotation(dims: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


class Plan:
    """Blocks of vectors of one length, with their ranges."""

    def __init__(self, dims: int, cosine: float, block_dims: int, grid_dims: int) -> None:
        count = max(1, round(dims / block_dims))
        edges = [dims * k // count for k in range(count + 1)]
        self.blocks = [slice(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        # a little more than the budget, for rounding
        self.budgets = [(2 - 2 * cosine) * (b.stop - b.start) / dims + 1e-9 for b in self.blocks]
        self.grids = [min(grid_dims, b.stop - b.start) for b in self.blocks]
        self.turn = rotation(dims)

    def turned(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        unit = raw / np.sqrt((raw * raw).sum(1))[:, None]
        return unit, unit @ self.turn.T


def _unite(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest row that each row and each column of a boolean matrix is connected to (columns: -1 if none)."""
    rows = np.arange(linked.shape[0])
    while True:
        cols = np.where(linked, rows[:, None], linked.shape[0]).min(0)
        new = np.minimum(rows, np.where(linked, cols[None, :], linked.shape[0]).min(1))
        if (new == rows).all():
            return rows, np.where(cols < linked.shape[0], cols, -1)
        rows = new


def _around(grid: int) -> list[tuple[int, ...]]:
    """Half of the steps to the cells around: those whose first non-zero step is up."""
    return [s for s in product((-1, 0, 1), repeat=grid) if s > (0,) * grid]


def _cells(classes: DataFrame, vector: str, cosine: float, block_dims: int, grid_dims: int) -> DataFrame:
    """Every class once for each block, with its grid cell there and, after it, the cells around that its range reaches into."""
    kind, of_id = kind_of(classes, vector), kind_of(classes, "id")

    def reached(turned: np.ndarray, budget: float) -> pa.Array:
        """The cells of each row, a list of lists."""
        n, grid = turned.shape
        at = turned / (WIDE * np.sqrt(budget))
        cell = np.floor(at)
        below = at - cell
        to, near = [cell], [np.ones(n, bool)]
        for step in np.array(_around(grid)):
            gap = np.where(step > 0, 1 - below, np.where(step < 0, below, 0))
            to.append(cell + step)
            # a little more than the range, for rounding
            near.append((gap * gap).sum(1) * WIDE * WIDE <= 1 + 1e-6)
        keep = np.stack(near, 1)
        some = np.stack(to, 1)[keep].astype(np.int32)
        each = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1) * grid, pa.int32()), pa.array(some.ravel()))
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(keep.sum(1))]), pa.int32()), each)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plans: dict[int, Plan] = {}
        for batch in batches:
            sizes = np.diff(batch.column(vector).offsets.to_numpy())
            for dims in np.unique(sizes):
                some = batch.filter(pa.array(sizes == dims)) if (sizes != dims).any() else batch
                plan = plans.setdefault(int(dims), Plan(int(dims), cosine, block_dims, grid_dims))
                turned, n = plan.turned(matrix(some.column(vector)))[1], len(some)
                for b, (block, budget, grid) in enumerate(zip(plan.blocks, plan.budgets, plan.grids, strict=True)):
                    yield pa.RecordBatch.from_arrays(
                        [
                            some.column("id"), some.column("weight"), some.column(vector), pa.array(np.full(n, dims, np.int32)),
                            pa.array(np.full(n, b, np.int32)), reached(turned[:, block.start : block.start + grid], budget),
                        ],
                        ["id", "weight", vector, "dims", "block", "cells"],
                    )

    return classes.select("id", "weight", vector).mapInArrow(run, f"id {of_id}, weight long, {vector} {kind}, dims int, block int, cells array<array<int>>")


class Side:
    """Vectors of one task on one side of its pairs, in double precision and, for the first look, in single."""

    def __init__(self, plan: Plan, block: int, ids: pa.Array, weight: np.ndarray, raw: np.ndarray) -> None:
        self.ids, self.weight = ids, weight
        self.unit, self.turned = plan.turned(raw)
        part = self.turned[:, plan.blocks[block]].astype(np.float32)
        half, one = -0.5 * (part * part).sum(1, keepdims=True), np.ones((len(part), 1), np.float32)
        # the product of one side's row with another's is minus half of their squared distance
        self.left, self.right = np.hstack([part, half, one]), np.hstack([part, one, half])

    def __len__(self) -> int:
        return len(self.weight)


class Home(Side):
    """The side that a task keeps: weight of each row's links, and the smallest row that it is connected to so far."""

    def __init__(self, *args) -> None:
        super().__init__(*args)
        self.n, self.root = np.zeros(len(self), np.int64), np.arange(len(self))

    def unite(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            a, b = self.root[a], self.root[b]
            apart = a != b
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while (self.root != (up := self.root[self.root])).any():
                self.root = up


def _joined(tasks: DataFrame, vector: str, cosine: float, block_dims: int, grid_dims: int) -> DataFrame:
    """(id, n, root): weight of the links found and another id that it is connected to, or its own."""
    of_id = kind_of(tasks, "id")

    def links(plan: Plan, b: int, home: Home, at: int, probe: Side, of: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of a tile of home and probe that are linked and found by no earlier block."""
        budget = plan.budgets[b]
        # single precision is off by less than 1e-5
        close = home.left[at : at + TILE] @ probe.right[of : of + TILE].T >= np.float32(-0.5 * budget - 1e-5)
        h, p = np.divmod(np.flatnonzero(close.ravel()), close.shape[1])
        h, p = h + at, p + of
        if probe is home:
            h, p = h[h > p], p[h > p]
        kept = []
        for k in range(0, len(h), 1 << 16):
            i, j = h[k : k + (1 << 16)], p[k : k + (1 << 16)]
            ok = np.flatnonzero((home.unit[i] * probe.unit[j]).sum(1) >= cosine)
            for block in range(b + 1):
                d = home.turned[i[ok], plan.blocks[block]] - probe.turned[j[ok], plan.blocks[block]]
                ok = ok[((d * d).sum(1) <= plan.budgets[block]) == (block == b)]
            kept.append(k + ok)
        kept = np.concatenate(kept) if kept else np.zeros(0, np.int64)
        return h[kept], p[kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plans: dict[int, Plan] = {}
        now, home, held = None, None, []

        def out(ids, n, root):
            return pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), root], ["id", "n", "root"])

        def settle():
            """All rows of the home side have come: their pairs among each other."""
            nonlocal home, held
            if held:
                ids, w, raw = (pa.concat_arrays([h[0] for h in held]), np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held]))
                home, held = Home(now[0], now[2], ids, w, raw), []
                for of in range(0, len(home), TILE):
                    for at in range(of, len(home), TILE):
                        i, j = links(now[0], now[2], home, at, home, of)
                        if len(i):
                            np.add.at(home.n, i, home.weight[j])
                            np.add.at(home.n, j, home.weight[i])
                            home.unite(i, j)

        def probed(probe: Side):
            n, first = np.zeros(len(probe), np.int64), np.full(len(probe), len(home))
            for of in range(0, len(probe), TILE):
                for at in range(0, len(home), TILE):
                    i, j = links(now[0], now[2], home, at, probe, of)
                    if len(i):
                        np.add.at(home.n, i, probe.weight[j])
                        np.add.at(n, j, home.weight[i])
                        np.minimum.at(first, j, i)
                        home.unite(i, first[j])
            met = np.flatnonzero(first < len(home))
            if len(met):
                yield out(probe.ids.take(pa.array(met)), n[met], home.ids.take(pa.array(first[met])))

        def leave():
            nonlocal home
            settle()
            if home is not None:
                met = np.flatnonzero(home.n)
                if len(met):
                    yield out(home.ids.take(pa.array(met)), home.n[met], home.ids.take(pa.array(home.root[met])))
            home = None

        for batch in batches:
            dims, block = (batch.column(c).to_numpy() for c in ("dims", "block"))
            task, probing = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("task", "probing"))
            new = np.flatnonzero((dims[1:] != dims[:-1]) | (block[1:] != block[:-1]) | (task[1:] != task[:-1]) | (probing[1:] != probing[:-1])) + 1
            for a, z in zip([0, *new.tolist()], [*new.tolist(), len(dims)], strict=True):
                if a == z:
                    continue
                key = (int(dims[a]), int(block[a]), task[a])
                if now is None or now[1:] != (key, key[1]):
                    yield from leave()
                    now = (plans.setdefault(key[0], Plan(key[0], cosine, block_dims, grid_dims)), key, key[1])
                part = batch.slice(a, z - a)
                ids, w, raw = part.column("id"), part.column("weight").to_numpy(), matrix(part.column(vector))
                if not probing[a]:
                    held.append((ids, w, raw))
                    continue
                settle()
                if home is not None:
                    yield from probed(Side(now[0], now[2], ids, w, raw))
        yield from leave()

    return tasks.mapInArrow(run, f"id {of_id}, n long, root {of_id}")


def _chunk(classes: DataFrame, vector: str) -> int:
    """A share of all vectors, so that a row goes to about as many chunks however many there are; bounded by a task's memory."""
    count, dims = classes.agg(F.count(F.lit(1)), F.max(F.size(vector))).first()
    return min(max(LEAST_CHUNK, count // SHARES), max(LEAST_CHUNK, CHUNK_BYTES // (16 * (dims or 1))))


def near_duplicate_vectors(
    vectors: DataFrame, cosine: float = COSINE, vector: str = "embedding", block_dims: int = BLOCK_DIMS, grid_dims: int = GRID_DIMS, chunk: int | None = None
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Linked: a cosine of at least ``cosine``, in double precision.  Vectors that are null, empty or zero or hold
    null or non-finite components are linked with nothing, nor are vectors of different lengths with each
    other.  ``n_links`` counts the other rows linked directly, repeated rows included; ``component_id`` is
    the smallest vec_id reachable; ``kept`` tells whether it is the row's own.  Different vectors are expected to
    have different ids; those that share the smallest id of their copies count as one.  Rows without
    a vec_id are linked with nothing and aren't kept.  Other columns, labels too, are not looked at.
    """
    named = vectors.select("vec_id", vector)
    good = named.where(usable(vector, nonzero=True) & F.col("vec_id").isNotNull())
    classes = stored(good.groupBy(vector).agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("weight")), "vector-classes")
    chunk = chunk or _chunk(classes, vector)
    cells = _cells(classes, vector, cosine, block_dims, grid_dims)
    sizes = cells.groupBy("dims", "block", F.col("cells")[0].alias("to")).agg(F.ceil(F.count(F.lit(1)) / chunk).alias("chunks"))
    sizes = stored(sizes, "cells")
    mine = F.pmod(F.xxhash64("id"), F.col("chunks"))

    # a vector stays in its chunk of its own cell, and meets the chunks before it and all of the cells around
    moved = cells.select("id", "weight", vector, "dims", "block", F.posexplode("cells").alias("step", "to")).join(sizes, ["dims", "block", "to"])
    moved = moved.withColumn("last", F.when(F.col("step") == 0, mine).otherwise(F.col("chunks") - 1)).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), "last")))
    probing = (F.col("step") > 0) | (F.col("chunk") < F.col("last"))
    name = F.concat_ws(",", F.col("to").cast("array<string>"), F.col("chunk").cast("string"))
    tasks = moved.select("dims", "block", name.alias("task"), probing.alias("probing"), "id", "weight", vector)
    keys = ["dims", "block", "task"]
    count = 4 * int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = tasks.repartition(count, *keys).sortWithinPartitions(*keys, "probing", "id")
    found = stored(_joined(tasks, vector, cosine, block_dims, grid_dims), "vector-links")
    sums = found.groupBy("id").agg(F.sum("n").alias("n"))
    united = components(found.where("root IS NOT NULL").select(F.col("id").alias("u"), F.col("root").alias("v")))
    known = classes.join(sums, "id", "left").join(united, "id", "left").select(
        F.col(vector).alias("_vector"), (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "id").alias("component")
    )
    ok = usable(vector, nonzero=True) & F.col("vec_id").isNotNull()
    joined = named.withColumn("_own", F.when(ok, F.col(vector))).join(known, F.col("_own") == F.col("_vector"), "left")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )


SQL = f"""
WITH RECURSIVE unit AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
normed AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM unit WHERE list_dot_product(e, e) > 0),
links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM normed a JOIN normed b ON a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (a.n * b.n) >= {COSINE}),
reach AS (SELECT vec_id, vec_id AS r FROM embeddings UNION SELECT reach.vec_id, v FROM reach JOIN links ON reach.r = u)
SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id) USING (vec_id)
LEFT JOIN (SELECT u AS vec_id, count(*) AS n FROM links GROUP BY u) USING (vec_id)
"""


@register("op3_embedding_dedup", SQL)
def op3_embedding_dedup(spark, sf_dir):
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))
