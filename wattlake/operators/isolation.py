"""Isolation forest: sample, grow, score, flag.

Sampling and growing handle a number of rows fixed by the model (trees times rows per
tree), whatever the size of the data.  Scoring is one pass over the data in which only
the feature columns cross to Python, batch by batch; where a row ends in a tree is looked up by the ranks of its
features among the thresholds, a few steps for each feature instead of some for each level.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattlake.functions.bands import risk_band
from wattlake.functions.labels import anomaly_type_rules
from wattlake.functions.scoring import with_rule_risk
from wattlake.operators.quantiles import exact_quantiles
from wattlake.operators.sampling import smallest_hashes
from wattlake.schema import FEATURE_COLUMNS, NORMAL

NODE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, path double"
BLEND_OLD, BLEND_ML = 0.3, 0.7


@dataclass(frozen=True)
class ForestParams:
    trees: int = 200
    sample_size: int = 256
    contamination: float = 0.12
    seed: int = 42

    def max_nodes(self) -> int:
        """Upper bound on the rows of the node table: a tree over s rows has under 2s nodes."""
        return self.trees * 2 * self.sample_size


# --- features ---------------------------------------------------------------------------------

def feature_expressions() -> dict[str, Column]:
    """Model inputs; null and NaN become 0."""
    return {c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)) for c in FEATURE_COLUMNS}


def feature_matrix(df: DataFrame) -> DataFrame:
    return df.select("event_id", *[e.alias(c) for c, e in feature_expressions().items()])


def scaler_statistics(features: DataFrame) -> DataFrame:
    """One row of mean and population deviation per feature; a constant feature scales by 1."""
    stats = features.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in FEATURE_COLUMNS],
        *[F.stddev_pop(c).alias(f"{c}_std") for c in FEATURE_COLUMNS],
    )
    return stats.withColumns(
        {f"{c}_std": F.when(F.col(f"{c}_std") == 0, 1.0).otherwise(F.col(f"{c}_std")) for c in FEATURE_COLUMNS}
    )


def standardise(features: DataFrame, stats: DataFrame) -> DataFrame:
    scaled = {c: (F.col(c) - F.col(f"{c}_mean")) / F.col(f"{c}_std") for c in FEATURE_COLUMNS}
    return features.crossJoin(F.broadcast(stats)).withColumns(scaled).select(*features.columns)


# --- fit --------------------------------------------------------------------------------------

def tree_samples(features: DataFrame, params: ForestParams) -> DataFrame:
    """(tree, slot, features): ``sample_size`` different rows for every tree.

    The rows with the smallest hashes form a random permutation of at most
    ``trees * sample_size`` rows.  Tree t takes the t-th block of the
    permutation; when the data are fewer than the blocks, the permutation repeats.
    """
    pool = smallest_hashes(features, params.trees * params.sample_size, params.seed)
    ranked = pool.withColumn("_r", F.row_number().over(Window.orderBy("_order", "event_id")) - 1)
    size = pool.agg(F.count(F.lit(1)).cast("int").alias("_n"))
    per_tree = F.least(F.col("_n"), F.lit(params.sample_size))
    placed = ranked.crossJoin(F.broadcast(size)).withColumn(
        "slot", F.explode(F.sequence(F.col("_r"), per_tree * params.trees - 1, F.col("_n")))
    )
    return placed.select(
        (F.floor(F.col("slot") / per_tree)).cast("int").alias("tree"), "slot", *FEATURE_COLUMNS
    )


def average_path(n: int) -> float:
    """Mean depth of an unsuccessful search in a binary tree of ``n`` rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + float(np.euler_gamma)) - 2.0 * (n - 1.0) / n


def _grow(seed: int):
    """Grow one tree from its (bounded) sample; leaves carry their expected path length."""

    def grow(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("slot")
        tree = int(rows["tree"].iloc[0])
        x = rows[FEATURE_COLUMNS].to_numpy(dtype=float)
        rng = np.random.default_rng([seed, tree])
        limit = max(1, math.ceil(math.log2(max(len(x), 2))))
        nodes: list[list] = []
        waiting = [(np.arange(len(x)), 0, -1, "left")]
        while waiting:
            members, depth, parent, side = waiting.pop()
            node = len(nodes)
            if parent >= 0:
                nodes[parent][3 if side == "left" else 4] = node
            part = x[members]
            low, high = part.min(axis=0), part.max(axis=0)
            varying = np.flatnonzero(high > low)
            if depth >= limit or len(members) <= 1 or len(varying) == 0:
                nodes.append([node, -1, 0.0, -1, -1, depth + average_path(len(members))])
                continue
            feature = int(rng.choice(varying))
            threshold = float(rng.uniform(low[feature], high[feature]))
            goes_left = part[:, feature] <= threshold
            nodes.append([node, feature, threshold, -1, -1, 0.0])
            waiting.append((members[~goes_left], depth + 1, node, "right"))
            waiting.append((members[goes_left], depth + 1, node, "left"))
        out = pd.DataFrame(nodes, columns=["node", "feature", "threshold", "left", "right", "path"])
        out.insert(0, "tree", tree)
        return out.astype({"tree": "int32", "node": "int32", "feature": "int32", "left": "int32", "right": "int32"})

    return grow


def fit_trees(samples: DataFrame, params: ForestParams) -> DataFrame:
    """Node table of the forest, one group of at most ``sample_size`` rows per tree."""
    return samples.groupBy("tree").applyInPandas(_grow(params.seed), NODE_SCHEMA)


@dataclass(frozen=True)
class Forest:
    """A fitted model: parameters, scaler statistics and the node table."""

    params: ForestParams
    scaler: dict[str, float]
    nodes: pd.DataFrame
    sample_size: int


def fit(df: DataFrame, params: ForestParams = ForestParams()) -> Forest:
    """Fit scaler and forest.  Two small results reach the driver: one row of statistics and
    the node table, whose size is bounded by the parameters (``ForestParams.max_nodes``)."""
    features = feature_matrix(df)
    stats = scaler_statistics(features)
    statistics = stats.withColumn("n", F.lit(features.agg(F.count(F.lit(1))).scalar())).first().asDict()
    n = int(statistics.pop("n"))
    if n == 0:
        raise ValueError("cannot fit a forest on no rows")
    nodes = fit_trees(tree_samples(standardise(features, stats), params), params).toPandas()
    nodes = nodes.sort_values(["tree", "node"], ignore_index=True)
    return Forest(params, {k: float(v) for k, v in statistics.items()}, nodes, min(n, params.sample_size))


def save(spark: SparkSession, forest: Forest, path: str) -> None:
    """Node table as Parquet, the rest as one JSON row."""
    spark.createDataFrame(forest.nodes, NODE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
    about = {"params": asdict(forest.params), "scaler": forest.scaler, "sample_size": forest.sample_size,
             "features": FEATURE_COLUMNS}
    spark.createDataFrame([(json.dumps(about),)], "model string").withColumn(
        "saved_at", F.current_timestamp()
    ).coalesce(1).write.mode("overwrite").json(f"{path}/about")


def load(spark: SparkSession, path: str) -> Forest:
    about = json.loads(spark.read.schema("model string").json(f"{path}/about").first()["model"])
    nodes = spark.read.parquet(f"{path}/nodes").toPandas().sort_values(["tree", "node"], ignore_index=True)
    return Forest(ForestParams(**about["params"]), about["scaler"], nodes, about["sample_size"])


# --- score ------------------------------------------------------------------------------------

#: Leaves of the trees that are looked up by bits; larger ones are walked.  Thresholds that share a code table.
BIT_LEAVES, BLOCK_THRESHOLDS = 256, 1 << 14


def ruled_out(feature: np.ndarray, threshold: np.ndarray, left: np.ndarray, right: np.ndarray, path: np.ndarray) -> tuple[dict, list]:
    """A tree whose leaves, left to right, are bits: ({feature: (thresholds, leaves left by rank)}, paths), in words of 64.

    A row that is above a node's threshold can't end in the leaves left of it; of the leaves that no node rules out the
    row ends in the leftmost.  The thresholds of one feature that a row is above are those up to some rank, so
    what they rule out together is looked up by that rank.
    """
    leaves, spans, waiting = [], {}, [(0, False)]
    while waiting:
        node, left_done = waiting.pop()
        if feature[node] < 0:
            leaves.append(node)
        elif left_done:
            spans[node] = (spans[node], len(leaves))
            waiting.append((right[node], False))
        else:
            spans[node] = len(leaves)
            waiting += [(node, True), (left[node], False)]
    bit, words = np.arange(len(leaves)), -(-len(leaves) // 64)
    ranked = {}
    for f in sorted({int(feature[n]) for n in spans}):
        own = sorted((n for n in spans if feature[n] == f), key=lambda n: threshold[n])
        kept = np.ones((len(own) + 1, 64 * words), bool)
        for rank, n in enumerate(own, 1):
            kept[rank, : len(bit)] = kept[rank - 1, : len(bit)] & ((bit < spans[n][0]) | (bit >= spans[n][1]))
        ranked[f] = threshold[own], np.packbits(kept, axis=1, bitorder="little").view("<u8")
    return ranked, [path[leaves[64 * w : 64 * w + 64]] for w in range(words)]


def _by_bits(trees: list[tuple[dict, list]]):
    """Function from rows to the path lengths of each tree in turn."""
    features = sorted({f for ranked, _ in trees for f in ranked})
    known = {f: np.unique(np.concatenate([ranked[f][0] for ranked, _ in trees if f in ranked])) for f in features}
    tables = []
    for ranked, ends in trees:
        # leaves left by the rank among all of the block's thresholds, for each word of bits and each feature
        at = {f: np.append(0, np.searchsorted(own, known[f], side="right")) for f, (own, _) in ranked.items()}
        tables.append([([(f, masks[:, w].take(at[f])) for f, (_, masks) in ranked.items()], path) for w, path in enumerate(ends)])

    def paths(x: np.ndarray) -> Iterator[np.ndarray]:
        codes = {f: np.searchsorted(known[f], x[:, f]) for f in features}
        left, more = np.empty(len(x), np.uint64), np.empty(len(x), np.uint64)
        for words in tables:
            out = None
            for masks, path in reversed(words):
                if not masks:
                    out = np.full(len(x), path[0])
                    continue
                masks[0][1].take(codes[masks[0][0]], out=left, mode="clip")
                for f, mask in masks[1:]:
                    np.bitwise_and(left, mask.take(codes[f], out=more, mode="clip"), out=left)
                # the exponent of the lowest bit as a double is its place; no bit at all comes to the first path
                place = (np.bitwise_and(left, np.negative(left, out=more), out=more).astype(np.float64).view(np.int64) >> 52) - 1023
                found = path.take(place, mode="clip")
                out = found if out is None else np.where(left != 0, found, out)
            yield out

    return paths


def _by_walk(feature: np.ndarray, threshold: np.ndarray, left: np.ndarray, right: np.ndarray, path: np.ndarray):
    """Function from rows to the path lengths of one tree, level by level."""

    def paths(x: np.ndarray) -> Iterator[np.ndarray]:
        row, at = np.arange(len(x)), np.zeros(len(x), dtype=np.int32)
        while True:
            f = feature[at]
            inner = f >= 0
            if not inner.any():
                break
            step = np.where(x[row, np.maximum(f, 0)] <= threshold[at], left[at], right[at])
            at = np.where(inner, step, at)
        yield path[at]

    return paths


def looked_up(tree: tuple[np.ndarray, ...]) -> tuple:
    """A tree as ``ruled_out`` has it, if it is small enough, or else as it is."""
    return ruled_out(*tree) if (tree[0] < 0).sum() <= BIT_LEAVES else tree


def path_lengths(trees: list[tuple]) -> list:
    """Functions that give, one after another, the path lengths of all trees of ``looked_up`` in their order."""
    parts, block, held = [], [], 0
    for tree in trees:
        small = len(tree) == 2
        inner = sum(len(own) for own, _ in tree[0].values()) if small else 0
        if block and (not small or held + inner > BLOCK_THRESHOLDS):
            parts.append(_by_bits(block))
            block, held = [], 0
        if small:
            block.append(tree)
            held += inner
        else:
            parts.append(_by_walk(*tree))
    return parts + ([_by_bits(block)] if block else [])


def _scorer(spark: SparkSession, forest: Forest):
    """Arrow function from scaled features to 2^(-mean path / expected path)."""
    trees = []
    for _, t in forest.nodes.groupby("tree", sort=True):
        t = t.sort_values("node")
        trees.append(looked_up(tuple(t[c].to_numpy() for c in ("feature", "threshold", "left", "right", "path"))))
    shared = spark.sparkContext.broadcast(trees)
    expected = average_path(forest.sample_size) or 1.0

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        parts = path_lengths(shared.value)
        for columns in batches:
            x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            depth = np.zeros(len(x))
            for part in parts:
                for path in part(x):
                    depth += path
            yield pd.Series(np.exp2(-depth / (len(shared.value) * expected)))

    return score


def score_rows(df: DataFrame, forest: Forest) -> DataFrame:
    """Add ``iso_score`` in 0-1; higher is more isolated."""
    s = forest.scaler
    scaled = [
        (e - F.lit(s[f"{c}_mean"])) / F.lit(s[f"{c}_std"]) for c, e in feature_expressions().items()
    ]
    return df.withColumn("iso_score", _scorer(df.sparkSession, forest)(*scaled))


def score_bounds(scored: DataFrame, contamination: float = 0.12) -> DataFrame:
    """One row: ``cut``, the exact quantile that leaves ``contamination`` of the rows above it, and both ends."""
    cut = exact_quantiles(scored, ["iso_score"], 1.0 - contamination).select(F.col("iso_score").alias("cut"))
    ends = scored.agg(F.min("iso_score").alias("lo"), F.max("iso_score").alias("hi"))
    return cut.crossJoin(F.broadcast(ends))


def flag_scores(scored: DataFrame, contamination: float = 0.12, bounds: DataFrame | None = None) -> DataFrame:
    """Prediction, flag and 0-1 score from ``iso_score``.

    ``bounds`` is the row of ``score_bounds`` if it is known already.  The normalised score is 1 minus
    the min-max scaled decision value.
    """
    known = score_bounds(scored, contamination) if bounds is None else bounds
    row = known.select(*[F.col(c).alias(f"_{c}") for c in ("cut", "lo", "hi")])
    isolated = F.col("iso_score") > F.col("_cut")
    normal = F.lit(1.0) - (F.col("_hi") - F.col("iso_score")) / (F.col("_hi") - F.col("_lo") + F.lit(1e-10))
    return (
        scored.crossJoin(F.broadcast(row))
        .withColumns(
            {
                "anomaly_prediction": F.when(isolated, -1).otherwise(1),
                "anomaly_flag": isolated.cast("int"),
                "anomaly_score_ml": F.least(F.greatest(normal, F.lit(0.0)), F.lit(1.0)),
            }
        )
        .drop("_cut", "_lo", "_hi", "iso_score")
    )


def blend_scores(df: DataFrame) -> DataFrame:
    """0.3 of the measured score plus 0.7 of the model's; the model's alone if there is no other."""
    ml = F.col("anomaly_score_ml")
    blended = F.col("anomaly_score") * BLEND_OLD + ml * BLEND_ML if "anomaly_score" in df.columns else ml
    return df.withColumn("anomaly_score", blended)


def relabel(df: DataFrame) -> DataFrame:
    """Flagged rows take the rule label, all others Normal."""
    names = ["load_percent", "temperature_c", "voltage_kv", "frequency_hz", "power_factor",
             "communication_latency_ms", "fault_indicator", "event_id"]
    label = anomaly_type_rules(*[F.col(c) for c in names])
    return df.withColumn("anomaly_type", F.when(F.col("anomaly_flag") == 1, label).otherwise(NORMAL))


def rescore(df: DataFrame) -> DataFrame:
    """Rule score with the blended anomaly score, and its band as the new status."""
    return with_rule_risk(df).withColumn("status", risk_band(F.col("risk_score")))


def apply_scores(scored: DataFrame, contamination: float = 0.12, bounds: DataFrame | None = None) -> DataFrame:
    """Everything after scoring: flag, blend, relabel, rescore."""
    return rescore(relabel(blend_scores(flag_scores(scored, contamination, bounds))))


# --- reports ----------------------------------------------------------------------------------

def anomaly_report(detected: DataFrame) -> DataFrame:
    flagged = detected.filter(F.col("anomaly_flag") == 1)
    return flagged.groupBy("anomaly_type", "status").agg(
        F.count("event_id").alias("count"), F.avg("anomaly_score").alias("avg_score"),
        F.avg("risk_score").alias("avg_risk"), F.avg("load_percent").alias("avg_load"),
        F.avg("temperature_c").alias("avg_temp"),
    )


def severity_report(detected: DataFrame) -> DataFrame:
    return detected.groupBy("status").agg(
        F.count("event_id").alias("count"), F.avg("risk_score").alias("avg_risk"),
        F.avg("anomaly_score").alias("avg_score"),
    )


def score_statistics(detected: DataFrame) -> DataFrame:
    return detected.agg(
        F.avg("anomaly_score").alias("mean_score"), F.stddev_samp("anomaly_score").alias("std_score"),
        F.min("anomaly_score").alias("min_score"), F.max("anomaly_score").alias("max_score"),
        (F.avg("anomaly_flag") * 100.0).alias("anomaly_rate"),
    )
