"""Quality classifier: a sparse ensemble of rules over text statistics.

Small boosted trees are grown on statistics of labelled texts; every path from a root to a node is a
rule, a conjunction of at most ``depth`` comparisons.  A logistic model with a lasso penalty weighs the
rules and drops most of them.  The rest is compiled into one Spark column expression, so scoring is a
map-only job without Python.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.llm.shared import SPACE, WORD, hash_sample, register, table

#: Labelled rows the model is fitted on, about, at most; chosen by a hash of their id.
SAMPLE = 20_000
#: One of so many folds is held out, the one with remainder 0.
FOLDS = 5
THRESHOLD = 0.3
TREES, DEPTH, BINS, LEAF = 24, 3, 48, 20
PENALTY = 2e-4


def counts(text) -> dict[str, Column]:
    """What is counted in a text; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("double")
    return {
        "chars": F.char_length(text).cast("double"),
        "words": count(WORD),
        "distinct": F.size(F.array_distinct(F.split(F.btrim(text, F.lit(" \t\n\x0b\f\r")), f"{SPACE}+"))).cast("double"),
        "symbols": count(r"[^\p{L}\p{N}\s.,]"),
        "uppers": count(r"\p{Lu}"),
        "digits": count(r"\p{Nd}"),
        "stops": count(r"[.,]"),
        "lines": count(r"\n"),
    }


def statistics(n: dict[str, Column]) -> dict[str, Column]:
    """What the rules look at, from the counts; every value is finite."""
    share = lambda part, whole: part / F.greatest(whole, F.lit(1.0))
    return {
        "words": n["words"],
        "word_length": share(n["chars"], n["words"]),
        "distinct_share": share(F.when(n["words"] > 0, n["distinct"]).otherwise(0.0), n["words"]),
        "symbol_share": share(n["symbols"], n["chars"]),
        "upper_share": share(n["uppers"], n["chars"]),
        "digit_share": share(n["digits"], n["chars"]),
        "stop_share": share(n["stops"], n["words"]),
        "line_share": share(n["lines"], n["words"]),
    }


NAMES = ("words", "word_length", "distinct_share", "symbol_share", "upper_share", "digit_share", "stop_share", "line_share")


def held_out(doc_id) -> Column:
    """Rows never learned from: crc32 of the id as text is divisible by FOLDS; a null id, too."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


Rule = tuple[tuple[int, bool, float], ...]  # (statistic, above, cut): value > cut, or value <= cut


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[tuple[Rule, float], ...] = ()

    def score(self, stats: dict[str, Column]) -> Column:
        """Probability of label 1."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            holds = F.lit(True)
            for k, above, cut in rule:
                value = stats[NAMES[k]]
                holds = holds & (value > cut if above else value <= cut)
            total = total + F.when(holds, weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def grow_tree(bins: np.ndarray, target: np.ndarray, weight: np.ndarray, depth: int) -> list[tuple[tuple, np.ndarray, float]]:
    """(path of (statistic, above, bin), rows, value) of every node but the root; splits maximise the
    fall of the squared error of target / weight."""
    nodes: list[tuple[tuple, np.ndarray, float]] = []

    def gain(t, w):
        return t * t / np.maximum(w, 1e-9)

    def split(rows: np.ndarray, path: tuple) -> None:
        if len(path) == depth or len(rows) < 2 * LEAF:
            return
        t, w = target[rows], weight[rows]
        best = (1e-6, None, None)
        for k in range(bins.shape[1]):
            own = bins[rows, k]
            ct, cw = np.cumsum(np.bincount(own, t, BINS)), np.cumsum(np.bincount(own, w, BINS))
            n = np.cumsum(np.bincount(own, minlength=BINS))
            won = gain(ct, cw) + gain(ct[-1] - ct, cw[-1] - cw) - gain(ct[-1], cw[-1])
            won[(n < LEAF) | (n > len(rows) - LEAF)] = -1
            at = int(won.argmax())
            if won[at] > best[0]:
                best = (won[at], k, at)
        if best[1] is None:
            return
        up = bins[rows, best[1]] > best[2]
        for above in (False, True):
            part, longer = rows[up == above], (*path, (best[1], above, best[2]))
            nodes.append((longer, part, float(target[part].sum() / max(weight[part].sum(), 1e-9))))
            split(part, longer)

    split(np.arange(len(target)), ())
    return nodes


def lasso_logistic(x: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 400) -> tuple[np.ndarray, float]:
    """(weights, intercept) that minimise mean log loss + penalty * sum |weight|, by accelerated proximal steps."""
    n = len(y)
    centre = x.mean(0)
    x = x - centre
    step = 4 * n / max(1e-9, np.linalg.norm(x, 2) ** 2 + n)
    rate = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    w, b = np.zeros(x.shape[1]), float(np.log(rate / (1 - rate)))
    ahead, ahead_b, t = w, b, 1.0
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-np.clip(x @ ahead + ahead_b, -50, 50))) - y
        new = ahead - step * (x.T @ error) / n
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
        new_b = ahead_b - step * error.mean()
        t, last = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead, ahead_b = new + (last - 1) / t * (new - w), new_b + (last - 1) / t * (new_b - b)
        w, b = new, new_b
    return w, float(b - centre @ w)


def fit_rules(values: np.ndarray, labels: np.ndarray, trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY) -> RuleModel:
    """A model for statistics (rows x NAMES) and labels 0/1; with no row 0.5, with one class nearly that class."""
    if not len(labels):
        return RuleModel(0.0)
    y = labels.astype(np.float64)
    rate = float(np.clip(y.mean(), 0.01, 0.99))
    prior = float(np.log(rate / (1 - rate)))
    if y.min() == y.max():
        return RuleModel(round(prior, 6))
    cuts = [np.unique(np.quantile(values[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(values.shape[1])]
    # a share of few rows may lie beyond all inner quantiles, so the larger class's extremes are cuts too
    major = values[y == (y.mean() >= 0.5)]
    cuts = [np.unique(np.concatenate([c, np.quantile(major[:, k], [0.005, 0.995])]))[: BINS - 1] for k, c in enumerate(cuts)]
    bins = np.stack([np.searchsorted(c, values[:, k], "left") for k, c in enumerate(cuts)], 1)
    score, rules = np.full(len(y), prior), {}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        nodes = grow_tree(bins, y - p, np.maximum(p * (1 - p), 1e-3), depth)
        for path, rows, value in nodes:
            rules.setdefault(tuple(sorted(set(path))), rows)
            if len(path) == depth or not any(o[: len(path)] == path and len(o) > len(path) for o, _, _ in nodes):
                score[rows] += 0.3 * np.clip(value, -4, 4)
    paths = list(rules)
    x = np.zeros((len(y), len(paths)))
    for k, path in enumerate(paths):
        x[rules[path], k] = 1
    if not paths:
        return RuleModel(round(prior, 6))
    w, b = lasso_logistic(x, y, penalty)
    kept = [(tuple((k, above, float(cuts[k][at])) for k, above, at in path), round(float(v), 6)) for path, v in zip(paths, w, strict=True) if abs(v) > 1e-4]
    return RuleModel(round(b, 6), tuple(kept))


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, label: str = "quality") -> RuleModel:
    """The model of the labelled rows outside the held-out fold, about ``sample`` doc_ids of them at most.

    Rows without a label or whose doc_id is in no document teach nothing.  A doc_id teaches once for each label it
    has, by the text with the smallest hash if it is repeated, so neither the order of files nor copies matter.
    Only statistics of the text are looked at."""
    chosen = labels.where(F.col(label).isin(0, 1) & ~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("_id"), F.col(label).alias("_label")).distinct()
    chosen = hash_sample(chosen, ["_id"], sample)
    stats = statistics(counts(F.col("text")))
    found = F.struct(F.xxhash64("text").alias("_h"), *[stats[n].alias(n) for n in NAMES])
    rows = (
        documents.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))  # about `sample` rows of two numbers
        .groupBy("_id", "_label").agg(F.min(found).alias("s")).select("_id", "_label", "s.*").drop("_h").collect()
    )
    rows.sort()
    values = np.array([[r[n] for n in NAMES] for r in rows], np.float64).reshape(-1, len(NAMES))
    return fit_rules(values, np.array([r["_label"] for r in rows]))


def score_column(text, model: RuleModel) -> Column:
    """The score as a function of the text.  The counts are bound as one value of a lambda: a filter pushed
    below a projection would count anew for every rule."""
    counted = counts(text)
    bound = F.array(F.struct(*[c.alias(n) for n, c in counted.items()]))
    return F.get(F.transform(bound, lambda n: model.score(statistics({k: n[k] for k in counted}))), F.lit(0))


def score_documents(documents: DataFrame, model: RuleModel, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; null texts are scored as empty ones, repeated
    rows each for itself, and an empty table gives no rows.  Other columns are not looked at."""
    scored = documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_column(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int"))


def keep_good(documents: DataFrame, model: RuleModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``documents`` that the model doesn't reject, with their columns."""
    return documents.where(score_column(F.col("text"), model) >= threshold)


@register("op4_quality")
def op4_quality(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return score_documents(documents, fit(documents, table(spark, sf_dir, "labels")))
