"""Quality classifier: held-out accuracy, labels it may not see, edge rows, the fit itself."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from wattlake.llm import quality
from wattlake.llm.quality import RuleModel, fit, fit_rules, grow_tree, lasso_logistic, score_documents

SF = "/root/testdata/sf0.1"


def made(seed=1, n=400):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [f"word{rng.randrange(500)}" for _ in range(rng.randint(20, 80))]
        bad = i % 4 == 0
        text = " ".join(w + "$$$" if bad and i % 8 else w.upper() if bad else w for w in words)
        rows.append((i, text, 0 if bad else 1))
    return rows


def test_held_out_accuracy(spark):
    documents, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    scored = score_documents(documents, fit(documents, labels)).join(labels, "doc_id").where("held_out")
    right = scored.groupBy("quality").agg(F.avg((F.col("predicted") == F.col("quality")).cast("double")).alias("share")).collect()
    assert {r["quality"] for r in right} == {0, 1} and all(r["share"] > 0.95 for r in right)


def test_edge_rows_and_bounds(spark, documents):
    rows = made()
    labels = spark.createDataFrame([(i, y, "x") for i, _, y in rows] + [(None, 1, "x"), (1, None, "x"), (9999, 0, "x")], "doc_id long, quality int, text string")
    extra = [(1000, None), (1001, ""), (1002, " \n "), (1003, "word " * 60000), (None, "word1 word2"), (5, "again")]
    docs = documents([(i, t) for i, t, _ in rows] + extra)
    model = fit(docs, labels)
    got = score_documents(docs, model).collect()
    assert len(got) == len(rows) + len(extra)
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        assert r["held_out"] == (r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    wrong = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 400 and r["doc_id"] != 5 and r["predicted"] != rows[r["doc_id"]][2]]
    assert len(wrong) <= 4
    assert quality.keep_good(docs, model).columns == docs.columns
    assert quality.keep_good(docs, model).count() == sum(r["predicted"] for r in got)


def test_labels_of_the_held_out_fold_teach_nothing(spark, documents):
    rows = made()
    docs = documents([(i, t) for i, t, _ in rows])
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, _, y in rows]
    schema = "doc_id long, quality int"
    assert fit(docs, spark.createDataFrame([(i, y) for i, _, y in rows], schema)) == fit(docs, spark.createDataFrame(turned, schema))


def test_no_labels_and_no_rows(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert fit(documents([(1, "a")]), none) == RuleModel(0.0)
    one_class = spark.createDataFrame([(i, 1) for i in range(50)], "doc_id long, quality int")
    model = fit(documents([(i, "a b") for i in range(50)]), one_class)
    assert all(r["predicted"] == 1 for r in score_documents(documents([(1, "x"), (2, None)]), model).collect())
    assert score_documents(documents([]), model).collect() == []


def test_compiled_rules_score_as_in_numpy(spark, documents):
    rows = made(3)
    docs = documents([(i, t) for i, t, _ in rows])
    stats = docs.select("doc_id", *[c.alias(n) for n, c in quality.statistics(quality.counts(F.col("text"))).items()]).orderBy("doc_id").collect()
    values = np.array([[r[n] for n in quality.NAMES] for r in stats])
    model = fit_rules(values, np.array([y for _, _, y in rows]))
    total = np.full(len(values), model.intercept)
    for rule, weight in model.rules:
        holds = np.ones(len(values), bool)
        for k, above, cut in rule:
            holds &= values[:, k] > cut if above else values[:, k] <= cut
        total += weight * holds
    got = [r["score"] for r in score_documents(docs, model).orderBy("doc_id").collect()]
    assert np.allclose(got, 1 / (1 + np.exp(-total)))
    assert all(len(rule) <= quality.DEPTH for rule, _ in model.rules)


def test_lasso_is_optimal_and_sparse():
    rng = np.random.default_rng(0)
    x = (rng.random((600, 30)) < 0.4).astype(float)
    y = (rng.random(600) < 1 / (1 + np.exp(-(3 * x[:, 0] - 2 * x[:, 1])))).astype(float)
    w, b = lasso_logistic(x, y, 0.02, 3000)
    slope = x.T @ (1 / (1 + np.exp(-(x @ w + b))) - y) / len(y)
    assert (np.abs(slope) <= 0.02 + 1e-3).all() and np.allclose(slope[w != 0], -0.02 * np.sign(w[w != 0]), atol=1e-3)
    assert w[0] > 0 > w[1] and (w == 0).sum() > 15


def test_tree_paths_hold_for_their_rows():
    rng = np.random.default_rng(1)
    bins = rng.integers(0, 10, (500, 3))
    for path, rows, _ in grow_tree(bins, (bins[:, 0] > 4) - 0.5, np.full(500, 0.25), 3):
        holds = np.ones(500, bool)
        for k, above, at in path:
            holds &= (bins[:, k] > at) == above
        assert sorted(rows) == np.flatnonzero(holds).tolist()


def test_copies_and_the_order_of_files_teach_nothing(spark, documents):
    rng = random.Random(4)
    rows = [(i, " ".join(["word"] * rng.randint(1, 40)) + "." * (i % 3), "a") for i in range(300)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, quality int")
    plain = fit(documents(rows), labels)
    many = rows + [rows[1]] * 20_000
    rng.shuffle(many)
    assert fit(documents(many).repartition(7), labels) == plain == fit(documents(rows[::-1]), labels.union(labels))
