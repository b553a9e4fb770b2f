import numpy as np
import pytest
from readings import reading

from wattlake.operators import cleaning, isolation
from wattlake.operators.isolation import ForestParams
from wattlake.plans import ml

PARAMS = ForestParams(trees=40, sample_size=64)


@pytest.fixture(scope="module")
def readings(frame):
    rng = np.random.default_rng(5)
    rows = [
        reading(i, load_percent=float(55 + rng.normal() * 8), temperature_c=float(45 + rng.normal() * 4),
                voltage_kv=float(40 + rng.normal()), power_mw=float(2 + rng.normal() * 0.2))
        for i in range(3000)
    ]
    rows.append(reading(9999, load_percent=100.0, temperature_c=90.0, voltage_kv=28.0, power_mw=9.0, power_factor=0.5))
    return cleaning.add_features(frame(rows)).cache()


def test_samples_are_whole_and_distinct(readings):
    scaled = isolation.feature_matrix(readings)
    samples = isolation.tree_samples(scaled, PARAMS).toPandas()
    assert (samples.groupby("tree").size() == 64).all() and samples["tree"].nunique() == 40
    few = isolation.tree_samples(scaled.limit(50), PARAMS).toPandas()
    assert (few.groupby("tree").size() == 50).all()
    assert not few.duplicated(["tree", "load_percent"]).any()


def test_detection(spark, readings, tmp_path):
    found = ml.run_detection(spark, readings, str(tmp_path), PARAMS).cache()
    flagged = found.filter("anomaly_flag = 1").count() / 3001
    assert abs(flagged - 0.12) < 0.01
    low, high = found.selectExpr("min(anomaly_score_ml)", "max(anomaly_score_ml)").first()
    assert low >= 0 and high <= 1
    outlier = found.filter("event_id = 'EVT-009999'").first()
    assert outlier["anomaly_flag"] == 1 and outlier["anomaly_score_ml"] > 0.95
    assert found.filter("anomaly_flag = 0 AND anomaly_type <> 'Normal'").count() == 0
    loaded = isolation.load(spark, f"{tmp_path}/model")
    again = ml.detect(spark, readings, loaded, f"{tmp_path}/again")
    key = ["event_id", "anomaly_score", "risk_score", "anomaly_type"]
    assert sorted(found.select(key).collect()) == sorted(again.select(key).collect())


def test_model_does_not_depend_on_partitioning(readings):
    one = isolation.fit(readings.coalesce(1), PARAMS).nodes
    many = isolation.fit(readings.repartition(7), PARAMS).nodes
    assert np.array_equal(one[["tree", "node", "feature"]], many[["tree", "node", "feature"]])
    assert np.allclose(one["threshold"], many["threshold"]) and len(one) <= PARAMS.max_nodes()


def test_scores_match_a_direct_walk(spark, readings):
    forest = isolation.fit(readings, PARAMS)
    row = isolation.score_rows(readings, forest).orderBy("event_id").first()
    x = [(row[c] - forest.scaler[f"{c}_mean"]) / forest.scaler[f"{c}_std"] for c in isolation.FEATURE_COLUMNS]
    total = 0.0
    for _, tree in forest.nodes.groupby("tree"):
        tree = tree.set_index("node")
        at = 0
        while tree.loc[at, "feature"] >= 0:
            side = "left" if x[int(tree.loc[at, "feature"])] <= tree.loc[at, "threshold"] else "right"
            at = int(tree.loc[at, side])
        total += tree.loc[at, "path"]
    assert row["iso_score"] == pytest.approx(2 ** (-total / 40 / isolation.average_path(64)))


def walked(tree, x):
    """Path lengths of rows that go down the tree one by one."""
    feature, threshold, left, right, path = tree
    out = []
    for row in x:
        at = 0
        while feature[at] >= 0:
            at = left[at] if row[feature[at]] <= threshold[at] else right[at]
        out.append(path[at])
    return np.array(out)


def random_tree(rng, inner, features):
    """A tree of any shape, with equal thresholds among its nodes."""
    nodes, open_leaves = [[-1, 0.0, -1, -1]], [0]
    for _ in range(inner):
        at = open_leaves.pop(rng.integers(len(open_leaves)))
        nodes[at] = [int(rng.integers(features)), float(rng.integers(-8, 9)) / 4, len(nodes), len(nodes) + 1]
        open_leaves += [len(nodes), len(nodes) + 1]
        nodes += [[-1, 0.0, -1, -1], [-1, 0.0, -1, -1]]
    columns = [np.array(c) for c in zip(*nodes, strict=True)]
    return (*columns, rng.random(len(nodes)))


@pytest.mark.parametrize("thresholds", [1 << 14, 40])
def test_leaves_looked_up_are_those_walked_to(monkeypatch, thresholds):
    """Trees of one leaf, of one word, of several and of too many; rows at thresholds, infinite and undefined."""
    monkeypatch.setattr(isolation, "BLOCK_THRESHOLDS", thresholds)
    rng = np.random.default_rng(6)
    trees = [random_tree(rng, inner, 3) for inner in (0, 1, 2, 30, 63, 64, 100, 255, 256, 300, 5, 127)]
    x = np.concatenate([rng.integers(-9, 10, (300, 3)) / 4, rng.standard_normal((300, 3)) * 2])
    x[:6] = [[np.inf] * 3, [-np.inf] * 3, [np.nan] * 3, [np.nan, 0, 1], [0, np.inf, -1], [0.0, -0.0, 0.0]]
    ready = [isolation.looked_up(t) for t in trees]
    assert [len(t) for t in ready] == [2] * 8 + [5, 5, 2, 2]
    got = [path for part in isolation.path_lengths(ready) for path in part(x)]
    assert len(got) == len(trees)
    for tree, path in zip(trees, got, strict=True):
        assert np.array_equal(path, walked(tree, x))


def test_few_steps_for_each_tree(monkeypatch):
    """No step for each level: a deep tree takes as many lookups as a flat one."""
    looks = []

    class Counted(np.ndarray):
        def take(self, *args, **kwargs):
            looks.append(1)
            return np.asarray(self).take(*args, **kwargs)

    def steps(depth):
        n = 2 * depth + 1
        feature, left, right = (np.full(n, -1) for _ in range(3))
        feature[0 : 2 * depth : 2], left[0 : 2 * depth : 2], right[0 : 2 * depth : 2] = 0, np.arange(1, n, 2), np.arange(2, n, 2)
        tree = (feature, np.arange(n, dtype=float), left, right, np.arange(n, dtype=float))
        ranked, ends = isolation.ruled_out(*tree)
        (part,) = isolation.path_lengths([({f: (own, masks.view(Counted)) for f, (own, masks) in ranked.items()}, [e.view(Counted) for e in ends])])
        looks.clear()
        assert np.array_equal(next(part(np.array([[-1.0], [0.5], [99.0]]))), walked(tree, np.array([[-1.0], [0.5], [99.0]])))
        return len(looks)

    assert steps(60) == steps(2)
