"""Shapley values of trees against their definition, searches within budgets, experiments, and folds by brute force."""

import itertools
import json
import random
from math import factorial

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lociq.operators import learning as ln
from lociq.operators import search as sr
from lociq.operators import shapley as sh

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(4)
    out = []
    for k in range(900):
        x = [r.random(), float(r.randrange(4)), r.gauss(0, 1), r.random()]
        out.append((k, *x, float(x[0] * 2 + (x[1] == 2) + x[2] * (x[0] > 0.5) + r.gauss(0, 0.4) > 1.2), k % 5, "uv"[k % 2], f"g{k % 23}"))
    return spark.createDataFrame(out, "id long, a double, b double, c double, d double, label double, fold int, kind string, grp string").cache()


def expected(root, value, x, known):
    """The margin of a tree given some features, by its definition: unknown ones go both ways by the rows' shares."""
    if root.getClass().getSimpleName() == "LeafNode":
        return value(root)
    f, t = root.split().featureIndex(), root.split().threshold()
    left, right = root.leftChild(), root.rightChild()
    if f in known:
        return expected(left if x[f] <= t else right, value, x, known)
    total = root.impurityStats().count()
    return sum(n.impurityStats().count() / total * expected(n, value, x, known) for n in (left, right))


def brute(trees, weights, value, x, n):
    phi = np.zeros(n)
    margin = lambda s: sum(w * expected(t._java_obj.rootNode(), value, x, s) for t, w in zip(trees, weights, strict=True))
    for i in range(n):
        rest = [j for j in range(n) if j != i]
        for k in range(n):
            for s in itertools.combinations(rest, k):
                phi[i] += factorial(k) * factorial(n - 1 - k) / factorial(n) * (margin({*s, i}) - margin(set(s)))
    return phi, margin(set())


@pytest.mark.parametrize("kind", ["boosted", "forest", "tree"])
def test_shapley_values(spark, rows, kind):
    estimator = {"boosted": GBTClassifier(maxIter=4, maxDepth=3, seed=1), "forest": RandomForestClassifier(numTrees=4, maxDepth=4, seed=1), "tree": DecisionTreeClassifier(maxDepth=5, seed=1)}[kind]
    model = ln.pipeline(NAMES, estimator).fit(rows)
    last = model.stages[-1]
    out = sh.tree_attributions(model, model.transform(rows).select("id", *NAMES, vector_to_array("rawPrediction" if kind == "boosted" else "probability")[1].alias("margin")), NAMES, rows=100)
    got = {r["id"]: r for r in out.collect()}
    assert len(got) == 900
    for r in got.values():
        assert r["phi_0"] + sum(r[f"phi_{f}"] for f in NAMES) == pytest.approx(r["margin"], abs=1e-9)
    trees = getattr(last, "trees", None) or [last]
    weights = last.treeWeights if kind == "boosted" else [1 / len(trees)] * len(trees)
    value = (lambda n: n.prediction()) if kind == "boosted" else (lambda n: n.impurityStats().stats()[1] / sum(n.impurityStats().stats()))
    scaled = {r["id"]: r["x"] for r in model.transform(rows.where("id < 4")).select("id", vector_to_array("features").alias("x")).collect()}
    for i, x in scaled.items():
        phi, base = brute(trees, weights, value, x, 4)
        assert [got[i][f"phi_{f}"] for f in NAMES] == pytest.approx(phi.tolist(), abs=1e-9) and got[i]["phi_0"] == pytest.approx(base, abs=1e-9)


def test_shapley_values_ask_leaves_once_for_rows_alike(monkeypatch):
    """Rows between the same limits are one kind, whatever their number; each row's values are those of its own."""
    leaves = [sh.Leaf(1.5, {0: sh.Step(high=0.5, share=0.4), 1: sh.Step(low=2.0, share=0.3)}), sh.Leaf(-2.0, {0: sh.Step(low=0.5, share=0.6)}), sh.Leaf(0.7, {2: sh.Step(among=frozenset([1.0, 4.0]), share=0.2)}), sh.Leaf(3.0)]
    r = np.random.default_rng(5)
    x = np.stack([r.choice([0.1, 0.5, 0.50001, 0.9, np.inf, -np.inf], 5000), r.normal(2, 3, 5000), r.choice([0.0, 1.0, 4.0, 7.0], 5000)], 1)
    x[:50, 1] = np.nan
    asked, own = [], sh.Step.fits
    monkeypatch.setattr(sh.Step, "fits", lambda s, v: (asked.append(len(v)), own(s, v))[1])
    got, base = sh.values(leaves, x)
    assert max(asked) <= 3 * 4 * 4
    one = [sh.values(leaves, x[k : k + 1]) for k in range(0, 5000, 37)]
    assert np.allclose(got[::37], np.concatenate([p for p, _ in one])) and all(b == base for _, b in one)


def test_fit_of_kinds_is_the_fit_of_all_rows(spark, rows):
    """Repeated rows weigh as often as they stand; the estimator sees each kind once."""
    few = rows.select(F.round("a", 1).alias("a"), "b", F.round("c").alias("c"), (F.col("id") % 3).cast("double").alias("d"), "label")
    many = few.unionByName(few.where("label = 1"))
    for e in (GBTClassifier(maxIter=3, maxDepth=3, seed=1), DecisionTreeClassifier(maxDepth=4, seed=1)):
        whole, kinds = ln.pipeline(NAMES, e).fit(many), ln.fit_of_kinds(many, NAMES, e)
        score = lambda m: np.array([r["p"] for r in m.transform(few.orderBy(*NAMES, "label")).select(vector_to_array("probability")[1].alias("p")).collect()])
        assert score(kinds) == pytest.approx(score(whole), abs=1e-9)
        assert not e.isSet("weightCol")
    root = kinds.stages[-1]._java_obj.rootNode().impurityStats()
    assert root.count() == many.count() and root.rawCount() == many.select(*NAMES, "label").distinct().count()


def test_search_is_never_worse_than_the_fixed_candidates(spark, rows):
    train, valid = rows.where("fold > 1"), rows.where("fold = 1")
    found = sr.search(train, valid, NAMES, trials=4, rungs=2, keep=2, seed=5)
    _, _, fixed = ln.tune(train, valid, NAMES, ln.candidates(5))
    assert found.score >= max(fixed.values()) - 1e-9
    assert found.score == pytest.approx(ln.average_precision(found.model.transform(valid)))
    h = found.frame(spark).collect()
    assert [(r["rung"], r["share"]) for r in h] == [(0, 0.5)] * 4 + [(1, 1.0)] * (2 + len(fixed)) and sum(r["best"] for r in h) == 1
    first = [json.loads(r["settings"]) for r in h[:3]]
    assert first == [s.begin() for s in sr.spaces().values()]


def test_search_repeats_and_stops(spark, rows):
    train, valid = rows.where("fold > 1"), rows.where("fold = 1")
    space = {"net": sr.Space(lambda **s: LogisticRegression(maxIter=5, **s, **sr.COMMON), {"regParam": sr.Range(1e-3, 10.0, log=True), "elasticNetParam": sr.Choice([0.0, 1.0])})}
    runs = [[h[:6] for h in sr.search(train, valid, NAMES, space, trials=4, rungs=3, keep=2, always=[], seed=9).history] for _ in range(2)]
    assert runs[0] == runs[1] and [h[1] for h in runs[0]] == [0] * 4 + [1] * 2 + [2]
    short = sr.search(train, valid, NAMES, space, trials=4, rungs=3, keep=2, always=[], seconds=0.0)
    assert [h[1] for h in short.history] == [0] * 4 + [2]
    with pytest.raises(ValueError, match="one label"):
        sr.search(train.where("label = 1"), valid, NAMES, space, trials=1, rungs=1, always=[])


def test_samples_are_nested(rows):
    shares = [{r["id"] for r in sr.nested_sample(rows, s, 3).select("id").collect()} for s in (0.1, 0.3, 1.0)]
    assert shares[0] < shares[1] < shares[2] and len(shares[2]) == 900 and 45 < len(shares[0]) < 140


def test_draws():
    r = random.Random(0)
    whole = [sr.Range(2, 9, log=True, whole=True).draw(r) for _ in range(300)]
    assert set(whole) == set(range(2, 10)) and sr.Range(2, 9).begin() == 2
    assert all(0.01 <= sr.Range(0.01, 1, log=True).draw(r) <= 1 for _ in range(50))


def test_experiment(spark, rows):
    scores, log = sr.experiment(rows, NAMES, "label", "kind", ["u", "v", "w"], where="d < 0.9", trials=2, rungs=1, always=[])
    got = {r["kind"]: r for r in scores.collect()}
    assert set(got) == {"u", "v", "w"} and got["w"]["average_precision"] is None and got["u"]["average_precision"] > 0.6
    assert got["u"]["n"] == rows.where("d < 0.9 and kind = 'u' and fold = 0").count()
    lines = [json.loads(r["line"]) for r in log.collect()]
    assert [x for x in lines if "test" in x][0]["test"] == got["u"]["average_precision"] and [x for x in lines if "skipped" in x][0]["kind"] == "w"
    for bad, what in ((rows.drop("a"), "no columns a"), (rows.withColumn("label", F.lit(2)), "labels: 900"), (rows.withColumn("b", F.when(F.col("id") > 9, F.col("b"))), "b: 10")):
        with pytest.raises(ValueError, match=what):
            sr.experiment(bad, NAMES, "label", "kind", ["u"])


def test_the_tuned_experiment_searches_all_it_can(spark, monkeypatch):
    """No parameter of the query cuts the search: all trials and rungs, and the fixed candidates beside them."""
    from lociq.plans import learning_queries as lq

    budgets = []
    empty = spark.createDataFrame([("low", 1, 1, 0.5, "x")], "kind string, n long, positive long, average_precision double, candidate string")
    monkeypatch.setattr(sr, "experiment", lambda *a, where, **budget: (budgets.append((a[-1], budget)), (empty, None))[1])
    assert lq.m09_tuned(spark, "/root/testdata/sf0.001").count() == 1
    assert budgets == [(["low", "high"], {})]


def test_folds_and_splits(spark, rows):
    f = ln.grouped_folds(rows.drop("fold"), "grp", "label", 4).cache()
    seen = {}
    for r in f.groupBy("grp", "fold").agg(F.sum("label").alias("pos")).collect():
        assert r["grp"] not in seen
        seen[r["grp"]] = (r["fold"], r["pos"])
    load = [sum(p for k, p in seen.values() if k == fold) for fold in range(4)]
    assert len(seen) == 23 and max(load) - min(load) <= max(p for _, p in seen.values())
    train, test = ln.donor_split(f, 0, ["u"], ["v"], "kind")
    assert train.count() == f.where("fold <> 0 and kind = 'u'").count() and test.count() == f.where("fold = 0 and kind = 'v'").count()
    with pytest.raises(ValueError, match="overlap"):
        ln.donor_split(f, 0, ["u"], ["u"], "kind")
    with pytest.raises(ValueError, match="empty"):
        ln.donor_split(f, 0, ["u"], ["x"], "kind")


def test_folds_of_many_groups(rows):
    """Beyond the bound groups are dealt without the driver: whole, and as even."""
    f = ln.grouped_folds(rows.drop("fold"), "id", "label", 4, most=10).groupBy("fold").agg(F.count("*").alias("n"), F.sum("label").alias("pos")).collect()
    assert sum(r["n"] for r in f) == 900 and max(r["n"] for r in f) - min(r["n"] for r in f) <= 1 and max(r["pos"] for r in f) - min(r["pos"] for r in f) <= 1


def test_cross_prediction_uses_the_other_folds(rows):
    """Each row's probability is that of a model fitted without its fold."""
    got = {r["id"]: r["test_proba"] for r in ln.cross_predict(rows.withColumn("fold", F.col("fold") % 2), NAMES, LogisticRegression(maxIter=5), 2).collect()}
    for k in range(2):
        model = ln.pipeline(NAMES, LogisticRegression(maxIter=5)).fit(rows.where(F.col("fold") % 2 != k))
        for r in model.transform(rows.where(F.col("fold") % 2 == k).limit(20)).select("id", vector_to_array("probability")[1].alias("p")).collect():
            assert got[r["id"]] == pytest.approx(r["p"], abs=1e-6)
    assert len(got) == 900


def test_principal_components_and_scaling(spark, rows):
    from pyspark.ml.feature import VectorAssembler

    v = VectorAssembler(inputCols=NAMES, outputCol="x").transform(rows)
    got = np.array([r["pc"].toArray() for r in ln.principal_components(v, "x", 2).transform(v).orderBy("id").select("pc").collect()])
    x = np.array([[r[c] for c in NAMES] for r in rows.orderBy("id").collect()])
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    _, _, vt = np.linalg.svd(z, full_matrices=False)
    assert np.abs(got) == pytest.approx(np.abs(z @ vt[:2].T), abs=1e-6)
    # a scaled elastic net doesn't depend on the features' units
    fit = lambda df: ln.pipeline(NAMES, LogisticRegression(regParam=0.05, elasticNetParam=0.5, maxIter=50)).fit(df).stages[-1].coefficients.toArray()
    assert fit(rows) == pytest.approx(fit(rows.withColumn("c", F.col("c") * 1000 - 7)), abs=1e-4)
