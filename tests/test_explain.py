"""Exact attributions against enumeration over all subsets; permutations of whole columns; model properties."""

import itertools
import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from citypulse import contract as C
from citypulse.operators import explain, models

COLUMNS = C.NUMERIC_FEATURES + C.CATEGORICAL_FEATURES
SIX = ["hour", "lat", "victim_age", "dow", "area_name", "victim_sex"]


@pytest.fixture(scope="module")
def table(spark):
    """The label hangs on three numbers and two texts; the other columns are constant."""
    h = lambda k, m: F.pmod(F.xxhash64(F.col("dr_no"), F.lit(k)), F.lit(m))
    df = spark.range(3000).select(F.col("id").alias("dr_no"))
    df = df.withColumns({c: F.lit(1.0) for c in C.NUMERIC_FEATURES} | {c: F.lit("same") for c in C.CATEGORICAL_FEATURES})
    df = df.withColumns({"hour": h(1, 24).cast("double"), "lat": h(2, 1000) / 1000, "victim_age": h(3, 80).cast("double"), "dow": h(4, 7).cast("double"),
                         "area_name": F.concat(F.lit("A"), h(5, 6).cast("string")), "victim_sex": F.element_at(F.array(F.lit("M"), F.lit("F")), (h(6, 2) + 1).cast("int"))})
    score = (F.col("hour") > 12).cast("int") + (F.col("lat") * F.col("dow") > 2).cast("int") + F.col("area_name").isin("A1", "A4").cast("int") * (F.col("victim_sex") == "M").cast("int")
    return models.stored(df.withColumn("y", (score + (h(7, 10) == 0).cast("int") >= 2).cast("int")), "explain")


@pytest.fixture(scope="module")
def fitted(table):
    return {"gbt": models.train_boosted_trees(table, "y", max_iter=4, max_depth=4, min_leaf=10),
            "rf": models.train_random_forest(table, "y", num_trees=5, max_depth=5),
            "logreg": models.train_logreg(table, "y", max_iter=50)}


def all_subsets(nodes, owners, x, players):
    """Shapley values by definition: the expected output of every coalition, walking each tree."""
    by_tree = {}
    for r in nodes:
        by_tree.setdefault(r["tree"], {})[r["node"]] = r

    def expected(tree, k, known):
        r = tree[k]
        if r["left"] is None or r["left"] < 0:
            return r["value"]
        left, right = tree[r["left"]], tree[r["right"]]
        if owners[r["feature"]] in known:
            v = x[r["feature"]]
            goes = v in r["categories"] if r["categories"] is not None else v <= r["threshold"]
            return expected(tree, r["left"] if goes else r["right"], known)
        return (left["cover"] * expected(tree, r["left"], known) + right["cover"] * expected(tree, r["right"], known)) / r["cover"]

    worth = {s: sum(expected(t, 0, s) for t in by_tree.values()) for k in range(len(players) + 1) for s in map(frozenset, itertools.combinations(players, k))}
    n = len(players)
    return {p: sum(math.factorial(len(s)) * math.factorial(n - len(s) - 1) / math.factorial(n) * (worth[s | {p}] - worth[s]) for s in worth if p not in s) for p in players}


@pytest.mark.parametrize("name", ["gbt", "rf"])
def test_tree_attributions_equal_enumeration(spark, table, fitted, name):
    model = fitted[name]
    owners = explain.feature_owners(model, table, COLUMNS)
    nodes = [r.asDict() for r in explain.tree_nodes(spark, model).collect()]
    players = [COLUMNS.index(c) for c in SIX]
    assert {owners[r["feature"]] for r in nodes if r["left"] is not None and r["left"] >= 0} <= set(players)
    some = table.where("dr_no < 12")
    phis = {r["dr_no"]: r["phis"] for r in explain.tree_attributions(model, some).collect()}
    for r in model.model.transform(some).select("dr_no", vector_to_array("features").alias("x")).collect():
        wanted = all_subsets(nodes, owners, r["x"], players)
        assert np.allclose([phis[r["dr_no"]][p] for p in players], [wanted[p] for p in players], atol=1e-10)
        assert all(phis[r["dr_no"]][c] == 0 for c in range(len(COLUMNS)) if c not in players)


def test_attributions_add_up_to_the_log_odds(table, fitted):
    for name in ("gbt", "logreg"):
        exact = explain.tree_attributions if name == "gbt" else explain.linear_attributions
        odds = fitted[name].transform(table).select("dr_no", F.log(F.col("prob") / (1 - F.col("prob"))).alias("odds"))
        rows = exact(fitted[name], table).join(odds, "dr_no").select((F.col("odds") - F.aggregate("phis", F.lit(0.0), lambda a, x: a + x)).alias("rest"))
        ends = rows.agg(F.min("rest"), F.max("rest")).first()
        assert ends[1] - ends[0] < 1e-6  # the same for every row: the expected output


def test_linear_attributions_are_coefficient_times_difference(table, fitted):
    model = fitted["logreg"]
    means = explain.linear_attributions(model, table).select(F.posexplode("phis").alias("c", "phi")).groupBy("c").agg(F.avg("phi").alias("m")).collect()
    assert all(abs(r["m"]) < 1e-9 for r in means)
    two = table.where("dr_no IN (1, 2)")
    x = {r[0]: np.array(r[1]) for r in model.model.transform(two).select("dr_no", vector_to_array("features")).collect()}
    phi = {r[0]: r[1] for r in explain.linear_attributions(model, two).collect()}
    mean, owners, coef = (x[1] + x[2]) / 2, explain.feature_owners(model, table, COLUMNS), model.model.stages[-1].coefficients.toArray()
    for k in (1, 2):
        wanted = [sum(coef[j] * (x[k][j] - mean[j]) for j in range(len(coef)) if owners[j] == c) for c in range(len(COLUMNS))]
        assert np.allclose(phi[k], wanted, atol=1e-12)


def test_summary_names_the_columns_that_matter(table, fitted):
    for name in ("gbt", "rf", "logreg"):
        top = [r["feature"] for r in explain.attribution_summary(fitted[name], table, top=6).collect()]
        assert "hour" in top[:3] and set(top[:4]) <= set(SIX)
    assert explain.attribution_summary(fitted["gbt"], table.where("false")).count() == 0


def test_each_repeat_permutes_the_whole_table(spark):
    rows = spark.range(5003).select(F.col("id").alias("dr_no"), F.col("id").alias("v"))
    both = explain.permuted_rows(rows, "dr_no", ["v"], 4)
    got = both.groupBy("rep").agg(F.count("*").alias("n"), F.count_distinct("dr_no").alias("rows"), F.count_distinct("__src.v").alias("values"),
                                  F.count_if(F.col("dr_no") == F.col("__src.v")).alias("same"), F.corr("dr_no", "__src.v").alias("r")).collect()
    assert len(got) == 4
    for r in got:
        assert r["n"] == r["rows"] == r["values"] == 5003 and r["same"] < 60 and abs(r["r"]) < 0.1
    maps = both.select("rep", "dr_no", "__src.v").collect()
    assert len({tuple(sorted((r[1], r[2]) for r in maps if r[0] == k)) for k in range(4)}) == 4
    assert explain.permuted_rows(rows.where("dr_no < 1"), "dr_no", ["v"], 2).count() == 2
    assert explain.permuted_rows(rows.where("false"), "dr_no", ["v"], 2).count() == 0


def test_permutation_importance_against_known_signal(table, fitted):
    got = {r["feature"]: r for r in explain.permutation_importance(fitted["gbt"], table, "y", n_repeats=3, top=18).collect()}
    assert got["hour"]["importance_mean"] > 0.02 > abs(got["month"]["importance_mean"])
    assert got["month"]["importance_mean"] == pytest.approx(0, abs=1e-12) and got["month"]["importance_std"] == pytest.approx(0, abs=1e-12)


def test_forest_and_boosted_classifiers_beat_the_prior(table):
    metrics, _, _ = models.train_classifier(table, "y", ("rf", "gbt"), sample=None, key="dr_no", params={"rf": {"num_trees": 10, "max_depth": 6}, "gbt": {"max_iter": 5, "min_leaf": 10}})
    for r in metrics.collect():
        assert r["roc_auc"] > 0.8 and r["pr_auc"] > 0.6


def test_archetypes_split_planted_groups(spark):
    """Areas of three levels: archetypes follow them, highest mean first; every area has one."""
    import datetime as dt
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=d), a, f"A{a}", 5 + 40 * (a % 3) + (d * 7 + a) % 3, a % 3, 0, 0.0, 0.0) for a in range(12) for d in range(60)]
    daily = spark.createDataFrame(rows, "date date, area_id int, area_name string, crimes bigint, violent bigint, arrests bigint, violent_ratio double, arrest_ratio double")
    got = {r["area_id"]: r["archetype"] for r in models.kmeans_area_archetypes(daily, k=3, n_init=3).collect()}
    assert got == {a: 2 - a % 3 for a in range(12)}


def test_scoring_after_an_observation(spark, table, fitted):
    """A session that has observed a query can still score every model, fitted before or after."""
    from pyspark.sql import Observation
    seen = Observation("rows")
    table.observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 3000
    late = models.train_logreg(table, "y", max_iter=5)
    for model in [*fitted.values(), late]:
        assert model.transform(table).agg(F.avg("prob")).first()[0] > 0


def test_linear_variants_equal_scoring_every_variant(spark, table, fitted, monkeypatch):
    """Many ranges of scores, ties, a missing number and keys that come twice: the same AUC of each variant as through the model."""
    odd = table.select("dr_no", "y", *COLUMNS).where("dr_no < 900").withColumn("lat", F.when(F.col("dr_no") % 50 > 0, F.col("lat")))
    odd = models.stored(odd.unionByName(odd.where("dr_no % 7 = 0")).withColumn("hour", F.floor(F.col("hour") / 6).cast("double")), "odd")
    monkeypatch.setattr(explain.evaluate, "RANGE_SCORES", 50)
    asked = (fitted["logreg"], odd, "y", "dr_no", COLUMNS, 2)
    got, want = ({(r["var_col"], r["rep"]): r["roc_auc"] for r in how(*asked).collect()} for how in (explain.linear_variants, explain.model_variants))
    assert len(got) == 2 * len(COLUMNS) + 1 and got.keys() == want.keys()
    assert got[("area_name", 0)] != got[("area_name", 1)]
    for k, v in want.items():
        # rows of equal keys may be numbered in either order
        assert got[k] == pytest.approx(v, abs=1e-9 if k[0] == "" else 2e-2), k


def test_linear_variants_without_equal_keys_are_exact(spark, table, fitted):
    asked = (fitted["logreg"], table.where("dr_no < 700").select("dr_no", "y", *COLUMNS), "y", "dr_no", COLUMNS, 2)
    got, want = ({(r["var_col"], r["rep"]): r["roc_auc"] for r in how(*asked).collect()} for how in (explain.linear_variants, explain.model_variants))
    assert got == pytest.approx(want, abs=1e-9)
