"""Property checks: panels, windows, scaling, sampling, metrics, DBSCAN, attributions."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from citypulse.operators import evaluate, features, panels, risk, sampling, spatial
from citypulse.session import scratch_path
from citypulse.sources import fixtures
from conftest import SF001, SMOKE


def _panel(spark, n_days=120, areas=3, seed=1):
    rng = random.Random(seed)
    start = dt.date(2024, 1, 1)
    rows = [(start + dt.timedelta(days=d), a, f"A{a}", rng.randint(0, 20), 0, 0, 0.0, 0.0)
            for d in range(n_days) for a in range(areas) if rng.random() > 0.2]
    return spark.createDataFrame(rows, "date date, area_id int, area_name string, crimes bigint, "
                                       "violent bigint, arrests bigint, violent_ratio double, arrest_ratio double")


def test_densify_counts_and_sums(spark):
    sparse = _panel(spark)
    bounds = sparse.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    dense = panels.densify_panel(sparse, bounds)
    days = bounds.select(F.datediff("hi", "lo") + 1).first()[0]
    assert dense.count() == days * 3
    assert dense.agg(F.sum("crimes")).first()[0] == sparse.agg(F.sum("crimes")).first()[0]


def test_weekly_sums_equal_daily(spark):
    d = _panel(spark)
    w = panels.weekly_area_panel(d)
    assert w.agg(F.sum("crimes")).first()[0] == d.agg(F.sum("crimes")).first()[0]
    assert {r[0] for r in w.select(F.weekday("date")).distinct().collect()} == {0}


def test_lag_features_are_leak_free(spark):
    bounds_panel = _panel(spark, n_days=150)
    bounds = bounds_panel.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    p = panels.densify_panel(bounds_panel, bounds)
    cut = dt.date(2024, 4, 1)
    a = features.add_lag_features(p).where(F.col("date") <= cut)
    perturbed = p.withColumn("crimes", F.when(F.col("date") >= cut, F.col("crimes") + 1000).otherwise(F.col("crimes")))
    b = features.add_lag_features(perturbed).where(F.col("date") <= cut)
    cols = ["lag_1", "lag_7", "lag_28", "roll_mean_7", "roll_std_28", "roll_mean_90", "adow_mean"]
    ra = {(r.date, r.area_id): tuple(r[c] for c in cols) for r in a.collect()}
    rb = {(r.date, r.area_id): tuple(r[c] for c in cols) for r in b.collect()}
    assert ra == rb


def test_min_max_and_tiers(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([3, 3, 1, 7, 7, 9, 2, 5])], "id int, x double")
    s = risk.min_max_scale(df, "x").collect()
    assert all(0.0 <= r.x_n <= 1.0 for r in s)
    const = spark.createDataFrame([(1, 2.0), (2, 2.0)], "id int, x double")
    assert {r.x_n for r in risk.min_max_scale(const, "x").collect()} == {0.0}
    order = {"Low": 0, "Medium": 1, "High": 2, "Critical": 3}
    t = sorted((r.x, order[r.risk_tier]) for r in risk.quantile_tiers(df, "x").collect())
    assert all(a[1] <= b[1] for a, b in zip(t, t[1:]))
    tied = spark.createDataFrame([(i, 1.0) for i in range(6)] + [(9, 5.0)], "id int, x double")
    assert {r.risk_tier for r in risk.quantile_tiers(tied, "x").collect()} <= {"Low", "Critical"}


def test_exact_sample_is_exact_and_layout_stable(spark):
    df = spark.range(0, 5000).withColumnRenamed("id", "dr_no")
    a = {r.dr_no for r in sampling.exact_sample(df, 700).collect()}
    b = {r.dr_no for r in sampling.exact_sample(df.repartition(13), 700).collect()}
    assert len(a) == 700 and a == b
    assert sampling.exact_sample(df, 10_000).count() == 5000


def test_stratified_split_exact(spark):
    df = spark.range(0, 3001).select(F.col("id").alias("dr_no"), (F.col("id") % 7 == 0).cast("int").alias("y"))
    s = sampling.stratified_split(df, "y", 0.8, levels=4)  # few buckets: exercises the boundary window
    rows = s.collect()
    assert len(rows) == 3001 and len({r.dr_no for r in rows}) == 3001
    for cls in (0, 1):
        n = sum(1 for r in rows if r.y == cls)
        tr = sum(1 for r in rows if r.y == cls and r.split == "train")
        assert tr == round(0.8 * n)
    again = {r.dr_no: r.split for r in sampling.stratified_split(df.repartition(5), "y", 0.8, levels=4).collect()}
    assert again == {r.dr_no: r.split for r in rows}


def test_auc_and_ap_against_brute_force(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 400)
    s = np.round(rng.random(400) * 0.3 + y * 0.1, 2)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, prob double")
    got = evaluate.ranking_metrics(df, "y", "prob").first()
    pos, neg = s[y == 1], s[y == 0]
    auc = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    ap = 0.0
    for t in np.unique(s)[::-1]:
        sel = s >= t
        ap += (y[s == t].sum() / y.sum()) * (y[sel].sum() / sel.sum())
    assert got.roc_auc == pytest.approx(auc, abs=1e-12)
    assert got.pr_auc == pytest.approx(ap, abs=1e-12)


def _dbscan_brute(keys, lat, lon, eps, min_samples):
    R = 6371.0088
    o = np.argsort(keys)
    keys, lat, lon = keys[o], lat[o], lon[o]
    p1, p2 = np.radians(lat)[:, None], np.radians(lat)[None, :]
    a = np.sin((p2 - p1) / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin((np.radians(lon)[None, :] - np.radians(lon)[:, None]) / 2) ** 2
    nb = 2 * R * np.arcsin(np.minimum(1, np.sqrt(a))) <= eps
    core = nb.sum(1) >= min_samples
    lab, c = -np.ones(len(keys), int), 0
    for i in range(len(keys)):
        if lab[i] != -1 or not core[i]:
            continue
        stack, lab[i] = [i], c
        while stack:
            u = stack.pop()
            for v in np.nonzero(nb[u])[0]:
                if lab[v] == -1:
                    lab[v] = c
                    if core[v]:
                        stack.append(v)
        c += 1
    return dict(zip(keys.tolist(), lab.tolist()))


@pytest.mark.parametrize("sf,eps,ms", [(SMOKE, 1.5, 8), (SF001, 1.0, 6)])
def test_dbscan_equals_brute_force(spark, sf, eps, ms):
    pts = fixtures.points(spark, sf)
    got = {r.dr_no: r.cluster for r in spatial.dbscan_hotspots(pts, eps, ms).collect()}
    p = pts.toPandas()
    assert got == _dbscan_brute(p.dr_no.to_numpy(), p.lat.to_numpy(), p.lon.to_numpy(), eps, ms)


def test_dbscan_shuffle_invariant_and_duplicates(spark):
    pts = fixtures.points(spark, SMOKE)
    dup = pts.unionByName(pts.limit(50).withColumn("dr_no", F.col("dr_no") + 100000))
    a = {r.dr_no: r.cluster for r in spatial.dbscan_hotspots(dup, 1.0, 6).collect()}
    b = {r.dr_no: r.cluster for r in spatial.dbscan_hotspots(dup.repartition(7), 1.0, 6).collect()}
    assert a == b
    p = dup.toPandas()
    assert a == _dbscan_brute(p.dr_no.to_numpy(), p.lat.to_numpy(), p.lon.to_numpy(), 1.0, 6)


def test_connected_components_chain(spark):
    n = 40
    edges = spark.createDataFrame([(i, i + 1) for i in range(n - 1)] + [(100, 101)], "src long, dst long")
    nodes = spark.createDataFrame([(i,) for i in list(range(n)) + [100, 101, 200]], "id long")
    comp = {r.id: r.component for r in spatial.connected_components(edges, nodes).collect()}
    assert all(comp[i] == 0 for i in range(n))
    assert comp[100] == comp[101] == 100 and comp[200] == 200


def test_tail_trim_fires_on_thin_tail(spark):
    from citypulse.plans import common
    cut = panels.tail_cutoff(common.daily_thin(spark, SF001)).first()[0]
    assert cut == dt.date(2001, 9, 24)
    plain = panels.tail_cutoff(common.daily(spark, SF001)).first()[0]
    assert plain == common.daily(spark, SF001).agg(F.max("date")).first()[0]


def test_ranking_over_many_ranges_and_signs(spark):
    rng = np.random.default_rng(5)
    s = np.concatenate([rng.standard_normal(3000) * 10.0 ** rng.integers(-9, 9, 3000), np.zeros(50), -np.zeros(10)])
    y = rng.integers(0, 2, len(s))
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, prob double")
    got = evaluate.ranking_metrics(df, "y", "prob").first()
    pos, neg = s[y == 1], s[y == 0]
    auc = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert got.roc_auc == pytest.approx(auc, abs=1e-12)


def test_medians_against_numpy(spark):
    from citypulse.operators import cleaning
    rng = np.random.default_rng(11)
    for n in (1, 2, 7, 500, 501):
        cols = {"a": rng.standard_normal(n) * 10.0 ** rng.integers(-3, 4, n), "b": np.round(rng.random(n) * 4 - 2), "c": np.full(n, 34.05)}
        rows = [tuple(float(cols[k][i]) for k in "abc") for i in range(n)] + [(None, None, None)] * 3
        got = cleaning.medians(spark.createDataFrame(rows, "a double, b double, c double"), ["a", "b", "c"])
        for k in "abc":
            assert got[k] == pytest.approx(np.median(cols[k]), abs=1e-12)


@pytest.mark.parametrize("ordered", [1, 40])
def test_medians_narrow_to_few_values(spark, monkeypatch, ordered):
    """Packed values, outliers of any size, ties, infinities, no values, NaN."""
    from citypulse.operators import cleaning
    monkeypatch.setattr(cleaning, "ORDERED_VALUES", ordered)
    monkeypatch.setattr(cleaning, "MEDIAN_BINS", 8)
    rng = np.random.default_rng(4)
    packed = -118.5 + rng.random(1501) * 1e-6
    wild = np.concatenate([rng.random(1498), [1e300, -1e300, 1e-300]])
    ends = np.concatenate([np.full(600, np.inf), np.full(601, -np.inf), rng.integers(0, 3, 300)])
    rows = [(float(a), float(b), float(c), None) for a, b, c in zip(packed, wild, ends)] + [(float("nan"), None, None, None)]
    got = cleaning.medians(spark.createDataFrame(rows, "a double, b double, c double, d double"), ["a", "b", "c", "d"])
    assert (got["a"], got["b"], got["c"], got["d"]) == (np.median(packed), np.median(wild), np.median(ends), None)
    filled = cleaning.impute_median(spark.createDataFrame([(None, 1.0)], "a double, b double"), ("a", "b")).first()
    assert filled.a is None and filled.b == 1.0


def test_median_of_a_million_values_in_one_degree_orders_few(spark):
    """A column with a million distinct values: the last step orders no more than ORDERED_VALUES."""
    from citypulse.operators import cleaning
    df = spark.range(1_000_001).select((F.lit(-118.5) + F.pmod(F.col("id") * 7919, F.lit(1_000_001)) / 1e6).alias("lon"))
    counts = df.groupBy(F.lit("lon").alias("c"), F.col("lon").alias("v")).count().withColumnRenamed("count", "n")
    first = cleaning.bins_of(counts, {"c": "lon", "lo": -118.5, "hi": -117.5})
    assert len(first) == cleaning.MEDIAN_BINS and max(b["values"] for b in first) < cleaning.ORDERED_VALUES
    assert cleaning.medians(df, ["lon"])["lon"] == -118.5 + 500_000 / 1e6


def test_ranking_metrics_split_packed_scores(spark, monkeypatch):
    """All scores within one 1/256 doubling, and ties: several ranges, the same exact result."""
    rng = np.random.default_rng(9)
    s = 0.5 + np.round(rng.random(4000) * 1e-3, 7)
    y = rng.integers(0, 2, len(s))
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, prob double")
    whole = evaluate.ranking_metrics(df, "y", "prob").first()
    monkeypatch.setattr(evaluate, "RANGE_SCORES", 300)
    table = evaluate.cumulative_below(evaluate.score_table(df, "y", "prob"))
    plan = table._jdf.queryExecution().analyzed().toString()
    assert "__bucket" in plan
    parts = evaluate.ranking_metrics(df, "y", "prob").first()
    assert parts.roc_auc == pytest.approx(whole.roc_auc, abs=1e-12) and parts.pr_auc == pytest.approx(whole.pr_auc, abs=1e-12)
    pos, neg = s[y == 1], s[y == 0]
    auc = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert parts.roc_auc == pytest.approx(auc, abs=1e-12)
    sizes = evaluate.score_ranges(evaluate.score_table(df, "y", "prob"), 300).groupBy("__bucket").count().collect()
    assert len(sizes) > 5 and max(r["count"] for r in sizes) < 600


def test_crowded_cells_are_linked_without_all_pairs(spark):
    """10^5 distinct locations in each of two neighbouring cells: once out of reach of each other, once
    with one pair that links them. All pairs would be 10^10 distances."""
    rng = np.random.default_rng(6)
    n, eps = 100_000, 1.0
    s_lat = spatial._spec(spark.createDataFrame([(34.0, -118.0)], "lat double, lon double"), eps)["s_lat"]
    base = np.floor(34.0 / s_lat) * s_lat
    west = np.stack([base + rng.random(n) * s_lat * 0.99, -118.0 - rng.random(n) * 1e-3], 1)
    east = np.stack([base + rng.random(n) * s_lat * 0.99, -117.985 + rng.random(n) * 1e-3], 1)  # some 1.3 km further
    lat, lon = np.concatenate((west, east)).T
    assert len(np.unique(lat)) == 2 * n

    def clusters(lat, lon):
        df = spark.createDataFrame(pd.DataFrame({"dr_no": np.arange(len(lat)), "lat": lat, "lon": lon}))
        got = spatial.dbscan_hotspots(df, eps, 5).groupBy("cluster").count().collect()
        return sorted((r["cluster"], r["count"]) for r in got)

    assert clusters(lat, lon) == [(0, n), (1, n)]
    # a chain of few crowded steps closes the gap
    more_lon = np.linspace(-117.999, -117.985, 4).repeat(10) + np.tile(np.arange(10) * 1e-7, 4)
    more_lat = np.full(40, base + s_lat / 2)
    assert clusters(np.concatenate((lat, more_lat)), np.concatenate((lon, more_lon))) == [(0, 2 * n + 40)]


@pytest.mark.parametrize("direct,eps,least", [(3, 0.3, 5), (40, 0.5, 12)])
def test_dbscan_splits_boxes_down_to_points(spark, monkeypatch, direct, eps, least):
    """With next to no direct comparisons every decision comes from splitting boxes."""
    monkeypatch.setattr(spatial, "DIRECT_PAIRS", direct)
    rng = np.random.default_rng(3)
    lat = 34 + np.round(rng.normal(0, 0.01, 300), 4)
    lon = -118 + np.round(rng.normal(0, 0.01, 300), 4)
    df = spark.createDataFrame(pd.DataFrame({"dr_no": np.arange(300), "lat": lat, "lon": lon}))
    got = {r.dr_no: r.cluster for r in spatial.dbscan_hotspots(df, eps, least).collect()}
    assert got == _dbscan_brute(np.arange(300), lat, lon, eps, least)
    assert -1 in got.values() and max(got.values()) >= 0


def test_dbscan_without_locations(spark):
    df = spark.createDataFrame([(1, None, None)], "dr_no long, lat double, lon double")
    assert spatial.dbscan_hotspots(df, 1.0, 2).count() == 0


def test_row_numbers_are_dense_and_in_order(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"))
    rows = sampling.row_numbers(df, "k").orderBy("number").collect()
    assert [r["number"] for r in rows] == list(range(5000)) and [r["k"] for r in rows] == sorted(r["k"] for r in rows)
    assert sampling.row_numbers(df.where("false"), "k").count() == 0


@pytest.mark.parametrize("levels", [1, 4, 14])
def test_first_k_one_pass_equals_brute_force_with_repeated_and_null_keys(spark, levels):
    """Exactly k rows a group in (hash, key) order, also where the k-th row comes several times."""
    rows = [(None if i % 7 == 0 else i % 23, "a" if i % 3 else "b", i) for i in range(400)]
    df = spark.createDataFrame(rows, "dr_no bigint, y string, x bigint").repartition(6)
    hashed = {r.dr_no: r.h for r in df.select("dr_no", sampling.hash_key("dr_no").alias("h")).distinct().collect()}
    place = lambda k: (hashed[k], k is not None, k or 0)
    for share in (0.0, 0.31, 0.5, 1.0):
        got = sampling.first_k_one_pass(df, lambda n: F.round(n * F.lit(share)), ("y",), "dr_no", levels=levels)
        assert sorted(got.columns) == sorted([*df.columns, "__selected"])
        out = got.collect()
        sides = [{r.x for r in got.repartition(3).where(side).collect()} for side in ("__selected", "not __selected")]  # each reads the rows anew
        assert sorted(r.x for r in out) == list(range(400)) == sorted(sides[0] | sides[1]) and not sides[0] & sides[1]
        for y in "ab":
            want = sorted((place(k) for k, g, _ in rows if g == y))
            k = int(share * len(want) + 0.5)
            assert sorted(place(r.dr_no) for r in out if r.y == y and r["__selected"]) == want[:k]


def test_first_k_one_pass_reads_whole_rows_once(spark):
    """The columns that are not keys are read by one scan, without a shuffle, if keys do not repeat."""
    path = scratch_path(spark, "first-k")
    spark.range(0, 5000, 1, 5).select(F.col("id").alias("dr_no"), (F.col("id") % 3).alias("y"), (F.col("id") * 2).alias("wide")).write.parquet(path)
    out = sampling.stratified_split(spark.read.parquet(path), "y", 0.8, first_k=sampling.first_k_one_pass)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("wide:bigint") == 1 and "hashpartitioning" not in plan
    assert sorted(r["count"] for r in out.where("split = 'train'").groupBy("y").count().collect()) == [1333, 1334, 1334]
