"""Hand-made edge frames for the cleaning operators (nulls the driver tables lack)."""

import datetime as dt

from pyspark.sql import functions as F

from citypulse import contract as C
from citypulse.operators import cleaning, describe, panels


def _raw(spark, rows):
    cols = list(C.RAW_TYPES)
    schema = ", ".join(f"`{c}` {t}" for c, t in C.RAW_TYPES.items())
    full = [tuple(r.get(c) for c in cols) for r in rows]
    return spark.createDataFrame(full, schema)


def _row(i, **kw):
    base = {"DR_NO": i, "DATE OCC": "01/02/2024 12:00:00 AM", "Date Rptd": "01/03/2024 12:00:00 AM",
            "TIME OCC": 1200, "AREA": 1, "AREA NAME": "A", "Crm Cd": 510, "LAT": 34.0, "LON": -118.2,
            "Vict Age": 30, "Vict Sex": "M", "Vict Descent": "H", "Status": "IC"}
    base.update(kw)
    return base


def test_hour_from_hhmm(spark):
    rows = [_row(i, **{"TIME OCC": t}) for i, t in enumerate([None, 0, 59, 2359, 2400])]
    out = cleaning.clean_incidents(_raw(spark, rows)).orderBy("dr_no").select("hour", "part_of_day").collect()
    assert [r.hour for r in out] == [0, 0, 0, 23, 23]
    assert [r.part_of_day for r in out] == ["Late Night"] * 3 + ["Night"] * 2


def test_victim_age_and_sex(spark):
    ages = [None, -1, 0, 1, 110, 111]
    sexes = [None, "m", "F", "X", "f", "?"]
    rows = [_row(i, **{"Vict Age": a, "Vict Sex": s, "Vict Descent": None}) for i, (a, s) in enumerate(zip(ages, sexes))]
    out = cleaning.clean_incidents(_raw(spark, rows)).orderBy("dr_no").collect()
    assert [r.victim_age for r in out] == [None, None, None, 1, 110, None]
    assert [r.victim_sex for r in out] == ["Unknown", "M", "F", "Unknown", "F", "Unknown"]
    assert {r.victim_descent for r in out} == {"X"}


def test_bbox_masking(spark):
    coords = [(0.0, 0.0), (33.6, -118.8), (34.4, -117.95), (None, -118.2), (34.0, None), (34.5, -118.2)]
    rows = [_row(i, LAT=a, LON=b) for i, (a, b) in enumerate(coords)]
    out = cleaning.clean_incidents(_raw(spark, rows)).orderBy("dr_no").collect()
    assert [r.has_coords for r in out] == [False, True, True, False, False, False]
    for r in out:
        if not r.has_coords:
            assert r.lat is None and r.lon is None


def test_dates_weeks_and_lag(spark):
    rows = [
        _row(1, **{"DATE OCC": None}),
        _row(2, **{"DATE OCC": "not a date"}),
        _row(3, **{"DATE OCC": "12/30/2024 01:00:00 AM", "Date Rptd": "12/30/2024 12:00:00 AM"}),
        _row(4, **{"DATE OCC": "12/28/2024 11:30:00 PM", "Date Rptd": "12/30/2024 11:00:00 PM"}),
    ]
    out = cleaning.clean_incidents(_raw(spark, rows)).orderBy("dr_no").collect()
    assert [r.dr_no for r in out] == [3, 4]            # undated rows dropped
    r3, r4 = out
    assert r3.week == 1 and r3.dow == 0 and r3.year == 2024 and not r3.is_weekend
    assert r3.report_lag_days == -1                      # -1 hour floors to -1 day
    assert r4.dow == 5 and r4.is_weekend and r4.report_lag_days == 1
    assert r3.date_occurred == dt.datetime(2024, 12, 30, 1, 0)


def test_status_targets(spark):
    rows = [_row(i, Status=s, **{"Crm Cd": c, "Weapon Used Cd": w})
            for i, (s, c, w) in enumerate([(None, None, None), ("AA", 110, 200), ("JA", 930, None), ("??", 111, 1)])]
    out = cleaning.clean_incidents(_raw(spark, rows)).orderBy("dr_no").collect()
    assert [r.is_arrest for r in out] == [0, 1, 1, 0]
    assert [r.is_violent for r in out] == [0, 1, 1, 0]
    assert [r.status_group for r in out] == ["Unknown", "Adult Arrest", "Juvenile Arrest", "Unknown"]
    assert [r.weapon_used for r in out] == [0, 1, 0, 1]


def test_null_area_key_dropped_but_counts_in_range(spark):
    rows = [_row(1, **{"DATE OCC": "01/01/2024 12:00:00 AM"}),
            _row(2, **{"AREA": None, "DATE OCC": "01/05/2024 12:00:00 AM"}),
            _row(3, **{"DATE OCC": "01/03/2024 12:00:00 AM"})]
    daily = panels.daily_area_panel(cleaning.clean_incidents(_raw(spark, rows)))
    got = daily.orderBy("date").collect()
    assert len(got) == 5                                  # 01-01..01-05, one area
    assert [r.crimes for r in got] == [1, 0, 1, 0, 0]
    assert all(r.violent_ratio == 0.0 for r in got if r.crimes == 0)


def test_missing_table_and_overview_on_empty(spark):
    clean = cleaning.clean_incidents(_raw(spark, [_row(1, LAT=None)]))
    miss = {r.column: r.missing_count for r in describe.missing_table(clean).collect()}
    assert miss["lat"] == 1 and miss["lon"] == 1
    empty = clean.where(F.lit(False))
    k = describe.kpi_summary(empty).first()
    assert k.crimes == 0 and k.violent_pct == 0.0 and k.areas == 0


def test_undated_rows_are_dropped_and_counted(spark):
    rows = [(1, "a", dt.datetime(2024, 1, 1)), (2, "a", None), (3, "b", None)]
    df = spark.createDataFrame(rows, "dr_no long, area_name string, date_occurred timestamp")
    assert [r.dr_no for r in cleaning.drop_undated(df).collect()] == [1]
    assert tuple(cleaning.undated_counts(df).first()) == (1, 2)
    assert {tuple(r) for r in cleaning.undated_counts(df, ["area_name"]).collect()} == {("a", 1, 1), ("b", 0, 1)}
    assert tuple(cleaning.undated_counts(df.where("false")).first()) == (0, 0)
