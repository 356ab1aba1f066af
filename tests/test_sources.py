"""CSV scan with its rejects, and the cache that knows its source."""

import os

import pytest

from citypulse import contract as C
from citypulse.sources import files


def write(path, rows, cut=()):
    names = list(C.RAW_TYPES)
    lines = [",".join(names)]
    for k, r in enumerate(rows):
        cells = [str(r.get(c, "")) for c in names]
        lines.append(",".join(cells[:5] if k in cut else cells))
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_rejects_are_kept_beside_the_typed_rows(spark, tmp_path):
    rows = [{"DR_NO": 1, "AREA": 3, "LAT": 34.5, "TIME OCC": " 900 "}, {"DR_NO": 2, "AREA": "x", "LAT": "1e1", "TIME OCC": 12.5}, {"DR_NO": 3}, {"DR_NO": "4a", "LAT": "--1"}]
    checked = files.scan_incidents_checked(spark, write(tmp_path / "a.csv", rows, cut=(2,)))
    got = checked.orderBy("DR_NO").collect()
    assert checked.columns[:-1] == list(C.RAW_TYPES) and checked.count() == 4
    assert dict(checked.drop("rejected").dtypes) == dict(files.scan_incidents_csv(spark, str(tmp_path / "a.csv")).dtypes)
    one = next(r for r in got if r["DR_NO"] == 1)
    assert (one["AREA"], one["LAT"], one["TIME OCC"], one["rejected"]) == (3, 34.5, 900, [])
    found = {(r["DR_NO"], r["column"], r["value"]) for r in files.rejected_records(checked).collect()}
    assert {(2, "AREA", "x"), (2, "TIME OCC", "12.5"), (None, "DR_NO", "4a"), (None, "LAT", "--1")} <= found
    lines = [x for x in found if x[1] == "line"]
    assert len(lines) == 1 and lines[0][2].startswith("3,")
    assert {(r["column"], r["rejected"]) for r in files.rejected_counts(checked).collect()} == {("AREA", 1), ("TIME OCC", 1), ("DR_NO", 1), ("LAT", 1), ("line", 1)}


def test_cache_follows_its_source(spark, tmp_path):
    csv, cache = tmp_path / "in.csv", str(tmp_path / "cache")
    write(csv, [{"DR_NO": 1}, {"DR_NO": 2}])
    read = lambda **kw: sorted(r["DR_NO"] for r in files.read_through_parquet(spark, str(csv), cache, **kw).collect())
    assert read() == [1, 2]
    before = sorted(os.listdir(f"{cache}/data"))
    assert read() == [1, 2] and sorted(os.listdir(f"{cache}/data")) == before  # reused
    write(csv, [{"DR_NO": 1}, {"DR_NO": 2}, {"DR_NO": 3}])
    assert read() == [1, 2, 3]  # a changed source is read anew
    other = tmp_path / "other.csv"
    write(other, [{"DR_NO": 9}])
    assert [r["DR_NO"] for r in files.read_through_parquet(spark, str(other), cache).collect()] == [9]  # another source too
    assert read(nrows=1) == [1] and read(use_cache=False) == [1, 2, 3]


def test_half_written_cache_is_not_used(spark, tmp_path, monkeypatch):
    csv, cache = tmp_path / "in.csv", str(tmp_path / "cache")
    write(csv, [{"DR_NO": 1}])
    files.read_through_parquet(spark, str(csv), cache)
    write(csv, [{"DR_NO": 1}, {"DR_NO": 2}])

    def fails(*a, **kw):
        raise RuntimeError("lost while writing")
    with monkeypatch.context() as m:
        m.setattr(files, "scan_incidents_csv", fails)
        with pytest.raises(RuntimeError):
            files.read_through_parquet(spark, str(csv), cache)
    assert files._manifest(spark, cache)["complete"] is False
    assert files.read_through_parquet(spark, str(csv), cache).count() == 2
    assert files._manifest(spark, cache)["complete"] is True


def test_written_artifact_is_dealt_in_bounded_tasks_and_ordered(spark, tmp_path):
    import pyarrow.parquet as pq
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "64k")
    try:
        df = spark.range(0, 60_000, 1, 2).selectExpr("id", "xxhash64(id) AS at", "CAST(pmod(xxhash64(id), 2) AS INT) AS year")
        files.write_parquet_artifacts(df, str(tmp_path / "a"), partition_by=["year"], sort_within=["at", "id"])
    finally:
        spark.conf.unset(size)
    parts = sorted((tmp_path / "a").glob("year=*/*.parquet"))
    rows = [pq.ParquetFile(p).read().to_pylist() for p in parts]
    assert sorted(r["id"] for part in rows for r in part) == list(range(60_000))
    assert all(part == sorted(part, key=lambda r: (r["at"], r["id"])) for part in rows)
    assert max(map(len, rows)) < 20_000
