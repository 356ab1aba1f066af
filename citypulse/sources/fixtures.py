"""Adapters from the driver's TPC-H-like tables onto the incident contract.

These are test fixtures: they produce incident-shaped data whose size grows
with the input tables, so every registered query does real work at scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citypulse import contract as C


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fact_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fact table spread over at least the default parallelism."""
    from citypulse.sources.files import ensure_parallelism
    return ensure_parallelism(table(spark, sf_dir, name))


def raw_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture A in raw form (28 raw columns, dates as month/day/year text).

    lineitem ⋈ orders ⋈ supplier ⋈ nation ⋈ part. Only ``nation`` (25 rows by
    definition) is broadcast explicitly; the other joins are left to the
    planner's size-checked strategy choice and AQE.
    """
    li = fact_table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    p = table(spark, sf_dir, "part")
    j = (li.join(o, li.l_orderkey == o.o_orderkey)
         .join(s, li.l_suppkey == s.s_suppkey)
         .join(F.broadcast(n), s.s_nationkey == n.n_nationkey)
         .join(p, li.l_partkey == p.p_partkey))
    fmt = C.RAW_DATE_FORMAT
    ln = F.col("l_linenumber")
    crime = (F.lit(100) + F.lit(10) * F.col("p_size")).cast("int")
    return j.select(
        ((F.col("l_orderkey") * 100000 + F.col("l_partkey")) * 100000
         + F.col("l_suppkey") * 10 + ln).cast("bigint").alias("DR_NO"),
        F.date_format("o_orderdate", fmt).alias("Date Rptd"),
        F.date_format("l_shipdate", fmt).alias("DATE OCC"),
        F.when(F.col("l_quantity") == 1, F.lit(None))
         .otherwise((F.col("l_partkey") % 25) * 100 + ln).cast("int").alias("TIME OCC"),
        F.col("n_nationkey").cast("int").alias("AREA"),
        F.col("n_name").alias("AREA NAME"),
        F.col("l_suppkey").cast("string").alias("Rpt Dist No"),
        (F.lit(1) + ln % 2).cast("int").alias("Part 1-2"),
        crime.alias("Crm Cd"),
        F.concat_ws(" ", "p_type", "p_brand").alias("Crm Cd Desc"),
        F.concat_ws(" ", "l_returnflag", "l_linestatus").alias("Mocodes"),
        (F.col("l_quantity") * 3 - 5).cast("int").alias("Vict Age"),
        F.when(ln == 7, F.lit(None)).when(F.col("l_returnflag") == "A", "m")
         .when(F.col("l_returnflag") == "N", "F").otherwise("X").alias("Vict Sex"),
        F.when(F.col("l_discount") == 0, F.lit(None))
         .otherwise(F.substring("o_orderpriority", 1, 1)).alias("Vict Descent"),
        ln.cast("int").alias("Premis Cd"),
        F.col("p_type").alias("Premis Desc"),
        F.when(ln <= 2, F.lit(100) + ln).cast("int").alias("Weapon Used Cd"),
        F.when(ln <= 2, F.lit("WEAPON")).alias("Weapon Desc"),
        F.when(F.col("o_orderstatus") == "F", "AA").when(F.col("o_orderstatus") == "O", "IC")
         .when(F.col("l_linestatus") == "O", "JO").alias("Status"),
        F.col("o_orderstatus").alias("Status Desc"),
        crime.alias("Crm Cd 1"),
        F.when(ln >= 6, F.lit(998)).cast("int").alias("Crm Cd 2"),
        F.lit(None).cast("int").alias("Crm Cd 3"),
        F.lit(None).cast("int").alias("Crm Cd 4"),
        F.col("s_name").alias("LOCATION"),
        F.when(ln == 3, F.col("p_brand")).alias("Cross Street"),
        ((F.lit(33550) + F.col("l_partkey") % 900).cast("double") / 1000).alias("LAT"),
        ((F.lit(-118850) + (F.col("l_suppkey") * 37 + F.col("l_orderkey")) % 950)
         .cast("double") / 1000).alias("LON"),
    )


def bad_dates(raw: DataFrame) -> DataFrame:
    """Fixture A with some occurrence dates missing and some that are no dates."""
    k = F.col("DR_NO")
    return raw.withColumn("DATE OCC", F.when(k % 97 == 0, F.lit(None)).when(k % 89 == 0, "unknown").otherwise(F.col("DATE OCC")))


def bad_numbers(raw: DataFrame) -> DataFrame:
    """Fixture A as text, some of its numbers misspelt."""
    k = F.col("DR_NO")
    planted = {"TIME OCC": (101, "noon"), "Vict Age": (103, "3O"), "LAT": (107, "north"), "AREA": (109, "12.5")}
    cols = [F.when(k % planted[c][0] == 0, planted[c][1]).otherwise(F.col(f"`{c}`").cast("string")).alias(c) if c in planted
            else F.col(f"`{c}`").cast("string").alias(c) for c in raw.columns]
    return raw.select(*cols)


def thin_tail(clean: DataFrame, keep_until: str = "2001-09-20") -> DataFrame:
    """Fixture B: thin the most recent weeks so the tail trim fires."""
    return clean.where((F.col("date_occurred") <= F.lit(keep_until).cast("timestamp_ntz"))
                       | (F.col("dr_no") % 4 == 0))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture C: clusterable coordinates derived from ``embeddings``."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").cast("bigint").alias("dr_no"),
        (F.lit(34.0) + F.lit(0.5) * F.col("embedding")[0].cast("double")).alias("lat"),
        (F.lit(-118.3) + F.lit(0.5) * F.col("embedding")[1].cast("double")).alias("lon"),
        F.col("label").cast("string").alias("crime_desc"),
        (F.col("label") % 2).cast("int").alias("is_violent"),
    )


def event_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture D: ``events`` with real times of day as incidents."""
    ev = fact_table(spark, sf_dir, "events")
    ts = F.col("ts")
    return ev.select(
        F.col("event_id").cast("bigint").alias("dr_no"),
        ts.alias("date_occurred"),
        (F.col("user_id") % 21).cast("int").alias("area_id"),
        F.concat(F.lit("Area "), (F.col("user_id") % 21).cast("string")).alias("area_name"),
        F.col("event_type").alias("crime_desc"),
        (F.col("event_type") == "error").cast("int").alias("is_violent"),
        F.floor("value").cast("int").alias("victim_age"),
        F.hour(ts).cast("int").alias("hour"),
        F.weekday(ts).cast("int").alias("dow"),
        F.month(ts).cast("int").alias("month"),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture E: fixed scores with many ties, label from order status."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("row_id"),
        (F.col("o_orderstatus") == "F").cast("int").alias("y"),
        (F.floor(F.col("o_totalprice") / 5000) / 100).cast("double").alias("score"),
    )
