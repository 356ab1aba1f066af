"""DuckDB oracle building blocks (SQL text only; run by the external checker).

The CTEs mirror the fixture adapters in :mod:`citypulse.sources.fixtures` and
the operators' documented semantics, written independently in SQL.
"""

from __future__ import annotations

from citypulse import contract as C

DATE_FMT = "%m/%d/%Y %I:%M:%S %p"
VIOLENT = ", ".join(str(c) for c in C.VIOLENT_CRIME_CODES)
STATUS_CASE = "CASE status_code " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in C.STATUS_MAP.items()) + " ELSE 'Unknown' END"

RAW = f"""
raw AS (
  SELECT
    CAST((l_orderkey*100000 + l_partkey)*100000 + l_suppkey*10 + l_linenumber AS BIGINT) AS "DR_NO",
    strftime(o_orderdate, '{DATE_FMT}') AS "Date Rptd",
    strftime(l_shipdate, '{DATE_FMT}') AS "DATE OCC",
    CAST(CASE WHEN l_quantity = 1 THEN NULL ELSE (l_partkey % 25)*100 + l_linenumber END AS INTEGER) AS "TIME OCC",
    CAST(n_nationkey AS INTEGER) AS "AREA",
    n_name AS "AREA NAME",
    CAST(l_suppkey AS VARCHAR) AS "Rpt Dist No",
    CAST(1 + l_linenumber % 2 AS INTEGER) AS "Part 1-2",
    CAST(100 + 10*p_size AS INTEGER) AS "Crm Cd",
    p_type || ' ' || p_brand AS "Crm Cd Desc",
    l_returnflag || ' ' || l_linestatus AS "Mocodes",
    CAST(l_quantity*3 - 5 AS INTEGER) AS "Vict Age",
    CASE WHEN l_linenumber = 7 THEN NULL WHEN l_returnflag = 'A' THEN 'm'
         WHEN l_returnflag = 'N' THEN 'F' ELSE 'X' END AS "Vict Sex",
    CASE WHEN l_discount = 0 THEN NULL ELSE substr(o_orderpriority, 1, 1) END AS "Vict Descent",
    CAST(l_linenumber AS INTEGER) AS "Premis Cd",
    p_type AS "Premis Desc",
    CAST(CASE WHEN l_linenumber <= 2 THEN 100 + l_linenumber END AS INTEGER) AS "Weapon Used Cd",
    CASE WHEN l_linenumber <= 2 THEN 'WEAPON' END AS "Weapon Desc",
    CASE WHEN o_orderstatus = 'F' THEN 'AA' WHEN o_orderstatus = 'O' THEN 'IC'
         WHEN l_linestatus = 'O' THEN 'JO' END AS "Status",
    o_orderstatus AS "Status Desc",
    CAST(100 + 10*p_size AS INTEGER) AS "Crm Cd 1",
    CAST(CASE WHEN l_linenumber >= 6 THEN 998 END AS INTEGER) AS "Crm Cd 2",
    CAST(NULL AS INTEGER) AS "Crm Cd 3",
    CAST(NULL AS INTEGER) AS "Crm Cd 4",
    s_name AS "LOCATION",
    CASE WHEN l_linenumber = 3 THEN p_brand END AS "Cross Street",
    CAST(33550 + (l_partkey % 900) AS DOUBLE)/1000 AS "LAT",
    CAST(-118850 + ((l_suppkey*37 + l_orderkey) % 950) AS DOUBLE)/1000 AS "LON"
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN part ON l_partkey = p_partkey
)"""

RENAMED = """
renamed AS (
  SELECT "DR_NO" AS dr_no,
    try_strptime("Date Rptd", '%m/%d/%Y %I:%M:%S %p') AS date_reported,
    try_strptime("DATE OCC", '%m/%d/%Y %I:%M:%S %p') AS date_occurred,
    "TIME OCC" AS time_occurred, "AREA" AS area_id, "AREA NAME" AS area_name,
    "Rpt Dist No" AS report_district, "Part 1-2" AS part_class, "Crm Cd" AS crime_code,
    "Crm Cd Desc" AS crime_desc, "Mocodes" AS mo_codes, "Vict Age" AS victim_age,
    "Vict Sex" AS victim_sex, "Vict Descent" AS victim_descent, "Premis Cd" AS premise_code,
    "Premis Desc" AS premise_desc, "Weapon Used Cd" AS weapon_code, "Weapon Desc" AS weapon_desc,
    "Status" AS status_code, "Status Desc" AS status_desc, "Crm Cd 1" AS crime_code_1,
    "Crm Cd 2" AS crime_code_2, "Crm Cd 3" AS crime_code_3, "Crm Cd 4" AS crime_code_4,
    "LOCATION" AS address, "Cross Street" AS cross_street, "LAT" AS lat, "LON" AS lon
  FROM raw
)"""

BB = C.BBOX
STAGE = f"""
stage AS (
  SELECT *,
    CAST(greatest(0, least(23, floor(coalesce(time_occurred, 0) / 100))) AS INTEGER) AS hour_,
    coalesce(lat BETWEEN {BB['lat_min']} AND {BB['lat_max']}
             AND lon BETWEEN {BB['lon_min']} AND {BB['lon_max']}, false) AS has_coords_
  FROM renamed
)"""

CLEAN = f"""
clean AS (
  SELECT dr_no, date_reported, date_occurred, time_occurred, area_id, area_name,
    report_district, part_class, crime_code, crime_desc, mo_codes,
    CAST(CASE WHEN victim_age > 0 AND victim_age <= 110 THEN victim_age END AS INTEGER) AS victim_age,
    CASE WHEN upper(victim_sex) IN ('M', 'F') THEN upper(victim_sex) ELSE 'Unknown' END AS victim_sex,
    coalesce(victim_descent, 'X') AS victim_descent,
    premise_code, premise_desc, weapon_code, weapon_desc, status_code, status_desc,
    crime_code_1, crime_code_2, crime_code_3, crime_code_4, address, cross_street,
    CASE WHEN has_coords_ THEN lat END AS lat,
    CASE WHEN has_coords_ THEN lon END AS lon,
    hour_ AS hour,
    CAST(isodow(date_occurred) - 1 AS INTEGER) AS dow,
    CAST(month(date_occurred) AS INTEGER) AS month,
    CAST(year(date_occurred) AS INTEGER) AS year,
    CAST(weekofyear(date_occurred) AS INTEGER) AS week,
    coalesce(isodow(date_occurred) IN (6, 7), false) AS is_weekend,
    CAST(floor((epoch(date_reported) - epoch(date_occurred)) / 86400) AS BIGINT) AS report_lag_days,
    CASE WHEN hour_ > -1 AND hour_ <= 5 THEN 'Late Night' WHEN hour_ <= 11 THEN 'Morning'
         WHEN hour_ <= 17 THEN 'Afternoon' WHEN hour_ <= 21 THEN 'Evening'
         WHEN hour_ <= 23 THEN 'Night' END AS part_of_day,
    has_coords_ AS has_coords,
    CAST(coalesce(crime_code IN ({VIOLENT}), false) AS INTEGER) AS is_violent,
    CAST(coalesce(status_code IN ('AA', 'JA'), false) AS INTEGER) AS is_arrest,
    {STATUS_CASE} AS status_group,
    CAST(weapon_code IS NOT NULL AS INTEGER) AS weapon_used
  FROM stage
  WHERE date_occurred IS NOT NULL
)"""

def daily_ctes(src: str = "clean", name: str = "daily") -> str:
    """Dense daily panel CTEs named ``{name}`` built from relation ``src``."""
    return f"""
{name}_grouped AS (
  SELECT CAST(date_occurred AS DATE) AS date, area_id, area_name,
         count(dr_no) AS crimes, CAST(sum(is_violent) AS BIGINT) AS violent,
         CAST(sum(is_arrest) AS BIGINT) AS arrests
  FROM {src} GROUP BY ALL
),
{name}_agg AS (
  SELECT * FROM {name}_grouped
  WHERE date IS NOT NULL AND area_id IS NOT NULL AND area_name IS NOT NULL
),
{name}_dates AS (
  SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
  FROM {name}_grouped
),
{name}_areas AS (SELECT DISTINCT area_id, area_name FROM {name}_agg),
{name} AS (
  SELECT d.date, a.area_id, a.area_name,
    coalesce(g.crimes, 0) AS crimes, coalesce(g.violent, 0) AS violent,
    coalesce(g.arrests, 0) AS arrests,
    coalesce(CAST(g.violent AS DOUBLE) / nullif(g.crimes, 0), 0.0) AS violent_ratio,
    coalesce(CAST(g.arrests AS DOUBLE) / nullif(g.crimes, 0), 0.0) AS arrest_ratio
  FROM {name}_dates d CROSS JOIN {name}_areas a
  LEFT JOIN {name}_agg g ON g.date = d.date AND g.area_id = a.area_id AND g.area_name = a.area_name
)"""


DAILY = daily_ctes()

THIN = """
clean_thin AS (
  SELECT * FROM clean WHERE date_occurred <= TIMESTAMP '2001-09-20' OR dr_no % 4 = 0
)"""


def weekly_cte(src: str = "daily", name: str = "weekly") -> str:
    return f"""
{name} AS (
  SELECT CAST(date - CAST(isodow(date) - 1 AS INTEGER) AS DATE) AS date, area_id, area_name,
    CAST(sum(crimes) AS BIGINT) AS crimes, CAST(sum(violent) AS BIGINT) AS violent,
    CAST(sum(arrests) AS BIGINT) AS arrests,
    coalesce(CAST(sum(violent) AS DOUBLE) / nullif(sum(crimes), 0), 0.0) AS violent_ratio,
    coalesce(CAST(sum(arrests) AS DOUBLE) / nullif(sum(crimes), 0), 0.0) AS arrest_ratio
  FROM {src} GROUP BY 1, 2, 3
)"""


def trim_ctes(src: str = "daily", name: str = "trimmed", threshold: float = 0.7,
              min_days: int = 14) -> str:
    return f"""
{name}_tot AS (SELECT date, CAST(sum(crimes) AS BIGINT) AS crimes FROM {src} GROUP BY date),
{name}_r AS (
  SELECT date, sum(crimes) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS roll7
  FROM {name}_tot
),
{name}_f AS (
  SELECT date,
    coalesce(CAST(roll7 AS DOUBLE) / nullif(lag(roll7, 42) OVER (ORDER BY date), 0) < {threshold}, false) AS bad,
    row_number() OVER (ORDER BY date DESC) AS rn_desc
  FROM {name}_r
),
{name}_cut AS (
  SELECT CASE WHEN count(*) FILTER (WHERE rn_desc <= {min_days}) > 0
               AND count(*) FILTER (WHERE rn_desc <= {min_days})
                   = count(*) FILTER (WHERE rn_desc <= {min_days} AND bad)
              THEN coalesce(max(date) FILTER (WHERE NOT bad), max(date))
              ELSE max(date) END AS cutoff
  FROM {name}_f
),
{name} AS (SELECT {src}.* FROM {src}, {name}_cut WHERE date <= cutoff)"""


BASE = [RAW, RENAMED, STAGE, CLEAN]


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body
