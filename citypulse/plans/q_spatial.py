"""Catalog entries for radius neighbours, DBSCAN, cluster summary, heat points."""

from __future__ import annotations

from pyspark.sql import functions as F

from citypulse.operators import spatial
from citypulse.plans import common
from citypulse.plans.catalog import register, rounded
from citypulse.plans.oracle_sql import BASE, with_ctes
from citypulse.sources import fixtures

EPS_KM, MIN_SAMPLES = 1.0, 6

PTS = """
pts AS (
  SELECT CAST(vec_id AS BIGINT) AS dr_no,
    34.0 + 0.5 * CAST(embedding[1] AS DOUBLE) AS lat, -118.3 + 0.5 * CAST(embedding[2] AS DOUBLE) AS lon,
    CAST(label AS VARCHAR) AS crime_desc, CAST(label % 2 AS INTEGER) AS is_violent
  FROM embeddings
)"""

HAV = ("2 * 6371.0088 * asin(least(1.0, sqrt(pow(sin((radians(b.lat) - radians(a.lat)) / 2), 2) "
       "+ cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin((radians(b.lon) - radians(a.lon)) / 2), 2))))")

NB = f"""
nb AS (SELECT a.dr_no AS src, b.dr_no AS dst FROM pts a JOIN pts b ON {HAV} <= {EPS_KM})"""

DBSCAN = NB + f""",
cnt AS (SELECT src AS dr_no, count(*) AS n FROM nb GROUP BY src),
core AS (SELECT dr_no FROM cnt WHERE n >= {MIN_SAMPLES}),
cedge AS (SELECT nb.src, nb.dst FROM nb JOIN core c1 ON nb.src = c1.dr_no JOIN core c2 ON nb.dst = c2.dr_no),
reach(node, comp) AS (
  SELECT dr_no, dr_no FROM core
  UNION
  SELECT e.dst, r.comp FROM reach r JOIN cedge e ON e.src = r.node
),
comp AS (SELECT node AS dr_no, min(comp) AS comp FROM reach GROUP BY node),
cl AS (SELECT dr_no, CAST(dense_rank() OVER (ORDER BY comp) - 1 AS INTEGER) AS cluster FROM comp),
border AS (
  SELECT nb.src AS dr_no, min(cl.cluster) AS cluster FROM nb JOIN cl ON nb.dst = cl.dr_no
  WHERE nb.src NOT IN (SELECT dr_no FROM core) GROUP BY nb.src
),
lab AS (
  SELECT p.*, CAST(coalesce(cl.cluster, border.cluster, -1) AS INTEGER) AS cluster,
         p.dr_no IN (SELECT dr_no FROM core) AS core
  FROM pts p LEFT JOIN cl USING (dr_no) LEFT JOIN border USING (dr_no)
)"""


def _rec(body, ctes):
    return "WITH RECURSIVE " + ",".join(ctes) + "\n" + body


@register("radius_neighbors", _rec(
    "SELECT src AS dr_no, count(*) AS n_neighbors FROM nb GROUP BY src", [PTS, NB]))
def q_radius_neighbors(spark, sf):
    return spatial.radius_neighbor_counts(fixtures.points(spark, sf), EPS_KM)


PAIR_EPS_KM = 0.5


@register("radius_neighbor_pairs", _rec(
    f"SELECT a.dr_no AS key_a, b.dr_no AS key_b, round({HAV}, 6) AS dist_km FROM pts a JOIN pts b ON {HAV} <= {PAIR_EPS_KM}", [PTS]))
def q_radius_neighbor_pairs(spark, sf):
    return rounded(spatial.radius_neighbors(fixtures.points(spark, sf), PAIR_EPS_KM))


@register("dbscan_hotspots", _rec("SELECT dr_no, cluster, core FROM lab", [PTS, DBSCAN]))
def q_dbscan_hotspots(spark, sf):
    out = spatial.dbscan_hotspots(fixtures.points(spark, sf), eps_km=EPS_KM, min_samples=MIN_SAMPLES)
    return out.select("dr_no", "cluster", "core")


@register("cluster_summary", _rec(
    "SELECT s.cluster, s.size, round(s.lat, 6) AS lat, round(s.lon, 6) AS lon, "
    "round(s.violent_share, 6) AS violent_share, t.top_crime FROM "
    "(SELECT cluster, count(dr_no) AS size, avg(lat) AS lat, avg(lon) AS lon, avg(is_violent) AS violent_share "
    " FROM lab WHERE cluster >= 0 GROUP BY cluster) s JOIN "
    "(SELECT cluster, crime_desc AS top_crime FROM (SELECT cluster, crime_desc, row_number() OVER "
    " (PARTITION BY cluster ORDER BY count(*) DESC, crime_desc) AS r FROM lab WHERE cluster >= 0 AND "
    " crime_desc IS NOT NULL GROUP BY cluster, crime_desc) WHERE r = 1) t USING (cluster)", [PTS, DBSCAN]))
def q_cluster_summary(spark, sf):
    clustered = spatial.dbscan_hotspots(fixtures.points(spark, sf), eps_km=EPS_KM, min_samples=MIN_SAMPLES)
    return rounded(spatial.cluster_summary(clustered))


@register("heat_points", with_ctes(*BASE, body="""
SELECT round(lat_key * CAST(0.0025 AS DOUBLE), 6) AS lat, round(lon_key * CAST(0.0025 AS DOUBLE), 6) AS lon, weight
FROM (SELECT CAST(round_even(lat / 0.0025, 0) AS BIGINT) AS lat_key, CAST(round_even(lon / 0.0025, 0) AS BIGINT) AS lon_key,
             count(*) AS weight
      FROM clean WHERE lat IS NOT NULL AND lon IS NOT NULL AND is_violent = 1 GROUP BY 1, 2)"""))
def q_heat_points(spark, sf):
    """All violent incidents with coordinates, binned to weighted cells."""
    return rounded(spatial.heat_points(common.clean(spark, sf, "dr_no", "lat", "lon", "is_violent"), violent_only=True, cell_deg=0.0025))
