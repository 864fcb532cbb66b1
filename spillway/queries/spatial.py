"""Planar geometry over points and boxes made of numbers of a row; the SQL side uses plain arithmetic."""

from __future__ import annotations

from pyspark.sql import functions as F

from spillway.operators import overlay as V
from spillway.operators import spatial as G
from spillway.queries.registry import query


def _points(t):
    return t.customer.select("c_custkey", "c_nationkey", G.st_point(F.col("c_nationkey"), F.round(F.col("c_acctbal") / 1000)).alias("p"))


_SQL = "SELECT c_custkey, c_nationkey, CAST(c_nationkey AS DOUBLE) AS x, round(c_acctbal / 1000) AS y FROM customer"


@query(f"SELECT c_custkey, round(sqrt(power(x - 3, 2) + power(y - 4, 2)), 9) AS d, sqrt(power(x - 3, 2) + power(y - 4, 2)) <= 5 AS near FROM ({_SQL})")
def spatial_distance(t):
    at = F.lit("POINT (3 4)")
    return _points(t).select("c_custkey", F.round(G.st_distance(F.col("p"), at), 9).alias("d"), G.st_dwithin(F.col("p"), at, 5.0).alias("near"))


@query(f"SELECT c_custkey, x > 2 AND x < 20 AND y > 0 AND y < 6 AS within, x BETWEEN 2 AND 20 AND y BETWEEN 0 AND 6 AND NOT (x > 2 AND x < 20 AND y > 0 AND y < 6) AS touches, NOT (x BETWEEN 2 AND 20 AND y BETWEEN 0 AND 6) AS disjoint FROM ({_SQL})")
def spatial_relations(t):
    box = F.lit("POLYGON ((2 0, 20 0, 20 6, 2 6, 2 0))")
    return _points(t).select("c_custkey", *[G.st_relate(r, F.col("p"), box).alias(r) for r in ("within", "touches", "disjoint")])


@query(f"SELECT c_nationkey, min(x) AS min_x, min(y) + 0.0 AS min_y, max(x) AS max_x, max(y) + 0.0 AS max_y FROM ({_SQL}) GROUP BY 1")
def spatial_envelope(t):
    bounds = _points(t).groupBy("c_nationkey").agg(*G.st_envelope_agg(F.col("p")))
    return bounds.withColumns({"min_y": F.col("min_y") + 0.0, "max_y": F.col("max_y") + 0.0})


@query("SELECT c_custkey, CAST((c_nationkey + 1) * 3 AS DOUBLE) AS area, CAST(5 AS INT) AS points, 'POLYGON' AS kind FROM customer")
def spatial_properties(t):
    side = (F.col("c_nationkey") + 1).cast("string")
    box = F.concat(F.lit("POLYGON ((0 0, "), side, F.lit(" 0, "), side, F.lit(" 3, 0 3, 0 0))"))
    shaped = t.customer.select("c_custkey", box.alias("g"))
    return shaped.select("c_custkey", G.st("area", F.col("g")).alias("area"), G.st("num_points", F.col("g")).alias("points"), G.st("geometry_type", F.col("g")).alias("kind"))


# -- boxes: x0 to x1 and y0 to y1 by part, against the box 10 to 30 and 10 to 20 ----------------------------------------
_BOX = "SELECT p_partkey, CAST(p_size % 40 AS DOUBLE) AS x0, CAST(p_size % 40 + 1 + p_partkey % 25 AS DOUBLE) AS x1, CAST(p_partkey % 23 AS DOUBLE) AS y0, CAST(p_partkey % 23 + 1 + p_size % 12 AS DOUBLE) AS y1 FROM part"
_FIXED = "POLYGON ((10 10, 30 10, 30 20, 10 20, 10 10))"
_W, _H = "(least(x1, 30.0) - greatest(x0, 10.0))", "(least(y1, 20.0) - greatest(y0, 10.0))"
_OWN = "((x1 - x0) * (y1 - y0))"
_SHARED = f"CASE WHEN {_W} > 0 AND {_H} > 0 THEN {_W} * {_H} ELSE 0.0 END"


def _boxes(t):
    x0, y0 = F.col("p_size") % 40, F.col("p_partkey") % 23
    x1, y1 = x0 + 1 + F.col("p_partkey") % 25, y0 + 1 + F.col("p_size") % 12
    a, b, c, d = (v.cast("string") for v in (x0, y0, x1, y1))
    corner = lambda x, y: F.concat(x, F.lit(" "), y)
    return t.part.select("p_partkey", "p_size", F.concat(F.lit("POLYGON (("), F.concat_ws(", ", corner(a, b), corner(c, b), corner(c, d), corner(a, d), corner(a, b)), F.lit("))")).alias("g"))


@query(
    f"""SELECT p_partkey, {_W} >= 0 AND {_H} >= 0 AS intersects, NOT ({_W} >= 0 AND {_H} >= 0) AS disjoint,
x0 <= 10 AND x1 >= 30 AND y0 <= 10 AND y1 >= 20 AS covers, x0 <= 10 AND x1 >= 30 AND y0 <= 10 AND y1 >= 20 AS contains,
x0 >= 10 AND x1 <= 30 AND y0 >= 10 AND y1 <= 20 AS coveredby, x0 >= 10 AND x1 <= 30 AND y0 >= 10 AND y1 <= 20 AS within,
x0 = 10 AND x1 = 30 AND y0 = 10 AND y1 = 20 AS equals, {_W} >= 0 AND {_H} >= 0 AND NOT ({_W} > 0 AND {_H} > 0) AS touches, false AS crosses,
{_W} > 0 AND {_H} > 0 AND NOT (x0 <= 10 AND x1 >= 30 AND y0 <= 10 AND y1 >= 20) AND NOT (x0 >= 10 AND x1 <= 30 AND y0 >= 10 AND y1 <= 20) AS overlaps
FROM ({_BOX})"""
)
def spatial_all_relations(t):
    return G.spread(_boxes(t), "g").select("p_partkey", *[G.st_relate(r, F.col("g"), F.lit(_FIXED)).alias(r) for r in G.RELATIONS])


@query(f"SELECT p_partkey, round({_SHARED}, 6) + 0.0 AS intersection, round({_OWN} + 200.0 - {_SHARED}, 6) AS union_, round({_OWN} - {_SHARED}, 6) + 0.0 AS difference, round({_OWN} + 200.0 - 2 * {_SHARED}, 6) + 0.0 AS symmetric_difference FROM ({_BOX})")
def spatial_overlays(t):
    area = lambda op: F.round(G.st("area", V.st_overlay(op, F.col("g"), F.lit(_FIXED))), 6) + 0.0
    return G.spread(_boxes(t), "g").select("p_partkey", *[area(op).alias(op if op != "union" else "union_") for op in ("intersection", "union", "difference", "symmetric_difference")])


@query(f"SELECT p_partkey, round(0.5 * 32 * 4.0 * sin(2 * pi() / 32), 6) AS around_point, round((x1 - x0) * (y1 - y0) + 2 * ((x1 - x0) + (y1 - y0)) * 0.5 + 0.5 * 32 * 0.25 * sin(2 * pi() / 32), 6) AS around_box FROM ({_BOX})")
def spatial_buffer(t):
    point = G.st_point(F.col("p_size"), F.lit(1))
    return G.spread(_boxes(t), "g").select("p_partkey", F.round(G.st("area", V.st_buffer(point, 2.0)), 6).alias("around_point"), F.round(G.st("area", V.st_buffer(F.col("g"), 0.5)), 6).alias("around_box"))


@query(f"SELECT p_partkey, CAST(93 AS INT) AS bytes, {_OWN} AS area, true AS valid, CAST(3 AS INT) AS code, true AS inside FROM ({_BOX})")
def spatial_binary_and_validity(t):
    wkb = V.st_as_binary(F.col("g"))
    inside = G.st_relate("within", V.st_more("interior_point", F.col("g")), F.col("g"))
    return _boxes(t).select("p_partkey", F.length(wkb).alias("bytes"), G.st("area", V.st_from_binary(wkb)).alias("area"), V.st_more("is_valid", F.col("g")).alias("valid"), V.st_more("ogc_type", F.col("g")).alias("code"), inside.alias("inside"))


@query("SELECT c_custkey, 'POINT (' || c_nationkey || ' 1)' AS first, CAST(NULL AS VARCHAR) AS third, 'LINESTRING (1 1, 2 1, 2 2, 1 1)' AS hole, CAST(4326 AS INT) AS srid, CAST(c_nationkey AS DOUBLE) AS z, c_nationkey % 2 = 0 AS ring FROM customer")
def spatial_accessors(t):
    n = F.col("c_nationkey").cast("string")
    points = F.concat(F.lit("MULTIPOINT ("), n, F.lit(" 1, 7 7)"))
    deep = F.concat(F.lit("SRID=4326;POINT Z (1 2 "), n, F.lit(")"))
    line = F.when(F.col("c_nationkey") % 2 == 0, F.lit("LINESTRING (0 0, 1 0, 1 1, 0 0)")).otherwise(F.lit("LINESTRING (0 0, 2 2, 2 0, 0 2, 0 0)"))
    holed = F.lit("POLYGON ((0 0, 9 0, 9 9, 0 9, 0 0), (1 1, 2 1, 2 2, 1 1))")
    return t.customer.select("c_custkey", V.st_geometry_n(points, 0).alias("first"), V.st_geometry_n(points, 2).alias("third"), V.st_interior_ring_n(holed, 0).alias("hole"), V.st_srid(deep).alias("srid"), V.st_ordinate("z", deep).alias("z"), V.st_more("is_ring", line).alias("ring"))


@query("SELECT c_nationkey, CAST(count(DISTINCT c_custkey % 7) AS DOUBLE) AS area, CAST(max(c_custkey % 7) - min(c_custkey % 7) + 1 AS DOUBLE) AS hull, count(*) AS n FROM customer GROUP BY 1")
def spatial_union_agg(t):
    """Unit squares side by side; those at one place count once in the union."""
    x, x1 = (F.col("c_custkey") % 7).cast("string"), (F.col("c_custkey") % 7 + 1).cast("string")
    square = F.concat(F.lit("POLYGON (("), x, F.lit(" 0, "), x1, F.lit(" 0, "), x1, F.lit(" 1, "), x, F.lit(" 1, "), x, F.lit(" 0))"))
    rows = t.customer.select("c_nationkey", square.alias("g"))
    one = V.st_union_by(rows, ["c_nationkey"], "g").select("c_nationkey", F.round(G.st("area", F.col("geometry")), 6).alias("area"))
    hull = V.st_convex_hull_by(rows, ["c_nationkey"], "g").select("c_nationkey", F.round(G.st("area", F.col("geometry")), 6).alias("hull"))
    held = V.st_collect_by(rows, ["c_nationkey"], "g").select("c_nationkey", G.st("num_geometries", F.col("geometry")).cast("bigint").alias("n"))
    return one.join(hull, "c_nationkey").join(held, "c_nationkey")


@query(f"SELECT p_size, min(x0) AS min_x, min(y0) AS min_y, max(x1) AS max_x, max(y1) AS max_y FROM (SELECT b.*, p.p_size FROM ({_BOX}) b JOIN part p USING (p_partkey)) GROUP BY 1")
def spatial_envelope_of_boxes(t):
    return _boxes(t).groupBy("p_size").agg(*G.st_envelope_agg(F.col("g")))
