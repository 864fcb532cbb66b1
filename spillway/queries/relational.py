"""Scans, filters, joins, aggregates, sorts, set operations."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Window
from pyspark.sql import functions as F

from spillway.functions import aggregates as G
from spillway.functions import temporal as D
from spillway.operators import relational as O
from spillway.operators.joins import asof_join, range_join
from spillway.operators.relational import Filters, of_type, per_concrete_type, per_type
from spillway.plans.command import capture, tagged, tags
from spillway.queries.registry import query, select
from spillway.sources import dynamic, files


def c(name):
    return F.col(name)


@contextmanager
def view(df, name):
    """A temporary view for as long as SQL over it is analysed; the frames that come of it do not need it any more."""
    df.createOrReplaceTempView(name)
    try:
        yield
    finally:
        df.sparkSession.catalog.dropTempView(name)


def money(x):
    return F.round(x, 2)


# -- sources -----------------------------------------------------------------------------------------------------------
@query("SELECT r_regionkey, r_name FROM region")
def scan_parquet(t):
    return files.scan_parquet(t.spark, f"{t.folder}/region.parquet")


@query("SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 2")
def scan_table(t):
    with view(t.nation, "spillway_nation"):
        return t.spark.table("spillway_nation").filter("n_regionkey = 2").select("n_nationkey", "n_name")


@query("SELECT * FROM (VALUES (1, 'one'), (2, 'two'), (3, NULL)) v(id, name)")
def values_inline(t):
    return files.values(t.spark, [(1, "one"), (2, "two"), (3, None)], "id int, name string")


@query("SELECT c_custkey FROM customer WHERE CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_nationkey END IN (3, 4) OR c_custkey % 5 = 0")
def parameter_collection(t):
    return t.customer.filter(files.is_any_of(F.when(c("c_custkey") % 5 != 0, c("c_nationkey")), [3, 4, None])).select("c_custkey")


@query("SELECT r_regionkey, r_name FROM region")
def scan_function(t):
    return files.scan_function(t.spark, "read_parquet", f"{t.folder}/region.parquet")


@query("SELECT n_regionkey, count(*) AS n FROM nation WHERE n_nationkey < 20 GROUP BY n_regionkey")
def raw_sql_composed(t):
    return dynamic.raw_sql(t.spark, "SELECT * FROM {nation} WHERE n_nationkey < :top", {"top": 20}, nation=t.nation).groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT n_name, n_regionkey + 1 AS next FROM nation WHERE n_name LIKE 'NATION_1%'")
def dynamic_sql(t):
    with view(t.nation, "spillway_dynamic"):
        return dynamic.query(t.spark, "SELECT n_name, n_regionkey + 1 AS next FROM spillway_dynamic WHERE n_name LIKE :p", {"p": "NATION_1%"}).frame()


# -- projections and filters -------------------------------------------------------------------------------------------
select("project_basic", "orders", "o_orderkey", {"customer": (lambda: c("o_custkey"), "o_custkey"), "dear": (lambda: c("o_totalprice") > 100000, "o_totalprice > 100000")})


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND NOT (o_totalprice < 1000 OR o_totalprice >= 200000)")
def filter_basic(t):
    return t.orders.filter((c("o_orderstatus") == "F") & ~((c("o_totalprice") < 1000) | (c("o_totalprice") >= 200000))).select("o_orderkey", "o_totalprice")


_NS = "CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_type END"


@query(f"SELECT p_partkey FROM part WHERE {_NS} IS DISTINCT FROM 'SMALL'")
def null_semantics(t):
    return t.part.filter(O.differs(F.when(c("p_partkey") % 4 != 0, c("p_type")), F.lit("SMALL"))).select("p_partkey")


@query("SELECT p_partkey FROM part WHERE p_brand IN ('Brand#12', 'Brand#23', 'Brand#31')")
def in_list(t):
    return t.part.filter(c("p_brand").isin("Brand#12", "Brand#23", "Brand#31")).select("p_partkey")


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def in_subquery(t):
    big = t.orders.filter("o_orderstatus = 'F'").select(c("o_custkey").alias("c_custkey"))
    return O.semi(t.customer, big, "c_custkey").select("c_custkey")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def not_in_subquery(t):
    return O.not_in(t.customer, "c_custkey", t.orders.filter("o_orderstatus = 'F'"), "o_custkey").select("c_custkey")


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 150000)")
def exists_subquery(t):
    return O.semi(t.customer, t.orders.filter("o_totalprice > 150000"), c("c_custkey") == c("o_custkey")).select("c_custkey")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)")
def not_exists_subquery(t):
    return O.anti(t.customer, t.orders.filter("o_totalprice > 300000"), c("c_custkey") == c("o_custkey")).select("c_custkey")


select("case_when", "orders", "o_orderkey", {"r": (lambda: F.when(c("o_totalprice") > 200000, "high").when(c("o_totalprice") > 50000, "middle").otherwise("low"), "CASE WHEN o_totalprice > 200000 THEN 'high' WHEN o_totalprice > 50000 THEN 'middle' ELSE 'low' END")})
select("coalesce_op", "part", "p_partkey", {"r": (lambda: F.coalesce(F.when(c("p_partkey") % 3 == 0, c("p_name")), c("p_type")), "coalesce(CASE WHEN p_partkey % 3 = 0 THEN p_name END, p_type)")})


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE (o_orderdate, o_orderkey) > (TIMESTAMP '1997-01-01', 500) ORDER BY o_orderdate, o_orderkey LIMIT 50")
def keyset_page(t):
    after = [F.lit("1997-01-01").cast("timestamp_ntz"), 500]
    return O.keyset_page(t.orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], after, 50)


@query("SELECT event_id, event_type FROM events WHERE event_type IN ('purchase', 'click') AND value > 10")
def inheritance_of_type(t):
    return t.events.filter(c("event_type").isin("purchase", "click") & (c("value") > 10)).select("event_id", "event_type")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P' AND o_totalprice > 100000")
def global_filter(t):
    with view(t.orders.filter("o_orderstatus <> 'P'"), "spillway_live_orders"):
        return t.spark.table("spillway_live_orders").filter("o_totalprice > 100000").select("o_orderkey")


# -- joins -------------------------------------------------------------------------------------------------------------
@query("SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def join_inner(t):
    return t.nation.join(t.region, c("n_regionkey") == c("r_regionkey")).select("n_name", "r_name")


@query("SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_totalprice > 200000")
def join_left(t):
    return t.customer.join(t.orders.filter("o_totalprice > 200000"), c("c_custkey") == c("o_custkey"), "left").select("c_custkey", "o_orderkey")


@query("SELECT o_orderkey, c_custkey FROM (SELECT * FROM orders WHERE o_totalprice > 200000) o RIGHT JOIN customer ON c_custkey = o_custkey")
def join_right(t):
    return t.orders.filter("o_totalprice > 200000").join(t.customer, c("c_custkey") == c("o_custkey"), "right").select("o_orderkey", "c_custkey")


@query("SELECT r_name, n_name FROM region CROSS JOIN nation")
def join_cross(t):
    return t.region.crossJoin(t.nation).select("r_name", "n_name")


@query("SELECT a.l_orderkey, a.l_linenumber, count(*) AS n FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber GROUP BY 1, 2")
def join_composite(t):
    # One side is counted by key first, so repeated keys do not meet in pairs.
    keys = ["l_orderkey", "l_linenumber"]
    per = t.lineitem.groupBy(*keys).agg(F.count(F.lit(1)).alias("m"))
    return t.lineitem.select(*keys).join(per, keys).groupBy(*keys).agg(F.sum("m").alias("n"))


@query("SELECT a.n_name AS a, b.n_name AS b FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey")
def join_theta(t):
    x, y = t.nation.alias("x"), t.nation.alias("y")
    return x.join(y, (c("x.n_regionkey") == c("y.n_regionkey")) & (c("x.n_nationkey") < c("y.n_nationkey"))).select(c("x.n_name").alias("a"), c("y.n_name").alias("b"))


_LATERAL = "SELECT c_custkey, o.o_orderkey, o.o_totalprice FROM customer {} JOIN LATERAL (SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F' ORDER BY o_totalprice DESC, o_orderkey LIMIT 2) o {}"


@query(_LATERAL.format("CROSS", ""))
def join_lateral_cross(t):
    best = t.orders.filter((c("o_custkey") == c("c_custkey").outer()) & (c("o_orderstatus") == "F")).orderBy(F.desc("o_totalprice"), "o_orderkey").limit(2).select("o_orderkey", "o_totalprice")
    return t.customer.select("c_custkey").lateralJoin(best, how="inner")


@query(_LATERAL.format("LEFT", "ON true"))
def join_lateral_left(t):
    best = t.orders.filter((c("o_custkey") == c("c_custkey").outer()) & (c("o_orderstatus") == "F")).orderBy(F.desc("o_totalprice"), "o_orderkey").limit(2).select("o_orderkey", "o_totalprice")
    return t.customer.select("c_custkey").lateralJoin(best, how="left")


@query("SELECT p_partkey, p_name FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49)")
def join_semi(t):
    return O.semi(t.part, t.lineitem.filter("l_quantity > 49"), c("p_partkey") == c("l_partkey")).select("p_partkey", "p_name")


@query("SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49)")
def join_anti(t):
    return O.anti(t.part, t.lineitem.filter("l_quantity > 49"), c("p_partkey") == c("l_partkey")).select("p_partkey")


@query("SELECT o_orderkey, c_name, n_name, r_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'")
def nav_join(t):
    homes = t.nation.join(t.region.filter("r_name = 'ASIA'"), c("n_regionkey") == c("r_regionkey"))
    return t.orders.join(t.customer, c("o_custkey") == c("c_custkey")).join(homes, c("c_nationkey") == c("n_nationkey")).select("o_orderkey", "c_name", "n_name", "r_name")


@query("SELECT r_name, coalesce(string_agg(n_name, ',' ORDER BY n_name), '') AS nations FROM region LEFT JOIN nation ON n_regionkey = r_regionkey AND n_nationkey > 5 GROUP BY r_name")
def include_nested(t):
    full = O.include(t.region, t.nation.filter("n_nationkey > 5"), "r_regionkey", "n_regionkey", "nations", ["n_name"], ["n_name"])
    return full.select("r_name", F.array_join(F.transform("nations", lambda x: x["n_name"]), ",").alias("nations"))


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey = 7))")
def tier_chain_join(t):
    roots = t.customer.filter("c_nationkey = 7")
    owned = O.semi(t.orders, roots, c("o_custkey") == c("c_custkey"))
    return O.semi(t.lineitem, owned, c("l_orderkey") == c("o_orderkey")).select("l_orderkey", "l_linenumber", "l_quantity")


@query("SELECT a.p_partkey FROM part a JOIN (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN NULL ELSE p_size END AS s FROM part) b ON a.p_partkey = b.p_partkey AND (CASE WHEN a.p_partkey % 2 = 0 THEN NULL ELSE a.p_size END) IS NOT DISTINCT FROM b.s")
def join_null_safe(t):
    side = t.part.select("p_partkey", F.when(c("p_partkey") % 2 != 0, c("p_size")).alias("s"))
    return side.alias("a").join(side.alias("b"), (c("a.p_partkey") == c("b.p_partkey")) & c("a.s").eqNullSafe(c("b.s"))).select("a.p_partkey")


@query("SELECT d.doc_id, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def join_files(t):
    return t.documents.select("doc_id").join(t.labels, "doc_id", "left")


# -- aggregates --------------------------------------------------------------------------------------------------------
_Q1 = """SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base_price,
  round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price, round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS sum_charge,
  round(avg(l_quantity), 6) AS avg_qty, round(avg(l_extendedprice), 6) AS avg_price, round(avg(l_discount), 6) AS avg_disc, count(*) AS count_order
  FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY l_returnflag, l_linestatus ORDER BY 1, 2"""


@query(_Q1)
def q1_pricing_summary(t):
    disc = c("l_extendedprice") * (1 - c("l_discount"))
    return (
        t.lineitem.filter(c("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            money(F.sum("l_quantity")).alias("sum_qty"),
            money(F.sum("l_extendedprice")).alias("sum_base_price"),
            money(F.sum(disc)).alias("sum_disc_price"),
            money(F.sum(disc * (1 + c("l_tax")))).alias("sum_charge"),
            F.round(F.avg("l_quantity"), 6).alias("avg_qty"),
            F.round(F.avg("l_extendedprice"), 6).alias("avg_price"),
            F.round(F.avg("l_discount"), 6).alias("avg_disc"),
            F.count(F.lit(1)).alias("count_order"),
        )
        .orderBy("l_returnflag", "l_linestatus")
    )


@query("SELECT round(sum(l_extendedprice * l_discount), 2) AS revenue FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1997-01-01' AND l_discount BETWEEN 0.05 AND 0.07 AND l_quantity < 24")
def q6_forecast_revenue(t):
    day = lambda s: F.lit(s).cast("timestamp_ntz")
    return t.lineitem.filter((c("l_shipdate") >= day("1996-01-01")) & (c("l_shipdate") < day("1997-01-01")) & c("l_discount").between(0.05, 0.07) & (c("l_quantity") < 24)).agg(money(F.sum(c("l_extendedprice") * c("l_discount"))).alias("revenue"))


@query("SELECT round(100.0 * sum(CASE WHEN p_type LIKE 'PROMO%' THEN l_extendedprice * (1 - l_discount) ELSE 0 END) / sum(l_extendedprice * (1 - l_discount)), 6) AS promo_revenue FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_shipdate >= TIMESTAMP '1996-09-01' AND l_shipdate < TIMESTAMP '1996-10-01'")
def q14_promotion_effect(t):
    day = lambda s: F.lit(s).cast("timestamp_ntz")
    month = t.lineitem.filter((c("l_shipdate") >= day("1996-09-01")) & (c("l_shipdate") < day("1996-10-01"))).select("l_partkey", (c("l_extendedprice") * (1 - c("l_discount"))).alias("v"))
    joined = month.join(t.part.select("p_partkey", c("p_type").startswith("PROMO").alias("promo")), c("l_partkey") == c("p_partkey"))
    return joined.agg(F.round(100.0 * F.sum(F.when(c("promo"), c("v")).otherwise(0)) / F.sum("v"), 6).alias("promo_revenue"))


@query("SELECT o_orderstatus, CAST(count(*) AS INT) AS n, count(CASE WHEN o_totalprice > 100000 THEN 1 END) AS dear FROM orders GROUP BY 1")
def agg_count(t):
    return t.orders.groupBy("o_orderstatus").agg(G.count(wide=False).alias("n"), G.count(c("o_totalprice") > 100000).alias("dear"))


@query("SELECT p_brand, CAST(sum(p_size) AS BIGINT) AS sizes, round(sum(p_retailprice), 2) AS price, coalesce(CAST(sum(CASE WHEN p_size > 1000 THEN p_size END) AS BIGINT), 0) AS none FROM part GROUP BY 1")
def agg_sum(t):
    return t.part.groupBy("p_brand").agg(G.total(c("p_size"), "bigint").alias("sizes"), money(G.total(c("p_retailprice"), "double")).alias("price"), G.total(c("p_size"), "bigint", c("p_size") > 1000, or_zero=True).alias("none"))


@query("SELECT p_brand, round(avg(CAST(p_size AS DOUBLE)), 9) AS size, round(avg(p_retailprice), 6) AS price FROM part GROUP BY 1")
def agg_avg(t):
    return t.part.groupBy("p_brand").agg(F.round(G.average(c("p_size")), 9).alias("size"), F.round(G.average(c("p_retailprice")), 6).alias("price"))


@query("SELECT o_orderpriority, min(o_totalprice) AS low, max(o_totalprice) AS high, min(o_orderdate) AS first, max(o_orderstatus) AS status FROM orders GROUP BY 1")
def agg_min_max(t):
    return t.orders.groupBy("o_orderpriority").agg(F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high"), F.min("o_orderdate").alias("first"), F.max("o_orderstatus").alias("status"))


@query("SELECT o_orderstatus, count(DISTINCT o_custkey) AS customers, CAST(sum(DISTINCT o_custkey) AS BIGINT) AS total FROM orders GROUP BY 1")
def agg_distinct(t):
    return t.orders.groupBy("o_orderstatus").agg(F.countDistinct("o_custkey").alias("customers"), F.sum_distinct("o_custkey").alias("total"))


@query("SELECT o_custkey, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS done, round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END), 2) AS paid FROM orders GROUP BY 1")
def agg_filtered(t):
    done = c("o_orderstatus") == "F"
    return t.orders.groupBy("o_custkey").agg(G.count(done).alias("done"), money(G.total(c("o_totalprice"), "double", done)).alias("paid"))


@query("SELECT p_brand, round(stddev_samp(p_retailprice), 6) AS s FROM part GROUP BY 1 UNION ALL SELECT 'single', round(stddev_samp(p_retailprice), 6) FROM part WHERE p_partkey = 1")
def agg_stddev(t):
    one = t.part.filter("p_partkey = 1").agg(F.lit("single").alias("p_brand"), F.round(G.stddev_sample(c("p_retailprice")), 6).alias("s"))
    return t.part.groupBy("p_brand").agg(F.round(G.stddev_sample(c("p_retailprice")), 6).alias("s")).unionAll(one)


_ARG = "SELECT o_custkey, {f}(CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey END, o_totalprice * 1000000 + o_orderkey % 1000000) AS r FROM orders GROUP BY 1"


@query(_ARG.format(f="arg_max"))
def agg_argmax(t):
    return t.orders.groupBy("o_custkey").agg(G.arg_max(F.when(c("o_orderkey") % 3 != 0, c("o_orderkey")), c("o_totalprice") * 1000000 + c("o_orderkey") % 1000000).alias("r"))


@query(_ARG.format(f="arg_min"))
def agg_argmin(t):
    return t.orders.groupBy("o_custkey").agg(G.arg_min(F.when(c("o_orderkey") % 3 != 0, c("o_orderkey")), c("o_totalprice") * 1000000 + c("o_orderkey") % 1000000).alias("r"))


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(avg(o_totalprice), 4) AS mean FROM orders GROUP BY 1, 2")
def group_by(t):
    return t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("o_totalprice"), 4).alias("mean"))


@query("SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n FROM orders GROUP BY 1")
def group_by_expr(t):
    return t.orders.groupBy(D.bucket(c("o_orderdate"), "month").alias("month")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT count(*) AS n, max(o_totalprice) AS top FROM orders")
def group_by_constant(t):
    return t.orders.groupBy(F.lit(1).alias("k")).agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("top")).drop("k")


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 12")
def having(t):
    return t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).filter("n > 12")


@query("SELECT count(*) AS n, count(*) > 0 AS some, bool_and(o_totalprice > 0) AS every, min(o_orderkey) AS low, max(o_orderkey) AS high, round(sum(o_totalprice), 2) AS total, round(avg(o_totalprice), 6) AS mean FROM orders")
def terminals(t):
    return t.orders.agg(F.count(F.lit(1)).alias("n"), (F.count(F.lit(1)) > 0).alias("some"), F.every(c("o_totalprice") > 0).alias("every"), F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high"), money(F.sum("o_totalprice")).alias("total"), F.round(F.avg("o_totalprice"), 6).alias("mean"))


@query("SELECT c_custkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n, (SELECT round(max(o_totalprice), 2) FROM orders WHERE o_custkey = c_custkey) AS top FROM customer")
def corr_scalar_agg(t):
    # The planner's own rewrite of correlated aggregates: group once, join back, count of nothing is 0.
    per = t.orders.groupBy(c("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"), money(F.max("o_totalprice")).alias("top"))
    return t.customer.select("c_custkey").join(per, "c_custkey", "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("n"), "top")


@query("SELECT n_regionkey, string_agg(n_name, '|' ORDER BY n_name) AS names FROM nation GROUP BY 1")
def group_collect(t):
    return t.nation.groupBy("n_regionkey").agg(F.array_join(F.sort_array(F.collect_list("n_name")), "|").alias("names"))


@query("SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct(t):
    return t.orders.select("o_orderstatus", "o_orderpriority").distinct()


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def dup_keys(t):
    return O.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


# -- windows, sorts, limits --------------------------------------------------------------------------------------------
@query("SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def win_row_number(t):
    at = F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")))
    return t.orders.withColumn("at", at).filter("at = 1").select("o_custkey", "o_orderkey")


@query("SELECT c_nationkey, c_custkey, c_acctbal FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) <= 3")
def win_topn_per_group(t):
    return O.top_per_group(t.customer.select("c_nationkey", "c_custkey", "c_acctbal"), ["c_nationkey"], ["-c_acctbal", "c_custkey"], 3)


@query("SELECT event_id, rank() OVER w AS r, dense_rank() OVER w AS d, lag(value) OVER w AS before, sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) >= 0 AS positive FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
def win_raw_sql(t):
    return dynamic.raw_sql(t.spark, "SELECT event_id, CAST(rank() OVER w AS BIGINT) AS r, CAST(dense_rank() OVER w AS BIGINT) AS d, lag(value) OVER w AS before, sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) >= 0 AS positive FROM {events} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)", events=t.events)


_NK = "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END"


@query(f"SELECT o_orderkey, p FROM (SELECT o_orderkey, {_NK} AS p FROM orders) ORDER BY p ASC NULLS LAST, o_orderkey DESC")
def order_by(t):
    keyed = t.orders.select("o_orderkey", F.when(c("o_orderkey") % 5 != 0, c("o_orderpriority")).alias("p"))
    return O.order_by(keyed, "p", "-o_orderkey")


@query(f"SELECT o_orderkey, p FROM (SELECT o_orderkey, {_NK} AS p FROM orders) ORDER BY p ASC NULLS FIRST, o_orderkey")
def order_by_nulls_first(t):
    keyed = t.orders.select("o_orderkey", F.when(c("o_orderkey") % 5 != 0, c("o_orderpriority")).alias("p"))
    return O.order_by(keyed, "p", "o_orderkey", nulls_first=True)


@query("SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 25")
def limit(t):
    return O.page(t.orders.select("o_orderkey"), ["o_orderkey"], take=25)


@query("SELECT o_orderkey FROM orders ORDER BY o_orderkey OFFSET 14000")
def offset(t):
    return O.page(t.orders.select("o_orderkey"), ["o_orderkey"], skip=14000)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def top_k(t):
    return O.page(t.orders.select("o_orderkey", "o_totalprice"), ["-o_totalprice", "o_orderkey"], take=20)


@query("SELECT * FROM (SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 500) WHERE o_orderstatus = 'F'")
def filter_after_limit(t):
    return O.page(t.orders.select("o_orderkey", "o_orderstatus"), ["o_orderkey"], take=500).filter("o_orderstatus = 'F'")


@query("SELECT o_orderkey FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 10")
def reverse(t):
    return O.page(t.orders.select("o_orderkey", "o_orderdate"), O.reverse(["o_orderdate", "o_orderkey"]), take=10).select("o_orderkey")


@query("SELECT o_orderkey FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1")
def last_element(t):
    return O.page(t.orders.select("o_orderkey", "o_orderdate"), O.reverse(["o_orderdate", "o_orderkey"]), take=1).select("o_orderkey")


@query("SELECT o_orderkey FROM orders ORDER BY o_orderkey OFFSET 7 LIMIT 1")
def element_at(t):
    return O.page(t.orders.select("o_orderkey"), ["o_orderkey"], skip=7, take=1)


@query()
def random(t):
    """Rows in random order: another one each time, so only their number is fixed."""
    return t.nation.withColumn("r", F.rand()).orderBy("r")


@query()
def new_uuid(t):
    return t.nation.select("n_nationkey", F.uuid().alias("id"))


@query()
def current_times(t):
    return t.region.select("r_regionkey", F.localtimestamp().alias("now"), F.current_timestamp().alias("utc_now"), F.current_date().alias("today"))


# -- set operations ----------------------------------------------------------------------------------------------------
def _sides(t):
    return t.customer.filter("c_acctbal > 5000").select("c_nationkey"), t.supplier.filter("s_acctbal > 0").select(c("s_nationkey").alias("c_nationkey"))


_L, _R = "SELECT c_nationkey FROM customer WHERE c_acctbal > 5000", "SELECT s_nationkey FROM supplier WHERE s_acctbal > 0"


@query(f"{_L} UNION ALL {_R}")
def union_all(t):
    a, b = _sides(t)
    return a.unionAll(b)


@query(f"{_L} UNION {_R}")
def union_distinct(t):
    a, b = _sides(t)
    return a.union(b).distinct()


@query(f"{_L} INTERSECT {_R}")
def intersect(t):
    a, b = _sides(t)
    return a.intersect(b)


@query(f"{_L} AND c_nationkey < 30 EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 8000")
def except_(t):
    a, _ = _sides(t)
    return a.subtract(t.supplier.filter("s_acctbal > 8000").select("s_nationkey"))


@query("SELECT n_nationkey AS k, n_name AS name, NULL::VARCHAR AS segment FROM nation UNION ALL SELECT c_custkey, NULL, c_mktsegment FROM customer")
def union_by_name(t):
    return O.union_by_name(t.nation.select(c("n_nationkey").cast("bigint").alias("k"), c("n_name").alias("name")), t.customer.select(c("c_custkey").alias("k"), c("c_mktsegment").alias("segment")))


# -- introspection and beyond ------------------------------------------------------------------------------------------
@query("SELECT CAST(count(*) AS INT) AS value FROM orders WHERE o_totalprice > 100000")
def plan_count(t):
    with view(t.orders, "spillway_orders"):
        return capture("SELECT * FROM spillway_orders WHERE o_totalprice > :p", "count", p=100000).frame(t.spark)


@query("SELECT count(*) > 0 AS value FROM orders WHERE o_totalprice > 100000")
def plan_any(t):
    with view(t.orders, "spillway_orders"):
        return capture("SELECT * FROM spillway_orders WHERE o_totalprice > :p", "any", p=100000).frame(t.spark)


@query("SELECT round(avg(o_totalprice), 6) AS value FROM orders WHERE o_totalprice < 0")
def plan_average_of_none(t):
    with view(t.orders, "spillway_orders"):
        return capture("SELECT * FROM spillway_orders WHERE o_totalprice < :p", "average", "o_totalprice", p=0).frame(t.spark).select(F.round("value", 6).alias("value"))


@query("SELECT max(o_totalprice) AS value FROM orders")
def plan_max(t):
    with view(t.orders, "spillway_orders"):
        return capture("SELECT * FROM spillway_orders", "max", "o_totalprice").frame(t.spark)


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)")
def raw_cube(t):
    return t.orders.cube("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def stream_windows(t):
    from spillway.streaming.sinks import windowed_counts

    return windowed_counts(t.events, "ts", ["event_type"], "value").select(c("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", F.round("total", 4).alias("total"))





# -- joins by order, models, grouping sets ------------------------------------------------------------------------------
_VIEWS = "SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_type = 'view' GROUP BY 1, 2"


@query(f"SELECT e.event_id, v.ts AS view_ts, v.event_id AS view_id FROM (SELECT * FROM events WHERE event_type = 'purchase') e ASOF LEFT JOIN ({_VIEWS}) v ON e.user_id = v.user_id AND e.ts >= v.ts")
def join_asof(t):
    """Each purchase with its user's last view before it; a user's events are dealt to days."""
    buys = t.events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    views = t.events.filter("event_type = 'view'").groupBy("user_id", F.col("ts").alias("view_ts")).agg(F.max("event_id").alias("view_id"))
    return asof_join(buys, views, ["user_id"], "ts", "view_ts", ["view_id"], bucket=F.col("__at").cast("date")).select("event_id", "view_ts", "view_id")


@query("SELECT a.event_id, b.event_id AS error_id FROM events a JOIN events b ON a.event_type = 'click' AND b.event_type = 'error' AND a.ts >= b.ts AND a.ts < b.ts + INTERVAL '10 minutes'")
def join_range(t):
    """Clicks in the ten minutes after an error."""
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    clicks = t.events.filter("event_type = 'click'").select("event_id", seconds.alias("s"))
    errors = t.events.filter("event_type = 'error'").select(F.col("event_id").alias("error_id"), seconds.alias("low"), (seconds + 600).alias("high"))
    return range_join(clicks, errors, F.col("s"), F.col("low"), F.col("high"), 600.0).select("event_id", "error_id")


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n, CAST(grouping(o_orderstatus) * 2 + grouping(o_orderpriority) AS BIGINT) AS level FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)")
def group_rollup(t):
    return t.orders.rollup("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("level"))


@query("SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY GROUPING SETS ((c_nationkey), (c_mktsegment), ())")
def grouping_sets(t):
    a, b = F.col("c_nationkey"), F.col("c_mktsegment")
    return t.customer.groupingSets([[a], [b], []], a, b).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT 'customer' AS discriminator, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer UNION ALL SELECT 'supplier', s_name, s_acctbal, NULL FROM supplier")
def inheritance_per_concrete_type(t):
    customers = t.customer.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    suppliers = t.supplier.select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return per_concrete_type(customer=customers, supplier=suppliers)


@query("SELECT p_partkey, p_name, CASE WHEN p_size > 40 THEN p_brand END AS brand, CASE WHEN p_size < 5 THEN p_retailprice END AS price, CASE WHEN p_size > 40 THEN 'large' ELSE 'small' END AS discriminator FROM part WHERE p_size > 40 OR p_size < 5")
def inheritance_per_type(t):
    large = t.part.filter("p_size > 40").select("p_partkey", F.col("p_brand").alias("brand"))
    small = t.part.filter("p_size < 5").select("p_partkey", F.col("p_retailprice").alias("price"))
    return of_type(per_type(t.part.select("p_partkey", "p_name"), "p_partkey", large=large, small=small), "large", "small")


@query("SELECT 'all' AS how, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' AND o_totalprice > 1000 UNION ALL SELECT 'one ignored', count(*) FROM orders WHERE o_totalprice > 1000 UNION ALL SELECT 'none', count(*) FROM orders")
def global_filters(t):
    rules = Filters()
    rules.add("orders", "open", F.col("o_orderstatus") != "P")
    rules.add("orders", "large", F.col("o_totalprice") > 1000)
    count = lambda how, ignore: rules.apply("orders", t.orders, ignore).agg(F.lit(how).alias("how"), F.count(F.lit(1)).alias("n"))
    return count("all", ()).unionAll(count("one ignored", ["open"])).unionAll(count("none", True))


@query("SELECT 'large parts' AS tag, count(*) AS n FROM part WHERE p_size > 40")
def query_tags(t):
    """Tags stand in front of the SQL and on the jobs that it runs."""
    with view(t.part, "spillway_tagged_part"):
        plan = capture(tagged("SELECT * FROM spillway_tagged_part WHERE p_size > 40", "large parts"), "long_count")
        with tags(t.spark, "large parts"):
            n, seen = plan.replay(t.spark), sorted(t.spark.getTags())
        return t.spark.createDataFrame([(", ".join(x for x in seen if "large parts" in x and "-- large parts" in plan.sql), n)], "tag string, n bigint")
