"""Relational, windowed and streaming queries on the star schema and the events."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from sparkloom.operators import relational as R
from sparkloom.plans.base import Tables, query
from sparkloom.streaming import operators as S

_REVENUE = "l_extendedprice * (1 - l_discount)"


@query("rel_pricing_summary", f"""SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum({_REVENUE}), 2) AS sum_revenue, round(avg(l_discount), 6) AS avg_disc, count(*) AS n
FROM {{lineitem}} WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY l_returnflag, l_linestatus""")
def _(t: Tables):
    rows = t("lineitem").filter(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp"))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.expr(_REVENUE)), 2).alias("sum_revenue"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("n"))


@query("rel_star_join", f"""SELECT r_name, n_name, round(sum({_REVENUE}), 2) AS revenue FROM {{lineitem}} JOIN {{orders}} ON o_orderkey = l_orderkey JOIN {{customer}} ON c_custkey = o_custkey JOIN {{nation}} ON n_nationkey = c_nationkey JOIN {{region}} ON r_regionkey = n_regionkey GROUP BY r_name, n_name""")
def _(t: Tables):
    lines = t("lineitem").select("l_orderkey", F.expr(_REVENUE).alias("v"))
    rows = lines.join(t("orders").select("o_orderkey", "o_custkey"), F.col("o_orderkey") == F.col("l_orderkey")).join(t("customer").select("c_custkey", "c_nationkey"), F.col("c_custkey") == F.col("o_custkey"))
    rows = rows.join(t("nation"), F.col("n_nationkey") == F.col("c_nationkey")).join(t("region"), F.col("r_regionkey") == F.col("n_regionkey"))
    return rows.groupBy("r_name", "n_name").agg(F.round(F.sum("v"), 2).alias("revenue"))


@query("rel_semi_anti", "SELECT c_mktsegment, count(*) FILTER (WHERE c_custkey IN (SELECT o_custkey FROM orders)) AS buyers, count(*) FILTER (WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)) AS others FROM {customer} GROUP BY 1")
def _(t: Tables):
    o = t("orders").select(F.col("o_custkey").alias("c_custkey"))
    a = t("customer").join(o, "c_custkey", "left_semi").groupBy("c_mktsegment").agg(F.count("*").alias("buyers"))
    b = t("customer").join(o, "c_custkey", "left_anti").groupBy("c_mktsegment").agg(F.count("*").alias("others"))
    return a.join(b, "c_mktsegment", "full").select("c_mktsegment", F.coalesce("buyers", F.lit(0)).alias("buyers"), F.coalesce("others", F.lit(0)).alias("others"))


@query("rel_outer_joins", "SELECT n_name, count(s_suppkey) AS suppliers FROM {nation} LEFT JOIN {supplier} ON s_nationkey = n_nationkey AND s_acctbal > 5000 GROUP BY n_name")
def _(t: Tables):
    s = t("supplier").filter("s_acctbal > 5000")
    return t("nation").join(s, F.col("s_nationkey") == F.col("n_nationkey"), "left").groupBy("n_name").agg(F.count("s_suppkey").alias("suppliers"))


for _kind, _clause in (("rollup", "ROLLUP (l_returnflag, l_linestatus)"), ("cube", "CUBE (l_returnflag, l_linestatus)")):

    @query(f"rel_{_kind}", f"SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_linenumber) AS lines FROM {{lineitem}} GROUP BY {_clause}")
    def _(t: Tables, kind=_kind):
        return getattr(t("lineitem"), kind)("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum("l_linenumber").alias("lines"))


@query("rel_grouping_sets", "SELECT l_returnflag, l_linestatus, grouping(l_returnflag) AS g, count(*) AS n FROM {lineitem} GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), ())")
def _(t: Tables):
    return t.sql("SELECT l_returnflag, l_linestatus, CAST(grouping(l_returnflag) AS BIGINT) AS g, count(*) AS n FROM {lineitem} GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), ())")


@query("rel_pivot", "SELECT l_returnflag, count(*) FILTER (WHERE l_linestatus = 'F') AS f, count(*) FILTER (WHERE l_linestatus = 'O') AS o FROM {lineitem} GROUP BY 1")
def _(t: Tables):
    out = t("lineitem").groupBy("l_returnflag").pivot("l_linestatus", ["F", "O"]).count()
    return out.select("l_returnflag", F.coalesce("F", F.lit(0)).alias("f"), F.coalesce("O", F.lit(0)).alias("o"))


@query("rel_ranking", """SELECT l_orderkey, l_linenumber, rank() OVER w AS rnk, dense_rank() OVER w AS dense, ntile(3) OVER (PARTITION BY l_orderkey ORDER BY l_quantity, l_linenumber) AS tile, round(percent_rank() OVER w, 6) AS pct FROM {lines} WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_quantity)""")
def _(t: Tables):
    w = Window.partitionBy("l_orderkey").orderBy("l_quantity")
    tile = F.ntile(3).over(Window.partitionBy("l_orderkey").orderBy("l_quantity", "l_linenumber"))
    return t("lines").select("l_orderkey", "l_linenumber", F.rank().over(w).cast("long").alias("rnk"), F.dense_rank().over(w).cast("long").alias("dense"), tile.cast("long").alias("tile"), F.round(F.percent_rank().over(w), 6).alias("pct"))


@query("rel_set_operations", "SELECT 'intersect' AS op, count(*) AS n FROM (SELECT c_nationkey FROM {customer} INTERSECT SELECT s_nationkey FROM {supplier}) UNION ALL SELECT 'except_all', count(*) FROM (SELECT c_nationkey FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier) UNION ALL SELECT 'union', count(*) FROM (SELECT c_nationkey FROM customer UNION SELECT s_nationkey FROM supplier)")
def _(t: Tables):
    c, s = t("customer").select("c_nationkey"), t("supplier").select(F.col("s_nationkey").alias("c_nationkey"))
    parts = [("intersect", c.intersect(s)), ("except_all", c.exceptAll(s)), ("union", c.union(s).distinct())]
    out = None
    for name, df in parts:
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("op"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("rel_correlated_subquery", "SELECT count(*) AS n, round(sum(l_extendedprice), 2) AS total FROM {lineitem} l WHERE l_quantity < (SELECT 0.5 * avg(l_quantity) FROM lineitem x WHERE x.l_partkey = l.l_partkey)")
def _(t: Tables):
    return t.sql("SELECT count(*) AS n, round(sum(l_extendedprice), 2) AS total FROM {lineitem} l WHERE l_quantity < (SELECT 0.5 * avg(l_quantity) FROM {lineitem} x WHERE x.l_partkey = l.l_partkey)")


_HALVED = """WITH RECURSIVE s(c_custkey, rest, depth) AS (SELECT c_custkey, CAST(c_custkey AS BIGINT), 0 FROM {customer}
UNION ALL SELECT c_custkey, CAST(floor(rest / 2) AS BIGINT), depth + 1 FROM s WHERE rest > 1) SELECT c_custkey, max(depth) AS depth FROM s GROUP BY c_custkey"""


@query("rel_recursive_cte", _HALVED)
def _(t: Tables):
    """How often a customer's key can be halved. Spark ends a recursion after a million rows unless all are asked for."""
    return t.sql(_HALVED.replace("FROM s GROUP BY", "FROM (SELECT * FROM s LIMIT ALL) GROUP BY"))


@query("rel_decimals", "SELECT o_orderstatus, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DECIMAL(28, 2)) AS total FROM {orders} GROUP BY 1")
def _(t: Tables):
    return t("orders").groupBy("o_orderstatus").agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(28,2)").alias("total"))


@query("rel_interval_arithmetic", "SELECT o_orderkey, o_orderdate + INTERVAL 90 DAY AS due, date_diff('day', o_orderdate, TIMESTAMP '1999-01-01') AS age FROM {orders}")
def _(t: Tables):
    return t("orders").select("o_orderkey", (F.col("o_orderdate") + F.expr("INTERVAL 90 DAYS")).alias("due"), F.date_diff(F.lit("1999-01-01").cast("timestamp"), F.col("o_orderdate")).cast("long").alias("age"))


@query("rel_approximate")
def _(t: Tables):
    return t("lineitem").groupBy("l_returnflag").agg(F.approx_count_distinct("l_orderkey", 0.02).alias("orders"), F.percentile_approx("l_quantity", 0.5, 1000).alias("median"))


@query("rel_top_k_per_group", "SELECT o_custkey, o_orderkey, r FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM {orders}) WHERE r <= 2")
def _(t: Tables):
    r = F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.col("o_totalprice").desc(), "o_orderkey"))
    return t("orders").select("o_custkey", "o_orderkey", r.cast("long").alias("r")).filter("r <= 2")


@query("rel_asof_join", "SELECT a.event_id, b.event_id AS last_purchase FROM (SELECT * FROM {events} WHERE event_type <> 'purchase') a ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') b ON a.user_id = b.user_id AND a.event_id >= b.event_id")
def _(t: Tables):
    e = t("events").select("event_id", "user_id", "event_type")
    right = e.filter("event_type = 'purchase'").select("user_id", "event_id", F.col("event_id").alias("last_purchase"))
    return R.asof_join(e.filter("event_type <> 'purchase'").select("user_id", "event_id"), right, "user_id", "event_id", ["last_purchase"]).select("event_id", "last_purchase")


@query("rel_bucketed_asof_join", "SELECT a.event_id, b.event_id AS last_purchase, b.value AS last_value FROM (SELECT * FROM {events} WHERE event_type <> 'purchase') a ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') b ON a.user_id % 3 = b.user_id % 3 AND a.event_id >= b.event_id")
def _(t: Tables):
    """Three hot keys, whose rows are many buckets."""
    e = t("events").select("event_id", (F.col("user_id") % 3).alias("k"), "event_type", "value")
    right = e.filter("event_type = 'purchase'").select("k", "event_id", F.col("event_id").alias("last_purchase"), F.col("value").alias("last_value"))
    left = e.filter("event_type <> 'purchase'").select("k", "event_id")
    return R.bucketed_asof_join(left, right, "k", "event_id", ["last_purchase", "last_value"], 2000).select("event_id", "last_purchase", "last_value")


@query("rel_range_join", "SELECT s_suppkey, count(*) AS n FROM {lineitem} JOIN (SELECT s_suppkey, s_suppkey * 10 AS low, s_suppkey * 10 + 25 AS high FROM {supplier}) ON l_partkey >= low AND l_partkey < high GROUP BY s_suppkey")
def _(t: Tables):
    ranges = t("supplier").select("s_suppkey", (F.col("s_suppkey") * 10).alias("low"), (F.col("s_suppkey") * 10 + 25).alias("high"))
    return R.range_join(t("lineitem").select("l_partkey"), ranges, "l_partkey", "low", "high", 32).groupBy("s_suppkey").agg(F.count("*").alias("n"))


_INTERVALS = "SELECT event_id, user_id % 20 AS k, CAST(event_id AS BIGINT) AS start_, CAST(event_id + event_id % 60 AS BIGINT) AS end_, event_type FROM {events}"


@query("rel_overlap_join", f"WITH i AS ({_INTERVALS}) SELECT a.event_id, b.event_id AS other, least(a.end_, b.end_) - greatest(a.start_, b.start_) AS shared FROM i a JOIN i b ON a.k = b.k AND a.start_ < b.end_ AND b.start_ < a.end_ AND a.start_ < a.end_ AND b.start_ < b.end_ WHERE a.event_type = 'purchase' AND b.event_type <> 'purchase'")
def _(t: Tables):
    i = t.sql(_INTERVALS)
    out = R.overlap_join(i.filter("event_type = 'purchase'").drop("event_type"), i.filter("event_type <> 'purchase'").drop("event_type"), ["k"], "start_", "end_", 64)
    return out.select("event_id", F.col("right_event_id").alias("other"), (F.least("end_", "right_end_") - F.greatest("start_", "right_start_")).alias("shared"))


@query("rel_salted_aggregate", "SELECT l_returnflag, round(sum(l_quantity), 2) AS total, count(*) AS n FROM {lineitem} GROUP BY 1")
def _(t: Tables):
    rows = t("lineitem").select("l_returnflag", "l_quantity", "l_orderkey")
    return R.salted_sum(rows, "l_returnflag", F.col("l_quantity")).withColumn("total", F.round("total", 2))


# ---------------------------------------------------------------- windows in time; the same functions serve streams

_N = "count(*) AS n, round(sum(value), 4) AS total"


def _aggregates():
    return F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")


@query("stm8_tumbling_windows", f"SELECT time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') AS start, event_type, {_N} FROM {{events}} GROUP BY ALL")
def _(t: Tables):
    return S.tumbling(t("events"), "ts", "1 hour", ["event_type"], *_aggregates()).drop("end")


@query("stm9_per_second", "SELECT date_trunc('second', ts) AS start, count(*) AS n FROM {events} GROUP BY 1")
def _(t: Tables):
    return S.tumbling(t("events"), "ts", "1 second", [], F.count("*").alias("n")).drop("end")


@query("stm_sliding_windows", f"WITH w AS (SELECT time_bucket(INTERVAL 30 MINUTE, ts, TIMESTAMP '1970-01-01') - i * INTERVAL 30 MINUTE AS start, value FROM {{events}}, (SELECT unnest(range(0, 2)) AS i)) SELECT start, {_N} FROM w GROUP BY start")
def _(t: Tables):
    return S.sliding(t("events"), "ts", "1 hour", "30 minutes", [], *_aggregates()).drop("end")


@query("stm_sessions", """WITH l AS (SELECT *, coalesce(ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 6 HOUR, true) AS new FROM {events}),
s AS (SELECT *, sum(CASE WHEN new THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM l) SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 6 HOUR AS "end", count(*) AS n FROM s GROUP BY user_id, k""")
def _(t: Tables):
    return S.sessions(t("events"), "ts", "6 hours", ["user_id"], F.count("*").alias("n"))


@query("stm3_replay", "SELECT event_type, count(DISTINCT event_id) AS n FROM {events} WHERE event_id >= 500 GROUP BY 1")
def _(t: Tables):
    rows = t("events").withColumnRenamed("event_id", "seq")
    return S.replay(rows.unionByName(rows), 500).groupBy("event_type").agg(F.count("*").alias("n"))


@query("stm2_dead_letters", "SELECT event_id % 5 = 0 AS bad, count(*) AS n FROM {events} GROUP BY 1")
def _(t: Tables):
    raw = t("events").select(F.when(F.col("event_id") % 5 == 0, F.lit("{broken")).otherwise(F.col("props")).alias("value"))
    good, bad = S.with_dead_letters(raw, "k INT")
    return good.agg(F.count("*").alias("n")).select(F.lit(False).alias("bad"), "n").unionByName(bad.agg(F.count("*").alias("n")).select(F.lit(True).alias("bad"), "n"))


@query("stm6_token_outputs", "SELECT l_orderkey AS req, string_agg(l_returnflag, '' ORDER BY l_linenumber) AS text FROM {lines} GROUP BY 1")
def _(t: Tables):
    last = F.max("l_linenumber").over(Window.partitionBy("l_orderkey"))
    rows = t("lines").select(F.col("l_orderkey").alias("req"), F.col("l_linenumber").alias("pos"), F.col("l_returnflag").alias("text"), (last == F.col("l_linenumber")).alias("finished"))
    return S.token_outputs(rows, "final").select("req", "text")
