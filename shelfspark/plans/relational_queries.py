"""Relational completeness over the star schema and event-time windows: what SQL engines have and the rest of the library needs."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfspark.operators import ordered
from shelfspark.registry import query, table


def _windows(kind: str):
    def run(spark, sf_dir):
        e = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
        w = F.window("ts", "1 day") if kind == "tumbling" else F.window("ts", "1 day", "12 hours")
        return e.groupBy(w.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.unix_timestamp("w.start").alias("start_s"), "event_type", "n")

    return run


query("tumbling_counts", "SELECT CAST(floor(epoch(ts) / 86400) * 86400 AS BIGINT) AS start_s, event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1, 2")(_windows("tumbling"))
query("sliding_counts", "WITH s AS (SELECT event_type, CAST(floor(epoch(ts) / 43200) * 43200 AS BIGINT) - 43200 * k AS start_s FROM events, (SELECT unnest([0, 1]) AS k)) SELECT start_s, event_type, CAST(count(*) AS BIGINT) AS n FROM s GROUP BY 1, 2")(_windows("sliding"))


@query("session_counts", "WITH o AS (SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER w + INTERVAL 6 HOUR OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS b FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS g FROM o) SELECT user_id, CAST(floor(epoch(min(ts))) AS BIGINT) AS start_s, CAST(count(*) AS BIGINT) AS n FROM s GROUP BY user_id, g")
def session_counts(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    g = e.groupBy("user_id", F.session_window("ts", "6 hours").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return g.select("user_id", F.unix_timestamp("w.start").alias("start_s"), "n")


@query("rollup_cube_sets", "SELECT 'rollup' AS kind, l_returnflag, l_linestatus, CAST(sum(l_quantity) AS BIGINT) AS qty, CAST(grouping(l_returnflag) * 2 + grouping(l_linestatus) AS BIGINT) AS g FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus) UNION ALL SELECT 'cube', l_returnflag, l_linestatus, CAST(sum(l_quantity) AS BIGINT), CAST(grouping(l_returnflag) * 2 + grouping(l_linestatus) AS BIGINT) FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus) UNION ALL SELECT 'sets', l_returnflag, l_linestatus, CAST(sum(l_quantity) AS BIGINT), CAST(grouping(l_returnflag) * 2 + grouping(l_linestatus) AS BIGINT) FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus))")
def rollup_cube_sets(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")  # noqa: E741
    parts = []
    for kind, g in (("rollup", l.rollup("l_returnflag", "l_linestatus")), ("cube", l.cube("l_returnflag", "l_linestatus")), ("sets", l.groupingSets([[F.col("l_returnflag")], [F.col("l_linestatus")]], F.col("l_returnflag"), F.col("l_linestatus")))):
        parts.append(g.agg(F.sum("l_quantity").cast("long").alias("qty"), F.grouping_id().cast("long").alias("g")).select(F.lit(kind).alias("kind"), "l_returnflag", "l_linestatus", "qty", "g"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("rank_family", "SELECT o_orderkey, CAST(rank() OVER w AS INTEGER) AS rk, CAST(dense_rank() OVER w AS INTEGER) AS dr, CAST(ntile(4) OVER v AS INTEGER) AS nt, lead(o_orderkey) OVER v AS nx, nth_value(o_orderkey, 2) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS second, round(percent_rank() OVER v, 6) AS pr, round(cume_dist() OVER v, 6) AS cd FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderpriority), v AS (PARTITION BY o_custkey ORDER BY o_orderkey)")
def rank_family(spark, sf_dir):
    w = Window.partitionBy("o_custkey").orderBy("o_orderpriority")
    v = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    whole = v.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return table(spark, sf_dir, "orders").select("o_orderkey", F.rank().over(w).alias("rk"), F.dense_rank().over(w).alias("dr"), F.ntile(4).over(v).alias("nt"), F.lead("o_orderkey").over(v).alias("nx"), F.nth_value("o_orderkey", 2).over(whole).alias("second"), F.round(F.percent_rank().over(v), 6).alias("pr"), F.round(F.cume_dist().over(v), 6).alias("cd"))


@query("set_ops", "SELECT 'union' AS op, c_nationkey AS k FROM (SELECT c_nationkey FROM customer UNION SELECT s_nationkey FROM supplier) UNION ALL SELECT 'intersect_all', c_nationkey FROM (SELECT c_nationkey FROM customer INTERSECT ALL SELECT s_nationkey FROM supplier) UNION ALL SELECT 'except_all', c_nationkey FROM (SELECT c_nationkey FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier) UNION ALL SELECT 'except', n_nationkey FROM (SELECT n_nationkey FROM nation EXCEPT SELECT s_nationkey FROM supplier)")
def set_ops(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"))
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"))
    parts = [("union", c.union(s).distinct()), ("intersect_all", c.intersectAll(s)), ("except_all", c.exceptAll(s)), ("except", n.subtract(s))]
    out = None
    for op, df in parts:
        df = df.select(F.lit(op).alias("op"), "k")
        out = df if out is None else out.unionByName(df)
    return out


@query("semi_anti_outer_joins", "SELECT 'semi' AS op, c_custkey AS a, CAST(NULL AS BIGINT) AS b FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders) UNION ALL SELECT 'anti', c_custkey, NULL FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 3 = 0) UNION ALL SELECT 'full', c_custkey, s_suppkey FROM customer FULL JOIN supplier ON c_custkey = s_suppkey + 50 UNION ALL SELECT 'right', c_custkey, s_suppkey FROM customer RIGHT JOIN supplier ON c_custkey = s_suppkey AND c_nationkey = s_nationkey")
def semi_anti_outer_joins(spark, sf_dir):
    c, o, s = (table(spark, sf_dir, t) for t in ("customer", "orders", "supplier"))
    none = F.lit(None).cast("long")
    semi = c.join(o, c.c_custkey == o.o_custkey, "left_semi").select(F.lit("semi").alias("op"), F.col("c_custkey").alias("a"), none.alias("b"))
    anti = c.join(o.filter("o_orderkey % 3 = 0"), c.c_custkey == o.o_custkey, "left_anti").select(F.lit("anti").alias("op"), F.col("c_custkey").alias("a"), none.alias("b"))
    full = c.join(s, c.c_custkey == s.s_suppkey + 50, "full").select(F.lit("full").alias("op"), F.col("c_custkey").alias("a"), F.col("s_suppkey").alias("b"))
    right = c.join(s, (c.c_custkey == s.s_suppkey) & (c.c_nationkey == s.s_nationkey), "right").select(F.lit("right").alias("op"), F.col("c_custkey").alias("a"), F.col("s_suppkey").alias("b"))
    return semi.unionByName(anti).unionByName(full).unionByName(right)


@query("approx_distinct")
def approx_distinct(spark, sf_dir):
    """Estimates within a few hundredths; DuckDB's differ, so tests hold them against exact counts."""
    l = table(spark, sf_dir, "lineitem")  # noqa: E741
    return l.groupBy("l_returnflag").agg(F.approx_count_distinct("l_partkey", 0.02).alias("est"), F.hll_sketch_estimate(F.hll_sketch_agg("l_partkey")).alias("hll"), F.percentile_approx("l_quantity", 0.5).alias("median"))


@query("asof_join", "WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'), v AS (SELECT user_id, ts, value FROM events WHERE event_type = 'view') SELECT p.event_id, v.value FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.ts")
def asof_join(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    p = e.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    v = e.filter("event_type = 'view'").select("user_id", "ts", "value")
    return ordered.asof(p, v, ["user_id"], "ts", "value").select("event_id", "value")


@query("pricing_summary", "SELECT l_returnflag, l_linestatus, CAST(sum(l_quantity) AS BIGINT) AS qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, CAST(count(*) AS BIGINT) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2")
def pricing_summary(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").filter("l_shipdate <= timestamp_ntz'1998-09-02'")  # noqa: E741
    return l.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").cast("long").alias("qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count(F.lit(1)).alias("n"))
