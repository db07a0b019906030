"""Projection, filter, join, aggregate, window, sort and subquery queries."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tableloom.functions import scalar as fn
from tableloom.operators import ordered, relational as rel
from tableloom.plans.registry import query
from tableloom.session import stored

# --- projection and predicates ------------------------------------------------

# NULLs derived the same way in both engines: every tenth order has no priority.
PRIORITY_OR_NULL = "CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderpriority END"


@query("p1_select", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def _(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice")


@query("p2_concat", "SELECT c_custkey, c_name || ' ' || c_mktsegment AS full_name FROM customer")
def _(t):
    return t.customer.select("c_custkey", F.concat("c_name", F.lit(" "), "c_mktsegment").alias("full_name"))


@query("p3_with_column", """
SELECT s_suppkey, s_name, s_nationkey, s_acctbal * 2 AS s_acctbal,
       CASE WHEN s_acctbal >= 5000 THEN 'high' ELSE 'low' END AS band FROM supplier""")
def _(t):
    band = F.when(F.col("s_acctbal") >= 5000, "high").otherwise("low")
    return t.supplier.withColumn("band", band).withColumn("s_acctbal", F.col("s_acctbal") * 2)


@query("p4_rename", "SELECT p_partkey AS part_id, p_name AS part_name, p_brand, p_type, p_size, p_retailprice FROM part")
def _(t):
    return t.part.withColumnsRenamed({"p_partkey": "part_id", "p_name": "part_name"})


@query("p5_drop", "SELECT event_id, user_id, event_type, value FROM events")
def _(t):
    return t.events.drop("ts", "props")


@query("p6_filter", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 300000")
def _(t):
    return t.orders.filter(F.col("o_totalprice") > 300000).select("o_orderkey", "o_totalprice")


@query("p7_comparisons", """
SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem
WHERE l_returnflag = 'R' AND l_quantity >= 45 OR l_discount < 0.01 AND l_linestatus <> 'O' AND l_tax <= 0.02""")
def _(t):
    c = F.col
    kept = ((c("l_returnflag") == "R") & (c("l_quantity") >= 45)) | (
        (c("l_discount") < 0.01) & (c("l_linestatus") != "O") & (c("l_tax") <= 0.02))
    return t.lineitem.filter(kept).select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")


@query("p8_in", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def _(t):
    return t.customer.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select("c_custkey", "c_mktsegment")


@query("p9_between", "SELECT p_partkey, p_size FROM part WHERE p_size BETWEEN 10 AND 20")
def _(t):
    return t.part.filter(F.col("p_size").between(10, 20)).select("p_partkey", "p_size")


@query("p10_like", "SELECT p_partkey, p_name FROM part WHERE p_name ILIKE 'R%'")
def _(t):
    return t.part.filter(F.col("p_name").ilike("R%")).select("p_partkey", "p_name")


@query("p11_is_null", f"""
SELECT o_orderkey, CASE WHEN p IS NULL THEN 'missing' ELSE 'present' END AS state
FROM (SELECT o_orderkey, {PRIORITY_OR_NULL} AS p, o_orderstatus FROM orders)
WHERE p IS NULL OR (p IS NOT NULL AND o_orderstatus = 'P')""")
def _(t):
    d = t.orders.withColumn("p", F.expr(PRIORITY_OR_NULL))
    missing = F.col("p").isNull()
    kept = d.filter(missing | (F.col("p").isNotNull() & (F.col("o_orderstatus") == "P")))
    return kept.select("o_orderkey", F.when(missing, "missing").otherwise("present").alias("state"))


@query("p12_case", """
SELECT c_custkey, c_acctbal, CASE WHEN c_acctbal >= 7500 THEN 'Excellent' WHEN c_acctbal >= 5000 THEN 'Good'
  WHEN c_acctbal >= 2500 THEN 'Average' ELSE 'Below Average' END AS level FROM customer""")
def _(t):
    b = F.col("c_acctbal")
    level = F.when(b >= 7500, "Excellent").when(b >= 5000, "Good").when(b >= 2500, "Average")
    return t.customer.select("c_custkey", "c_acctbal", level.otherwise("Below Average").alias("level"))


@query("p13_arithmetic", """
SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net,
       l_extendedprice * l_tax + l_quantity AS charge FROM lineitem""")
def _(t):
    c = F.col
    return t.lineitem.select(
        "l_orderkey", "l_linenumber",
        (c("l_extendedprice") * (1 - c("l_discount"))).alias("net"),
        (c("l_extendedprice") * c("l_tax") + c("l_quantity")).alias("charge"))


@query("p14_map", "SELECT event_id, upper(event_type) AS kind, CAST(floor(value / 10) AS BIGINT) AS tens FROM events")
def _(t):
    return t.events.select("event_id", F.upper("event_type").alias("kind"),
                           F.floor(F.col("value") / 10).cast("long").alias("tens"))


@query("p15_flat_map", "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def _(t):
    return t.part.select("p_partkey", F.explode(F.split("p_name", " ")).alias("word"))


@query("p16_compound_filter", """
SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders
WHERE o_totalprice > 100000 AND o_orderstatus = 'F' AND o_custkey >= 100""")
def _(t):
    c = F.col
    return t.orders.filter((c("o_totalprice") > 100000) & (c("o_orderstatus") == "F") & (c("o_custkey") >= 100)) \
        .select("o_orderkey", "o_totalprice", "o_orderstatus")


@query("p17_temp_view", """
SELECT event_type, COUNT(*) AS n, ROUND(AVG(value), 9) AS mean_value FROM events GROUP BY event_type""")
def _(t):
    t.events.createOrReplaceTempView("tableloom_events")
    return t.spark.sql("""
        SELECT event_type, COUNT(*) AS n, ROUND(AVG(value), 9) AS mean_value
        FROM tableloom_events GROUP BY event_type""")


BANDS = """
WITH bands AS (
  SELECT p_retailprice, CASE WHEN p_size = 0 THEN '0' WHEN p_size BETWEEN 1 AND 10 THEN '1-10'
    WHEN p_size BETWEEN 11 AND 25 THEN '11-25' ELSE '25+' END AS band FROM {part})
SELECT band, COUNT(*) AS n, ROUND(AVG(p_retailprice), 9) AS avg_price, MIN(p_retailprice) AS lo, MAX(p_retailprice) AS hi
FROM bands GROUP BY band"""


@query("p18_cte", BANDS.format(part="part"))
def _(t):
    return t.spark.sql(BANDS, part=t.part)


# --- joins ----------------------------------------------------------------------

@query("j1_inner", """
SELECT l_orderkey, l_linenumber, p_name, p_brand, l_quantity FROM lineitem JOIN part ON l_partkey = p_partkey""")
def _(t):
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")) \
        .select("l_orderkey", "l_linenumber", "p_name", "p_brand", "l_quantity")


@query("j2_left", """
SELECT c_custkey, c_name, COUNT(o_orderkey) AS order_count FROM customer LEFT JOIN orders ON c_custkey = o_custkey
GROUP BY c_custkey, c_name""")
def _(t):
    # Orders are counted before the join, so a customer with a third of them adds one row.
    counts = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("o_orderkey").alias("n"))
    return t.customer.join(counts, "c_custkey", "left") \
        .select("c_custkey", "c_name", F.coalesce("n", F.lit(0)).alias("order_count"))


@query("j3_right", """
SELECT p_partkey, p_brand, l_quantity FROM (SELECT CASE WHEN l_partkey % 10 = 0 THEN -l_partkey ELSE l_partkey END AS fk, l_quantity FROM lineitem)
RIGHT JOIN part ON fk = p_partkey""")
def _(t):
    # Parts with a number that ends in 0 have no lines.
    fk = F.when(F.col("l_partkey") % 10 == 0, -F.col("l_partkey")).otherwise(F.col("l_partkey"))
    lines = t.lineitem.select(fk.alias("fk"), "l_quantity")
    return lines.join(t.part, F.col("fk") == F.col("p_partkey"), "right").select("p_partkey", "p_brand", "l_quantity")


@query("j4_full", """
SELECT nationkey, customers, suppliers FROM
 (SELECT c_nationkey + 3 AS nationkey, COUNT(*) AS customers FROM customer GROUP BY 1)
 FULL JOIN (SELECT s_nationkey AS nationkey, COUNT(*) AS suppliers FROM supplier GROUP BY 1)
 USING (nationkey)""")
def _(t):
    # Shifted keys leave rows without a partner on either side.
    c = t.customer.groupBy((F.col("c_nationkey") + 3).alias("nationkey")) \
        .agg(F.count(F.lit(1)).alias("customers"))
    s = t.supplier.groupBy(F.col("s_nationkey").alias("nationkey")) \
        .agg(F.count(F.lit(1)).alias("suppliers"))
    return rel.join(c, s, ["nationkey"], "full")


@query("j5_chain", """
SELECT l_orderkey, l_linenumber, c_name, n_name, r_name, o_totalprice FROM lineitem
JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def _(t):
    c = F.col
    return (
        t.lineitem.join(t.orders, c("l_orderkey") == c("o_orderkey"))
        .join(t.customer, c("o_custkey") == c("c_custkey"))
        .join(t.nation, c("c_nationkey") == c("n_nationkey"))
        .join(t.region, c("n_regionkey") == c("r_regionkey"))
        .select("l_orderkey", "l_linenumber", "c_name", "n_name", "r_name", "o_totalprice"))


@query("j6_self_pairs", """
SELECT a.l_orderkey, a.l_linenumber AS l_linenumber_1, b.l_linenumber AS l_linenumber_2, a.l_partkey AS l_partkey_1, b.l_partkey AS l_partkey_2
FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber < b.l_linenumber""")
def _(t):
    return rel.pairs_within(t.lineitem, "l_orderkey", "l_linenumber", ["l_partkey"])


# Suppliers' offers: salary ranges of different widths, many over each other.
OFFERS_SQL = "(SELECT s_nationkey, s_acctbal - 2000 AS low, s_acctbal + s_suppkey % 7 * 300 AS high FROM supplier)"


@query("j7_theta", f"""
SELECT c_custkey, COUNT(low) AS n_offers, MAX(high) AS best_offer, CASE WHEN COUNT(low) > 0 THEN 'Salary Match' ELSE 'Salary Mismatch' END AS fit
FROM customer LEFT JOIN {OFFERS_SQL} ON c_nationkey = s_nationkey AND c_acctbal BETWEEN low AND high GROUP BY c_custkey""")
def _(t):
    ends = [F.col("s_nationkey").alias("c_nationkey"), (F.col("s_acctbal") - 2000).alias("low"), (F.col("s_acctbal") + F.col("s_suppkey") % 7 * 300).alias("high")]
    held = rel.in_ranges(t.customer.select("c_custkey", "c_nationkey", "c_acctbal"), "c_acctbal", t.supplier.select(*ends), "low", "high", ["c_nationkey"])
    # The labels.
    fit = F.when(F.col("ranges_held") > 0, "Salary Match").otherwise("Salary Mismatch")
    return held.select("c_custkey", F.col("ranges_held").alias("n_offers"), F.col("best_high").alias("best_offer"), fit.alias("fit"))


@query("j8_left_condition", """
SELECT o_orderkey, l_quantity FROM orders LEFT JOIN lineitem
ON l_orderkey = o_orderkey AND l_quantity >= 45""")
def _(t):
    on = (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("l_quantity") >= 45)
    return t.orders.join(t.lineitem, on, "left").select("o_orderkey", "l_quantity")


SUPPLIED = """
SELECT n_name, COUNT(*) AS n, ROUND(SUM(l_quantity), 2) AS qty FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name"""


def _supplied(t, hint):
    lines = t.lineitem.select(F.col("l_suppkey").alias("s_suppkey"), "l_quantity")
    # Suppliers grow with the data: they are never broadcast by hint.
    joined = rel.join(lines, t.supplier.select("s_suppkey", F.col("s_nationkey").alias("n_nationkey")), ["s_suppkey"],
                      hint=None if hint == "broadcast" else hint)
    # One row per nation is left before nations, a table of fixed size, are named.
    summed = joined.groupBy("n_nationkey").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q"))
    return rel.join(summed, t.nation, ["n_nationkey"], hint=hint).groupBy("n_name") \
        .agg(F.sum("n").alias("n"), F.round(F.sum("q"), 2).alias("qty"))


@query("j9_broadcast", SUPPLIED)
def _(t):
    return _supplied(t, "broadcast")


@query("j10_shuffle", SUPPLIED)
def _(t):
    return _supplied(t, "merge")


@query("j11_orphans", """
SELECT l_orderkey, l_linenumber, fk FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 11 = 0 THEN NULL
  WHEN l_orderkey % 7 = 0 THEN l_suppkey + 1000000 ELSE l_suppkey END AS fk FROM lineitem)
WHERE fk IS NOT NULL AND fk NOT IN (SELECT s_suppkey FROM supplier)""")
def _(t):
    fk = F.when(F.col("l_orderkey") % 11 == 0, None).when(F.col("l_orderkey") % 7 == 0, F.col("l_suppkey") + 1000000)
    lines = t.lineitem.select("l_orderkey", "l_linenumber", fk.otherwise(F.col("l_suppkey")).alias("fk"))
    return rel.orphans(lines, "fk", t.supplier, "s_suppkey")


@query("j13_null_safe", f"""
WITH a AS (SELECT {PRIORITY_OR_NULL} AS p, COUNT(*) AS n FROM orders GROUP BY 1),
 b AS (SELECT {PRIORITY_OR_NULL} AS p, ROUND(SUM(o_totalprice), 2) AS total FROM orders GROUP BY 1)
SELECT a.p, n, total FROM a JOIN b ON a.p IS NOT DISTINCT FROM b.p""")
def _(t):
    o = t.orders.withColumn("p", F.expr(PRIORITY_OR_NULL))
    a = o.groupBy("p").agg(F.count(F.lit(1)).alias("n"))
    b = o.groupBy("p").agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    return rel.join(a, b, ["p"], null_safe=True)


# --- aggregation ------------------------------------------------------------------

@query("g1_group", """
SELECT l_returnflag, l_linestatus, COUNT(*) AS n, ROUND(SUM(l_quantity), 2) AS qty, ROUND(AVG(l_extendedprice), 4) AS mean_price,
 MIN(l_discount) AS lo, MAX(l_discount) AS hi FROM lineitem GROUP BY ALL""")
def _(t):
    return rel.group_agg(t.lineitem, ["l_returnflag", "l_linestatus"], {
        "n": F.count(F.lit(1)), "qty": F.round(F.sum("l_quantity"), 2),
        "mean_price": F.round(F.avg("l_extendedprice"), 4), "lo": F.min("l_discount"), "hi": F.max("l_discount")})


@query("g2_group_count", "SELECT o_orderpriority, COUNT(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC")
def _(t):
    return t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"))


@query("g3_having", """
SELECT o_custkey, COUNT(*) AS n, ROUND(AVG(o_totalprice), 7) AS mean_total FROM orders GROUP BY 1 HAVING COUNT(*) >= 12""")
def _(t):
    return t.orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("o_totalprice"), 7).alias("mean_total")).filter("n >= 12")


@query("g4_percent", f"""
SELECT p, COUNT(*) AS n, ROUND(CAST(COUNT(*) * 100.0 AS DOUBLE) / (SELECT COUNT(*) FROM orders WHERE {PRIORITY_OR_NULL} IS NOT NULL), 2) AS percentage
FROM (SELECT {PRIORITY_OR_NULL} AS p FROM orders) WHERE p IS NOT NULL GROUP BY p""")
def _(t):
    given = t.orders.select(F.expr(PRIORITY_OR_NULL).alias("p")).filter("p IS NOT NULL")
    whole = given.agg(F.count(F.lit(1))).scalar()
    return given.groupBy("p").agg(F.count(F.lit(1)).alias("n")) \
        .select("p", "n", F.round(F.col("n") * 100.0 / whole, 2).alias("percentage"))


@query("g5_count_distinct", """
SELECT l_returnflag, COUNT(DISTINCT l_partkey) AS parts, COUNT(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1""")
def _(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_suppkey").alias("suppliers"))


# Three standard errors of a sketch of 4,096 registers.
SKETCH_ERROR = 3 * 1.04 / 64


@query("g6_approx_distinct", "SELECT l_returnflag, COUNT(DISTINCT l_partkey) AS parts, TRUE AS within_error FROM lineitem GROUP BY 1")
def _(t):
    lines = t.lineitem.select("l_returnflag", "l_partkey", F.date_trunc("month", "l_shipdate").alias("month"))
    sketches = stored(rel.distinct_sketches(lines, ["l_returnflag"], "month", "l_partkey"), "part-sketches")
    exact = lines.groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("parts"))
    off = F.abs(F.col("approx_distinct") - F.col("parts"))
    return rel.join(exact, rel.sketched_counts(sketches, ["l_returnflag"]), ["l_returnflag"]).select(
        "l_returnflag", "parts", (off <= F.col("parts") * SKETCH_ERROR).alias("within_error"))


@query("g7_global", """
SELECT COUNT(*) AS n, ROUND(SUM(o_totalprice), 2) AS total, ROUND(AVG(o_totalprice), 4) AS mean, MIN(o_totalprice) AS lo,
 MAX(o_totalprice) AS hi FROM orders""")
def _(t):
    return t.orders.agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"),
        F.round(F.avg("o_totalprice"), 4).alias("mean"), F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi"))


@query("g8_std_var", """
SELECT l_orderkey, ROUND(CASE WHEN COUNT(l_quantity) < 2 THEN 0.0 ELSE stddev_samp(l_quantity) END, 6) AS std,
 ROUND(CASE WHEN COUNT(l_quantity) < 2 THEN 0.0 ELSE var_samp(l_quantity) END, 6) AS var FROM lineitem GROUP BY 1""")
def _(t):
    return t.lineitem.groupBy("l_orderkey").agg(
        F.round(rel.spread_or_zero("l_quantity"), 6).alias("std"),
        F.round(rel.spread_or_zero("l_quantity", "variance"), 6).alias("var"))


@query("g9_reduce_by_key", "SELECT event_type, COUNT(*) AS n, MAX(value) AS top FROM events GROUP BY 1")
def _(t):
    return rel.group_agg(t.events, ["event_type"], {"n": F.sum(F.lit(1)), "top": F.max("value")})


@query("g10_collect_by_key", """
SELECT user_id, chunk_no, string_agg(event_id, ',' ORDER BY event_id) AS ids FROM (
 SELECT user_id, event_id, CAST(floor((row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) / 50) AS BIGINT) AS chunk_no FROM events)
GROUP BY ALL""")
def _(t):
    lists = rel.collect_by_key(t.events, "user_id", "event_id", ["event_id"], 50)
    return lists.select("user_id", "chunk_no", F.array_join(F.transform("values", lambda v: v.cast("string")), ",").alias("ids"))


@query("g11_reduce", "SELECT MAX(value) AS top, CAST(SUM(user_id) AS BIGINT) AS users FROM events")
def _(t):
    return t.events.agg(F.max("value").alias("top"), F.sum("user_id").alias("users"))


@query("g12_describe", """
SELECT 'l_quantity' AS "column", COUNT(l_quantity) AS n, ROUND(AVG(l_quantity), 6) AS mean, MIN(l_quantity) AS "min", MAX(l_quantity) AS "max" FROM lineitem
UNION ALL SELECT 'l_linenumber', COUNT(l_linenumber), ROUND(AVG(l_linenumber), 6), CAST(MIN(l_linenumber) AS DOUBLE), CAST(MAX(l_linenumber) AS DOUBLE) FROM lineitem
UNION ALL SELECT 'l_discount', COUNT(l_discount), ROUND(AVG(l_discount), 6), MIN(l_discount), MAX(l_discount) FROM lineitem""")
def _(t):
    stats = rel.describe(t.lineitem, ["l_quantity", "l_linenumber", "l_discount"])
    return stats.withColumn("mean", F.round("mean", 6))


@query("g13_value_counts", "SELECT p_brand, COUNT(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_brand LIMIT 10")
def _(t):
    return rel.value_counts(t.part, "p_brand", 10)


@query("g14_bucket_counts", """
SELECT CASE WHEN l_quantity <= 10 THEN '0-10' WHEN l_quantity <= 25 THEN '11-25' WHEN l_quantity <= 40 THEN '26-40' ELSE '40+' END AS bucket,
 COUNT(*) AS n FROM lineitem GROUP BY 1""")
def _(t):
    label = rel.bucket(F.col("l_quantity"), [10, 25, 40], ["0-10", "11-25", "26-40", "40+"], right=True)
    return t.lineitem.groupBy(label.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query("g15_histogram", "SELECT CAST(floor(p_size / 5) * 5 AS BIGINT) AS low, COUNT(*) AS n FROM part GROUP BY 1")
def _(t):
    return t.part.groupBy((F.floor(F.col("p_size") / 5) * 5).cast("long").alias("low")).agg(F.count(F.lit(1)).alias("n"))


_CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("g16_corr", " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, ROUND(corr({a}, {b}), 3) + 0.0 AS corr FROM lineitem" for a in _CORR for b in _CORR))
def _(t):
    return rel.corr_matrix(t.lineitem, _CORR)


@query("g17_group_profile", """
SELECT source, COUNT(*) AS n, ROUND(AVG(n_chars), 4) AS mean_chars, ROUND(AVG(len(text)), 4) AS mean_len,
 CAST(SUM(len(string_split(text, ' '))) AS BIGINT) AS words FROM documents GROUP BY 1""")
def _(t):
    return t.documents.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("n_chars"), 4).alias("mean_chars"),
        F.round(F.avg(F.length("text")), 4).alias("mean_len"), F.sum(F.size(F.split("text", " "))).alias("words"))


@query("g20_skill_gap", """
SELECT o_orderpriority AS title, p_brand AS item, need AS required, COUNT(DISTINCT CASE WHEN l_quantity >= need THEN l_suppkey END) AS qualified
FROM (SELECT DISTINCT o_orderpriority, p_brand, 40 + CAST(substr(o_orderpriority, 1, 1) AS INT) * 2 AS need FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey) r
LEFT JOIN (SELECT p_brand AS b, l_suppkey, l_quantity FROM lineitem JOIN part ON l_partkey = p_partkey) h ON r.p_brand = h.b AND l_quantity >= need
GROUP BY ALL""")
def _(t):
    # Requirement: a brand asked for at a priority needs suppliers with lines of at least `required` pieces.
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")) \
        .select("l_orderkey", F.col("p_brand").alias("item"), "l_suppkey", "l_quantity")
    need = lines.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderpriority").alias("title"), "item",
        (F.lit(40) + F.substring("o_orderpriority", 1, 1).cast("int") * 2).alias("required")).distinct()
    return rel.qualified_counts(lines, need, "item", "l_suppkey", "l_quantity", "required")


@query("g22_map_side_combine", "SELECT l_linenumber, COUNT(*) AS n, ROUND(SUM(l_quantity), 2) AS qty FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy("l_linenumber").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"))


@query("g24_basic_stats", """
SELECT COUNT(*) AS total, ROUND(AVG(c_acctbal), 2) AS avg_balance, ROUND(AVG(c_nationkey), 2) AS avg_nation, ROUND(AVG(c_custkey), 2) AS avg_key FROM customer""")
def _(t):
    return t.customer.agg(
        F.count(F.lit(1)).alias("total"), F.round(F.avg("c_acctbal"), 2).alias("avg_balance"),
        F.round(F.avg("c_nationkey"), 2).alias("avg_nation"), F.round(F.avg("c_custkey"), 2).alias("avg_key"))


@query("g25_level_profile", """
SELECT o_orderpriority AS level, COUNT(*) AS n, ROUND(AVG(o_totalprice), 1) AS avg_score, MIN(o_totalprice) AS min_score,
 MAX(o_totalprice) AS max_score, ROUND(AVG(lines), 1) AS avg_items FROM orders JOIN
 (SELECT l_orderkey, COUNT(*) AS lines FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey GROUP BY 1 ORDER BY avg_score DESC""")
def _(t):
    lines = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines"))
    return t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).groupBy(F.col("o_orderpriority").alias("level")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("o_totalprice"), 1).alias("avg_score"), F.min("o_totalprice").alias("min_score"),
        F.max("o_totalprice").alias("max_score"), F.round(F.avg("lines"), 1).alias("avg_items")).orderBy(F.desc("avg_score"))


# --- windows ------------------------------------------------------------------------

@query("n1_row_number", """
SELECT c_custkey, c_nationkey, c_acctbal, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rn FROM customer""")
def _(t):
    return ordered.numbered(t.customer.select("c_custkey", "c_nationkey", "c_acctbal"), ["c_nationkey"], ["-c_acctbal", "c_custkey"], "rn")


@query("n2_rank", "SELECT o_orderkey, o_totalprice, rank() OVER (ORDER BY o_totalprice DESC) AS score_rank FROM orders")
def _(t):
    return ordered.ranked(t.orders.select("o_orderkey", "o_totalprice"), [], "-o_totalprice", rank="score_rank")


@query("n3_rank_both", """
SELECT o_orderkey, rank() OVER (ORDER BY o_totalprice DESC) AS global_rank,
 rank() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC) AS level_rank FROM orders""")
def _(t):
    d = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    both = ordered.ranked(ordered.ranked(d, [], "-o_totalprice", rank="global_rank"),
                          ["o_orderpriority"], "-o_totalprice", rank="level_rank")
    return both.select("o_orderkey", "global_rank", "level_rank")


@query("n4_running_count", """
SELECT o_orderkey, o_orderpriority, COUNT(*) OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey
 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative FROM orders""")
def _(t):
    d = t.orders.select("o_orderkey", "o_orderpriority", "o_orderdate")
    return ordered.running_totals(d, ["o_orderpriority"], ["o_orderdate", "o_orderkey"],
                                  {"cumulative": F.lit(1).cast("long")}).drop("o_orderdate")


@query("n5_moving_average", """
SELECT o_orderkey, ROUND(AVG(o_totalprice) OVER (ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 3) AS moving_avg FROM orders""")
def _(t):
    d = t.orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    return ordered.with_neighbours(
        d, [], ["o_orderdate", "o_orderkey"],
        {"moving_avg": lambda w: F.round(F.avg("o_totalprice").over(w.rowsBetween(-4, 0)), 3)}, back=4,
    ).select("o_orderkey", "moving_avg")


@query("n6_rolling_in_group", """
SELECT o_orderkey, ROUND(AVG(o_totalprice) OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 1) AS rolling_avg FROM orders""")
def _(t):
    d = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    return ordered.with_neighbours(
        d, ["o_orderpriority"], ["o_orderkey"],
        {"rolling_avg": lambda w: F.round(F.avg("o_totalprice").over(w.rowsBetween(-4, 0)), 1)}, back=4,
    ).select("o_orderkey", "rolling_avg")


@query("n7_lag_lead", """
SELECT o_orderkey, o_totalprice, lag(o_totalprice) OVER w AS prev_score, ROUND(o_totalprice - lag(o_totalprice) OVER w, 2) AS score_change,
 lead(o_totalprice) OVER w AS next_score FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def _(t):
    d = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return ordered.with_neighbours(d, ["o_custkey"], ["o_orderdate", "o_orderkey"], {
        "prev_score": lambda w: F.lag("o_totalprice").over(w),
        "score_change": lambda w: F.round(F.col("o_totalprice") - F.lag("o_totalprice").over(w), 2),
        "next_score": lambda w: F.lead("o_totalprice").over(w),
    }, back=1, ahead=1).drop("o_custkey", "o_orderdate")


@query("n8_ntile", "SELECT c_custkey, c_acctbal, CAST(ntile(4) OVER (ORDER BY c_acctbal, c_custkey) AS INT) AS quartile FROM customer")
def _(t):
    return ordered.ntiles(t.customer.select("c_custkey", "c_acctbal"), 4, ["c_acctbal", "c_custkey"], "quartile")


@query("n9_group_mean", "SELECT o_orderkey, ROUND(AVG(o_totalprice) OVER (PARTITION BY o_orderpriority), 4) AS level_avg FROM orders")
def _(t):
    d = rel.with_group_mean(t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice"), "o_orderpriority", "o_totalprice", "m")
    return d.select("o_orderkey", F.round("m", 4).alias("level_avg"))


@query("n10_share", "SELECT o_orderkey, ROUND(o_totalprice * 100.0 / SUM(o_totalprice) OVER (), 6) AS share_pct FROM orders")
def _(t):
    total = t.orders.agg(F.sum("o_totalprice")).scalar()
    return t.orders.select("o_orderkey", F.round(F.col("o_totalprice") * 100.0 / total, 6).alias("share_pct"))


@query("n11_top_k", """
SELECT c_nationkey, c_custkey, c_acctbal, rk FROM (SELECT c_nationkey, c_custkey, c_acctbal,
 rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC) AS rk FROM customer) WHERE rk <= 3""")
def _(t):
    return ordered.top_per_group(t.customer.select("c_nationkey", "c_custkey", "c_acctbal"), ["c_nationkey"], "-c_acctbal", 3, "rk")


@query("n12_funnel", """
SELECT o_orderstatus AS status, COUNT(*) AS n, ROUND(CAST(COUNT(*) * 100.0 AS DOUBLE) / SUM(COUNT(*)) OVER (), 2) AS percentage,
 CAST(SUM(COUNT(*)) OVER (ORDER BY CASE o_orderstatus WHEN 'P' THEN 1 WHEN 'O' THEN 2 WHEN 'F' THEN 3 END, o_orderstatus
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative FROM orders GROUP BY o_orderstatus""")
def _(t):
    place = lambda c: F.when(F.col(c) == "P", 1).when(F.col(c) == "O", 2).when(F.col(c) == "F", 3)
    return rel.funnel(t.orders, F.col("o_orderstatus"), "status", place)


@query("n13_tier_funnel", """
WITH s AS (SELECT CASE WHEN l_quantity * 2 >= 90 THEN 'Excellent (90-100)' WHEN l_quantity * 2 >= 75 THEN 'Good (75-89)'
 WHEN l_quantity * 2 >= 60 THEN 'Fair (60-74)' WHEN l_quantity * 2 >= 40 THEN 'Weak (40-59)' ELSE 'Poor (<40)' END AS tier, l_quantity FROM lineitem)
SELECT tier, COUNT(*) AS n, ROUND(CAST(COUNT(*) * 100.0 AS DOUBLE) / SUM(COUNT(*)) OVER (), 2) AS percentage,
 CAST(SUM(COUNT(*)) OVER (ORDER BY MIN(l_quantity) DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative FROM s GROUP BY tier""")
def _(t):
    tiers = ["Poor (<40)", "Weak (40-59)", "Fair (60-74)", "Good (75-89)", "Excellent (90-100)"]
    label = rel.bucket(F.col("l_quantity") * 2, [40, 60, 75, 90], tiers)
    best_first = F.array(*[F.lit(x) for x in reversed(tiers)])
    return rel.funnel(t.lineitem, label, "tier", lambda c: F.array_position(best_first, F.col(c)))


@query("n14_dense_percent", """
SELECT p_partkey, p_size, dense_rank() OVER (ORDER BY p_size) AS dense, ROUND(percent_rank() OVER (ORDER BY p_size), 6) AS pct FROM part""")
def _(t):
    d = ordered.ranked(t.part.select("p_partkey", "p_size"), [], "p_size", dense="dense", percent="pct")
    return d.withColumn("pct", F.round("pct", 6))


# --- sort, limit, distinct, union ---------------------------------------------------

@query("o1_order", "SELECT s_suppkey, s_acctbal FROM supplier ORDER BY s_acctbal DESC")
def _(t):
    return t.supplier.select("s_suppkey", "s_acctbal").orderBy(F.desc("s_acctbal"))


@query("o2_order_many", "SELECT c_mktsegment, c_custkey, c_acctbal FROM customer ORDER BY c_mktsegment, c_acctbal DESC")
def _(t):
    return t.customer.select("c_mktsegment", "c_custkey", "c_acctbal").orderBy(F.asc("c_mktsegment"), F.desc("c_acctbal"))


@query("o3_nulls_last", f"SELECT o_orderkey, {PRIORITY_OR_NULL} AS p FROM orders ORDER BY p IS NULL, p")
def _(t):
    return t.orders.select("o_orderkey", F.expr(PRIORITY_OR_NULL).alias("p")).orderBy(F.asc_nulls_last("p"))


@query("o4_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10")
def _(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy("o_orderkey").limit(10)


@query("o5_top_k", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5")
def _(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(5)


@query("o6_distinct", "SELECT DISTINCT p_brand, p_type FROM part")
def _(t):
    return t.part.select("p_brand", "p_type").distinct()


@query("o7_drop_duplicates", "SELECT l_partkey, l_suppkey, MIN(l_orderkey) AS first_order FROM lineitem GROUP BY 1, 2")
def _(t):
    # dropDuplicates keeps an arbitrary row; taking the smallest key makes the kept row repeatable.
    return fn.keep_first(t.lineitem.select("l_partkey", "l_suppkey", "l_orderkey"), ["l_partkey", "l_suppkey"], "l_orderkey") \
        .withColumnRenamed("l_orderkey", "first_order")


@query("o8_union", """
SELECT c_nationkey AS nationkey, c_acctbal AS balance FROM customer UNION ALL SELECT s_nationkey, s_acctbal FROM supplier""")
def _(t):
    c = t.customer.select(F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("balance"))
    return c.unionByName(t.supplier.select(F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nationkey")))


@query("o9_set_difference", """
SELECT p_partkey, array_to_string(list_sort(list_filter(list_distinct(string_split(p_name, ' ')), lambda x: list_contains(['small', 'red', 'blue', 'ring'], x))), ' ') AS both_words,
 array_to_string(list_sort(list_filter(list_distinct(string_split(p_name, ' ')), lambda x: NOT list_contains(['small', 'red', 'blue', 'ring'], x))), ' ') AS other_words FROM part""")
def _(t):
    words, known = F.split("p_name", " "), F.array(*[F.lit(w) for w in ("small", "red", "blue", "ring")])
    return t.part.select("p_partkey", F.array_join(F.array_sort(F.array_intersect(words, known)), " ").alias("both_words"),
                         F.array_join(F.array_sort(F.array_except(words, known)), " ").alias("other_words"))


@query("o10_actions", "SELECT COUNT(*) AS n_rows, MIN(event_id) AS first_id, 6 AS n_columns FROM events")
def _(t):
    return t.events.agg(F.count(F.lit(1)).alias("n_rows"), F.min("event_id").alias("first_id"),
                        F.lit(len(t.events.columns)).alias("n_columns"))


# --- subqueries ---------------------------------------------------------------------

@query("s1_scalar", """
SELECT c_custkey, ROUND((SELECT AVG(c_acctbal) FROM customer), 4) AS avg_balance,
 ROUND(c_acctbal - (SELECT AVG(c_acctbal) FROM customer), 4) AS diff_from_avg FROM customer""")
def _(t):
    mean = t.customer.agg(F.avg("c_acctbal")).scalar()
    return t.customer.select("c_custkey", F.round(mean, 4).alias("avg_balance"),
                             F.round(F.col("c_acctbal") - mean, 4).alias("diff_from_avg"))


@query("s2_having_nested", """
SELECT o_custkey, COUNT(o_orderkey) AS n FROM orders GROUP BY 1
HAVING COUNT(o_orderkey) > (SELECT AVG(n) FROM (SELECT COUNT(o_orderkey) AS n FROM orders GROUP BY o_custkey))""")
def _(t):
    counts = t.orders.groupBy("o_custkey").agg(F.count("o_orderkey").alias("n"))
    return counts.filter(F.col("n") > counts.agg(F.avg("n")).scalar())


@query("s3_derived_table", """
SELECT c_custkey, c_name, total, ROUND(mean, 7) AS mean, top FROM (SELECT o_custkey, COUNT(*) AS total, AVG(o_totalprice) AS mean,
 MAX(o_totalprice) AS top FROM orders GROUP BY 1) JOIN customer ON o_custkey = c_custkey""")
def _(t):
    stats = t.orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("total"), F.round(F.avg("o_totalprice"), 7).alias("mean"), F.max("o_totalprice").alias("top"))
    return stats.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("c_custkey", "c_name", "total", "mean", "top")


CORRELATED = """
SELECT o_orderkey, c_name, (SELECT COUNT(*) FROM {lineitem} l JOIN {part} p ON l.l_partkey = p.p_partkey
  WHERE l.l_orderkey = o.o_orderkey AND l.l_quantity >= p.p_size) AS matching
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey"""


@query("s4_correlated", CORRELATED.format(lineitem="lineitem", part="part", orders="orders", customer="customer"))
def _(t):
    return t.spark.sql(CORRELATED, lineitem=t.lineitem, part=t.part, orders=t.orders, customer=t.customer)
