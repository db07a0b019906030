"""Source, sink, star-schema and table-change queries."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableloom.operators import changes as ch, relational as rel, warehouse as wh
from tableloom.plans.registry import query
from tableloom.session import scratch
from tableloom.sources import files as src

# --- sources and sinks --------------------------------------------------------------

SUPPLIER = "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"
NATION = "n_nationkey int, n_name string, n_regionkey int"


def csv_copy(t, df, label):
    path = scratch(t.spark, label)
    df.write.option("header", True).csv(path)
    return path


@query("a1_read_csv", "SELECT s_suppkey, s_name, s_acctbal, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def _(t):
    read = src.read_csvs(t.spark, {
        "supplier": (csv_copy(t, t.supplier, "supplier"), SUPPLIER),
        "nation": (csv_copy(t, t.nation, "nation"), NATION)})
    return read["supplier"].join(read["nation"], F.col("s_nationkey") == F.col("n_nationkey")) \
        .select("s_suppkey", "s_name", "s_acctbal", "n_name")


@query("a2_ingest_dir", "SELECT c_mktsegment AS folder, COUNT(*) AS rows FROM customer GROUP BY 1")
def _(t):
    path = scratch(t.spark, "incoming")
    t.customer.withColumn("folder", F.col("c_mktsegment")).write.partitionBy("folder").option("header", True).csv(path)
    rows = src.ingest_dir(t.spark, path, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    return rows.groupBy(F.regexp_extract("source_file", r"folder=([^/]+)/", 1).alias("folder")).agg(F.count(F.lit(1)).alias("rows"))


#: Fixed value: bad rows that a load puts up with.
BAD_ROWS = 100


@query("a3_tolerant_load", f"SELECT p_partkey, p_size, TRUE AS one_more_fails FROM part WHERE p_partkey >= {BAD_ROWS}")
def _(t):
    schema = T.StructType.fromDDL("p_partkey long, p_size int")

    def load(bad):
        size = F.when(F.col("p_partkey") < bad, "unknown").otherwise(F.col("p_size").cast("string"))
        return src.load_csv(t.spark, csv_copy(t, t.part.select("p_partkey", size.alias("p_size")), "parts"), schema, max_errors=BAD_ROWS)

    try:
        load(BAD_ROWS + 1).agg(F.count("p_size")).collect()
        fails = False
    except Exception as e:  # the kind depends on where the plan fails
        fails = f"more than {BAD_ROWS} bad rows" in str(e)
    return load(BAD_ROWS).withColumn("one_more_fails", F.lit(fails))


@query("a4_read_text", "SELECT c_name AS value FROM customer")
def _(t):
    path = scratch(t.spark, "lines")
    t.customer.select("c_name").write.text(path)
    return src.read_text(t.spark, path)


@query("a5_read_json", "SELECT s_suppkey AS id, s_name AS name, s_name || '|n' || s_nationkey AS skills FROM supplier")
def _(t):
    item = F.to_json(F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                              F.array("s_name", F.concat(F.lit("n"), "s_nationkey")).alias("skills")))
    chunks = rel.collect_by_key(t.supplier.withColumn("item", item), "s_nationkey", "item", ["s_suppkey"], 1000)
    path = scratch(t.spark, "profiles")
    chunks.select("s_nationkey", "chunk_no", F.concat(F.lit("["), F.array_join("values", ","), F.lit("]")).alias("value")) \
        .write.partitionBy("s_nationkey", "chunk_no").text(path)
    return src.read_json(t.spark, path, "id long, name string, skills array<string>", array_files=True).select(
        "id", "name", F.array_join("skills", "|").alias("skills"))


@query("a6_parse_log", "SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, upper(event_type) AS level, 'event ' || event_id AS message FROM events")
def _(t):
    line = F.concat(F.date_trunc("second", "ts").cast("timestamp_ntz").cast("string"), F.lit(" ["), F.upper("event_type"),
                    F.lit("] event "), F.col("event_id"))
    path = scratch(t.spark, "log")
    t.events.select(line.alias("value")).write.text(path)
    return src.parse_log(src.read_text(t.spark, path)).withColumn("ts", F.col("ts").cast("string"))


@query("a7_blank_line_records", "SELECT p_partkey AS candidate, p_size AS experience, replace(p_name, ' ', '|') AS skills FROM part")
def _(t):
    text = F.concat(F.lit("CANDIDATE "), F.col("p_partkey"), F.lit("\nExperience: "), F.col("p_size"), F.lit(" years\nSkills: "),
                    F.replace("p_name", F.lit(" "), F.lit(", ")))
    path = scratch(t.spark, "records")
    t.part.select(text.alias("value")).write.option("lineSep", "\n\n").text(path)
    return src.parse_candidates(src.read_text(t.spark, path, "\n\n")).withColumn("skills", F.array_join("skills", "|"))


def order_store(t, copies=1):
    """A text file of order keys and prices for each priority, in order, as often as asked for."""
    path = scratch(t.spark, "orders")
    lines = t.orders.select("o_orderkey", F.col("o_orderpriority").alias("kind"), F.concat_ws(" ", "o_orderkey", "o_custkey").alias("value"))
    filed = lines.repartition("kind").sortWithinPartitions("kind", "o_orderkey").select("kind", "value")
    for copy in range(copies):
        filed.write.partitionBy("kind").text(f"{path}/{copy}")
    return path


ORDER_FILES_SQL = "(SELECT o_orderpriority AS kind, string_agg(o_orderkey || ' ' || o_custkey || chr(10), '' ORDER BY o_orderkey) AS content FROM orders GROUP BY 1)"


@query("a8_list_files", f"SELECT kind, CAST(strlen(content) AS BIGINT) AS size FROM {ORDER_FILES_SQL}")
def _(t):
    kind = F.url_decode(F.regexp_extract("path", "kind=([^/]+)/", 1))
    return src.list_files(t.spark, order_store(t), "part-").select(kind.alias("kind"), "size")


@query("a9_store_size", f"""
SELECT COUNT(*) AS object_count, CAST(SUM(strlen(content)) AS BIGINT) AS total_size_bytes, ROUND(SUM(strlen(content)) / 1048576, 4) AS total_size_mb FROM {ORDER_FILES_SQL}""")
def _(t):
    return src.store_size(t.spark, order_store(t))


@query("a10_duplicate_files", f"SELECT md5(content) AS md5, CAST(strlen(content) AS BIGINT) AS length, 2 AS copies FROM {ORDER_FILES_SQL}")
def _(t):
    return src.duplicate_files(src.list_files(t.spark, order_store(t, copies=2))).select("md5", "length", F.col("copies").cast("int").alias("copies"))


@query("a11_from_rows", """
SELECT o_orderkey, days FROM orders JOIN (VALUES ('1-URGENT', 1), ('2-HIGH', 3), ('3-MEDIUM', 7), ('4-NOT SPECIFIED', 10), ('5-LOW', 14)) AS p(priority, days) ON o_orderpriority = priority""")
def _(t):
    days = src.from_rows(t.spark, [("1-URGENT", 1), ("2-HIGH", 3), ("3-MEDIUM", 7), ("4-NOT SPECIFIED", 10), ("5-LOW", 14)], "priority string, days int")
    return t.orders.join(F.broadcast(days), F.col("o_orderpriority") == F.col("priority")).select("o_orderkey", "days")


@query("a12_save", "SELECT c_custkey, c_acctbal FROM customer")
def _(t):
    path = scratch(t.spark, "customers")
    src.save(t.customer.select("c_custkey", F.lit(0.0).alias("c_acctbal")), path)
    return src.save(t.customer.select("c_custkey", "c_acctbal"), path, "overwrite")


@query("a13_partitioned_save", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def _(t):
    stored = src.save(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus"), scratch(t.spark, "clustered"),
                      partition_by=["o_orderstatus"], cluster_by=["o_custkey"])
    return stored.filter("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_orderstatus")


@query("a14_materialize", """
SELECT o_custkey, COUNT(*) AS n, ROUND(SUM(CASE WHEN o_orderstatus = 'O' AND o_totalprice < 100000 THEN o_totalprice * 2 ELSE o_totalprice END), 2) AS total, COUNT(DISTINCT o_orderpriority) AS priorities
FROM orders WHERE o_orderstatus != 'F' GROUP BY 1""")
def _(t):
    now = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    # The state before: pending orders had not come, cheap open ones had half their price, finished ones had not gone.
    cheap = F.expr("o_orderstatus = 'O' AND o_totalprice < 100000")
    before = now.filter("o_orderstatus != 'P'")
    after = now.filter("o_orderstatus != 'F'").withColumn("o_totalprice", F.when(cheap, F.col("o_totalprice") * 2).otherwise(F.col("o_totalprice")))
    summary = wh.Summary(scratch(t.spark, "summary"), ("o_custkey",), ("o_totalprice",), ("o_orderpriority",), buckets=16)
    summary.build(before)
    summary.refresh(ch.signed(ch.changes(before, after, "o_orderkey"), before, "o_orderkey"))
    return summary.read(t.spark).select("o_custkey", "n", F.round("o_totalprice", 2).alias("total"), F.col("distinct_o_orderpriority").alias("priorities"))


@query("a16_zones", "SELECT event_type, COUNT(*) AS n, MAX(value) AS top FROM events GROUP BY 1")
def _(t):
    zones = src.Zones(scratch(t.spark, "zones"))
    raw = src.save(t.events.select("event_id", "event_type", "value"), zones.table("raw", "events"))
    processed = src.save(raw.select("event_type", "value"), zones.table("processed", "events"))
    stats = processed.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("top"))
    return src.save(stats, zones.table("warehouse", "event_stats"))


@query("x19_ingest_text", """
SELECT source, CAST(SUM(strlen(text) + 1) AS BIGINT) AS size_bytes, CAST(SUM(len(text) + 1) AS BIGINT) AS char_count FROM documents GROUP BY 1""")
def _(t):
    path = scratch(t.spark, "texts")
    t.documents.select("source", "text").write.partitionBy("source").text(path)
    got = src.ingest_text(t.spark, path)
    return got.groupBy(F.regexp_extract("path", r"source=([^/]+)/", 1).alias("source")).agg(
        F.sum("size_bytes").alias("size_bytes"), F.sum("char_count").alias("char_count"))


# --- star schema -----------------------------------------------------------------------

@query("w1_dim_date", """
SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, CAST(d AS STRING) AS full_date, CAST(isodow(d) - 1 AS INT) AS day_of_week, dayname(d) AS day_name,
 CAST(day(d) AS INT) AS day_of_month, CAST(dayofyear(d) AS INT) AS day_of_year, CAST(weekofyear(d) AS INT) AS week_of_year,
 CAST(month(d) AS INT) AS month_number, monthname(d) AS month_name, CAST(quarter(d) AS INT) AS quarter, CAST(year(d) AS INT) AS year, isodow(d) >= 6 AS is_weekend,
 CAST(quarter(d) AS INT) AS fiscal_quarter, strftime(d, '%m%d') IN ('0704', '1225') AND year(d) = 1996 AS is_holiday,
 CASE WHEN year(d) = 1996 AND strftime(d, '%m%d') = '0704' THEN 'Independence Day' WHEN year(d) = 1996 AND strftime(d, '%m%d') = '1225' THEN 'Christmas' END AS holiday_name
FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM (SELECT CAST(CAST(MIN(o_orderdate) AS DATE) AS TIMESTAMP) AS lo, CAST(CAST(MAX(o_orderdate) AS DATE) AS TIMESTAMP) AS hi FROM orders))""")
def _(t):
    span = t.orders.agg(F.min(F.to_date("o_orderdate")).alias("lo"), F.max(F.to_date("o_orderdate")).alias("hi"))
    holidays = {"1996-07-04": "Independence Day", "1996-12-25": "Christmas"}
    return wh.dim_date(t.spark, F.col("lo"), F.datediff("hi", "lo") + 1, holidays, span)


@query("w2_surrogate_keys", "SELECT c_name, row_number() OVER (ORDER BY c_name) AS customer_key FROM customer")
def _(t):
    return wh.with_key(t.customer.select("c_name"), ["c_name"], "customer_key")


MEASURES_SQL = """(SELECT *, q * pr * (1 - disc) AS sales FROM (SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_shipdate, l_quantity AS q, l_extendedprice / l_quantity AS pr, l_discount AS disc, p_retailprice * 0.6 AS cost
 FROM lineitem JOIN part ON l_partkey = p_partkey))"""


def priced_lines(t):
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("quantity"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        (F.col("p_retailprice") * 0.6).alias("unit_cost"), F.col("l_discount").alias("discount"), "l_partkey", "l_suppkey", "l_shipdate", "p_type")


@query("w3_sales_measures", f"""
SELECT l_orderkey, l_linenumber, ROUND(sales, 6) AS sales_amount, ROUND(q * cost, 6) AS cost_amount, ROUND(sales - q * cost, 6) AS profit_amount,
 ROUND(sales * 0.08, 8) AS tax_amount, ROUND(CASE WHEN sales < 100 THEN sales * 0.05 ELSE 0 END, 6) AS shipping_amount FROM {MEASURES_SQL}""")
def _(t):
    m = wh.sales_measures(priced_lines(t), "quantity", "unit_price", "unit_cost", "discount")
    return m.select("l_orderkey", "l_linenumber", *[F.round(c, n).alias(c) for c, n in (
        ("sales_amount", 6), ("cost_amount", 6), ("profit_amount", 6), ("tax_amount", 8), ("shipping_amount", 6))])


def customer_dim(t):
    dim = wh.with_key(t.customer.select("c_custkey", "c_mktsegment", "c_nationkey"), ["c_custkey"], "customer_key")
    return wh.scd2_open(dim, F.lit("1992-01-01"))


def customer_updates(t):
    """Customers with a good balance are sent again, those in HOUSEHOLD with a new segment; indebted ones get a second account."""
    changed = t.customer.filter("c_acctbal > 3000").select(
        "c_custkey", F.when(F.col("c_mktsegment") == "HOUSEHOLD", "MOVED").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"), "c_nationkey")
    added = t.customer.filter("c_acctbal < 0").select(
        (-F.col("c_custkey") - 1).alias("c_custkey"), F.lit("NEW").alias("c_mktsegment"), "c_nationkey")
    return changed.unionByName(added)


MOVED_SQL = "(c_acctbal > 3000 AND c_mktsegment = 'HOUSEHOLD')"


# Opened versions are numbered on from the customers' own keys, in the order of their natural keys.
OPENED_SQL = f"""(SELECT *, (SELECT COUNT(*) FROM customer) + row_number() OVER (ORDER BY c_custkey) AS customer_key FROM
 (SELECT c_custkey, 'MOVED' AS c_mktsegment, c_nationkey FROM customer WHERE {MOVED_SQL}
  UNION ALL SELECT -c_custkey - 1, 'NEW', c_nationkey FROM customer WHERE c_acctbal < 0))"""
KEYED_SQL = "(SELECT *, row_number() OVER (ORDER BY c_custkey) AS customer_key FROM customer)"


def moved_dim(t):
    return wh.scd2_merge(customer_dim(t), customer_updates(t), "c_custkey", F.lit("1997-01-01"), "customer_key")


@query("w4_scd2", f"""
SELECT CAST(customer_key AS INT) AS customer_key, c_custkey, c_mktsegment, c_nationkey, '1992-01-01' AS effective_date, CASE WHEN {MOVED_SQL} THEN '1997-01-01' ELSE '9999-12-31' END AS expiration_date, NOT {MOVED_SQL} AS is_current FROM {KEYED_SQL}
UNION ALL SELECT customer_key, c_custkey, c_mktsegment, c_nationkey, '1997-01-01', '9999-12-31', TRUE FROM {OPENED_SQL}""")
def _(t):
    return moved_dim(t).withColumns({c: F.col(c).cast("string") for c in ("effective_date", "expiration_date")})


@query("j14_lookup_keys", f"""
SELECT o_orderkey, CAST(COALESCE(n.customer_key, k.customer_key) AS DOUBLE) AS customer_key FROM orders
 LEFT JOIN {KEYED_SQL} k ON o_custkey = k.c_custkey LEFT JOIN {OPENED_SQL} n ON o_custkey = n.c_custkey""")
def _(t):
    return wh.lookup_keys(t.orders.select("o_orderkey", "o_custkey"), moved_dim(t), "o_custkey", "c_custkey", "customer_key") \
        .select("o_orderkey", F.col("customer_key").cast("double").alias("customer_key"))


def sales_fact(t):
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("store_key"),
        F.col("l_quantity").alias("quantity"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"), F.col("l_discount").alias("discount"))
    orders = t.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), F.to_date("o_orderdate").alias("order_date"))
    # Dimensions are stored tables: numbered once, then read by every lookup.
    customers = src.save(customer_dim(t).withColumnRenamed("c_custkey", "customer_id"), scratch(t.spark, "dim_customer"))
    products = src.save(wh.scd2_open(wh.with_key(t.part.select(
        F.col("p_partkey").alias("product_id"), F.col("p_type").alias("category_name"), (F.col("p_retailprice") * 0.6).alias("unit_cost")),
        ["product_id"], "product_key"), F.lit("1992-01-01")), scratch(t.spark, "dim_product"))
    return wh.star_sales(lines, orders, customers, products), customers, products


FACT_SQL = """(SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS date_key, CAST(year(o_orderdate) AS INT) AS y, CAST(month(o_orderdate) AS INT) AS m, l_orderkey AS order_id, o_custkey + 1 AS customer_key, l_partkey + 1 AS product_key, l_suppkey AS store_key,
 l_quantity AS quantity, l_quantity * (l_extendedprice / l_quantity) * (1 - l_discount) AS sales, l_quantity * (p_retailprice * 0.6) AS cost, p_type, c_mktsegment, r_name
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey
 JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


@query("w5_star_load", f"""
SELECT order_id, product_key, customer_key, store_key, date_key, quantity, ROUND(sales, 6) AS sales_amount, ROUND(sales - cost, 6) AS profit_amount FROM {FACT_SQL}""")
def _(t):
    fact, _, _ = sales_fact(t)
    return fact.select("order_id", "product_key", "customer_key", "store_key", "date_key", "quantity",
                       F.round("sales_amount", 6).alias("sales_amount"), F.round("profit_amount", 6).alias("profit_amount"))


@query("g18_sales_monthly", f"""
SELECT y AS year, m AS month_number, p_type AS category_name, c_mktsegment, r_name, ROUND(SUM(sales), 4) AS total_sales, ROUND(SUM(quantity), 4) AS total_quantity, ROUND(SUM(sales - cost), 4) AS total_profit,
 COUNT(DISTINCT order_id) AS order_count, COUNT(DISTINCT customer_key) AS customer_count, ROUND(SUM(sales), 4) / COUNT(*) AS avg_order_value FROM {FACT_SQL} GROUP BY ALL""")
def _(t):
    fact, customers, products = sales_fact(t)
    span = t.orders.agg(F.min(F.to_date("o_orderdate")).alias("lo"), F.max(F.to_date("o_orderdate")).alias("hi"))
    dates = wh.dim_date(t.spark, F.col("lo"), F.datediff("hi", "lo") + 1, span=span).select("date_key", "year", "month_number")
    stores = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")) \
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("s_suppkey").alias("store_key"), "r_name")
    dims = [(dates, "date_key"), (products.select("product_key", "category_name"), "product_key"),
            (customers.select("customer_key", "c_mktsegment"), "customer_key"), (stores, "store_key")]
    return wh.sales_monthly(fact, dims, ["year", "month_number", "category_name", "c_mktsegment", "r_name"],
                            t.lineitem.count())


@query("g19_store_daily", f"""
SELECT date_key, store_key, ROUND(SUM(sales), 4) AS total_sales, COUNT(DISTINCT order_id) AS transaction_count, COUNT(DISTINCT customer_key) AS unique_customers,
 ROUND(SUM(sales), 4) / COUNT(*) AS avg_transaction_value, ROUND(SUM(quantity), 4) AS total_items_sold FROM {FACT_SQL} GROUP BY ALL""")
def _(t):
    fact, _, _ = sales_fact(t)
    return wh.store_daily(fact, t.lineitem.count())


COUNTED = ("customer", "orders", "lineitem", "part", "supplier", "nation", "region", "events")


@query("w6_row_counts", " UNION ALL ".join(f"SELECT '{n}' AS table_name, COUNT(*) AS rows FROM {n}" for n in COUNTED))
def _(t):
    return wh.row_counts({n: getattr(t, n) for n in COUNTED})


# --- changes of tables ------------------------------------------------------------------

def old_orders(t):
    """Finished and open orders as they were before the changes."""
    return t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice").filter("o_orderstatus != 'P'")


def price_changes(t):
    """Cheap open orders at double price, and the pending orders."""
    o = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    return o.filter("o_orderstatus = 'O' AND o_totalprice < 100000").withColumn("o_totalprice", F.col("o_totalprice") * 2) \
        .unionByName(o.filter("o_orderstatus = 'P'"))


CHANGED_SQL = "(o_orderstatus = 'O' AND o_totalprice < 100000)"


@query("v4_merge", f"""
SELECT o_orderkey, o_orderstatus, CASE WHEN {CHANGED_SQL} THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
 CASE WHEN o_orderstatus = 'P' THEN 'inserted' WHEN {CHANGED_SQL} THEN 'updated' ELSE 'kept' END AS outcome FROM orders""")
def _(t):
    return ch.merged(old_orders(t), price_changes(t), "o_orderkey", ["o_totalprice"])


@query("v5_evolve", """
SELECT o_orderkey, o_orderstatus, o_totalprice, CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS o_orderpriority FROM orders""")
def _(t):
    return ch.evolved(old_orders(t), t.orders.filter("o_orderstatus = 'P'").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"))


@query("v7_cluster", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def _(t):
    path = scratch(t.spark, "clustered")
    ch.clustered(t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice"), ["o_orderkey", "o_totalprice"], 8).write.parquet(path)
    return t.spark.read.parquet(path)


@query("v9_changes", f"""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'insert' WHEN o_orderstatus = 'F' THEN 'delete' ELSE 'update' END AS change,
 CASE WHEN {CHANGED_SQL} THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice
FROM orders WHERE o_orderstatus IN ('P', 'F') OR {CHANGED_SQL}""")
def _(t):
    # Finished orders go, as in an archive run.
    new = ch.merged(old_orders(t), price_changes(t), "o_orderkey").drop("outcome").filter("o_orderstatus != 'F'")
    return ch.changes(old_orders(t), new, "o_orderkey").select("o_orderkey", "change", "o_totalprice")


@query("v10_upsert", """
SELECT c_custkey, CASE WHEN o IS NULL THEN c_acctbal ELSE o END AS c_acctbal FROM customer LEFT JOIN
 (SELECT o_custkey, arg_max(o_totalprice, o_orderkey) AS o FROM orders GROUP BY 1) ON c_custkey = o_custkey""")
def _(t):
    table = t.customer.select("c_custkey", "c_acctbal")
    incoming = t.orders.select(F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("c_acctbal"), "o_orderkey")
    return wh.upsert(table, incoming, "c_custkey", ["o_orderkey"])
