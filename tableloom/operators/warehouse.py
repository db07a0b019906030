"""Star schema: date dimension, surrogate keys, SCD2 dimensions, facts and summaries."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableloom.functions import scalar as fn
from tableloom.operators.ordered import join_null_safe, numbered
from tableloom.session import stored

OPEN_END = "9999-12-31"

#: About as many sales as one task of a star's joins and sums gets, whatever the fact's size.
CUBE_ROWS = 1 << 18

#: Most tasks that write one folder of a stored summary.
SUMMARY_FILES = 4

# The default holiday map.
HOLIDAYS = {
    "2023-01-01": "New Year",
    "2023-07-04": "Independence Day",
    "2023-12-25": "Christmas",
    "2024-01-01": "New Year",
}


def dim_date(spark: SparkSession, first: Column, days: Column, holidays: dict[str, str] | None = None, span: DataFrame | None = None) -> DataFrame:
    """One row per day from ``first``; the two expressions may read the one-row ``span``."""
    base = span if span is not None else spark.range(1)
    named = F.create_map(*[F.lit(x) for kv in (HOLIDAYS if holidays is None else holidays).items() for x in kv])
    out = base.select(F.explode(F.sequence(first, F.date_add(first, days - 1))).alias("d")).select(*fn.date_parts("d"))
    holiday = F.try_element_at(named, F.col("full_date"))
    return out.withColumns({
        "fiscal_quarter": F.col("quarter"),
        "is_holiday": holiday.isNotNull(),
        "holiday_name": holiday,
    })


def with_key(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Dense surrogate keys 1, 2, ... in natural-key order, without a one-task sort."""
    return numbered(df, [], order, name)


def scd2_open(df: DataFrame, effective: Column) -> DataFrame:
    """First version of a dimension: every row current and open-ended."""
    return df.withColumns({
        "effective_date": effective.cast("date"),
        "expiration_date": F.lit(OPEN_END).cast("date"),
        "is_current": F.lit(True),
    })


def scd2_merge(dim: DataFrame, updates: DataFrame, key: str, as_of: Column, surrogate: str | None = None) -> DataFrame:
    """Close changed current rows on ``as_of`` and open a new row for changed and new keys.

    ``updates`` has one row per key with the key and all tracked columns;
    rows without a change leave the dimension as it is. Opened rows get
    ``surrogate`` numbers above the largest one so far, in the order of ``key``.
    """
    tracked = [c for c in updates.columns if c != key]
    day = as_of.cast("date")
    old = dim.filter("is_current").select(key, F.struct(*tracked).alias("__old"))
    incoming = updates.select(key, F.struct(*tracked).alias("__new"))
    compared = incoming.join(old, key, "left").filter(~F.col("__new").eqNullSafe(F.col("__old")))
    closed = compared.filter(F.col("__old").isNotNull()).select(F.col(key).alias("__k"), F.lit(True).alias("__closed"))
    hit = F.col("__closed").isNotNull()
    kept = (
        dim.join(closed, (F.col(key) == F.col("__k")) & F.col("is_current"), "left")
        .withColumns({
            "expiration_date": F.when(hit, day).otherwise(F.col("expiration_date")),
            "is_current": F.col("is_current") & ~hit,
        }).select(*dim.columns)
    )
    opened = scd2_open(compared.select(key, *[F.col(f"__new.{c}").alias(c) for c in tracked]), as_of)
    if surrogate is not None:
        above = F.coalesce(dim.agg(F.max(surrogate)).scalar(), F.lit(0))
        opened = with_key(opened, [key], surrogate).withColumn(surrogate, (F.col(surrogate) + above).cast(dim.schema[surrogate].dataType))
    return kept.unionByName(opened, allowMissingColumns=True)


def lookup_keys(
    fact: DataFrame, dim: DataFrame, natural: str, dim_natural: str, surrogate: str, attributes: Sequence[str] = ()
) -> DataFrame:
    """Add the surrogate key, and attributes, of the dimension's current row; NULL where there is none."""
    current = dim.filter("is_current").select(F.col(dim_natural).alias("__nk"), surrogate, *attributes)
    return fact.join(current, F.col(natural) == F.col("__nk"), "left").drop("__nk")


def sales_measures(df: DataFrame, quantity: str, price: str, cost: str, discount: str) -> DataFrame:
    """Sales, cost, profit, 8 % tax, and 5 % shipping on sales under 100."""
    sales = F.col(quantity) * F.col(price) * (1 - F.col(discount))
    out = df.withColumns({
        "discount_amount": F.col(discount) * F.col(quantity) * F.col(price),
        "sales_amount": sales,
        "cost_amount": F.col(quantity) * F.col(cost),
    })
    return out.withColumns({
        "profit_amount": F.col("sales_amount") - F.col("cost_amount"),
        "tax_amount": F.col("sales_amount") * 0.08,
        "shipping_amount": F.when(F.col("sales_amount") < 100, F.col("sales_amount") * 0.05).otherwise(0.0),
    })


def _sales_tasks(df: DataFrame, size: int) -> int:
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-size // CUBE_ROWS))


def star_sales(lines: DataFrame, orders: DataFrame, dim_customer: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Order lines as a sales fact with date, customer and product keys.

    Columns expected: lines(order_id, product_id, store_key, quantity,
    unit_price, discount), orders(order_id, customer_id, order_date). Lines
    are counted, so that more of them meet their orders in more tasks.
    """
    tasks = _sales_tasks(lines, lines.count())
    fact = lines.repartition(tasks, "order_id").join(orders.repartition(tasks, "order_id"), "order_id").withColumn("date_key", F.date_format("order_date", "yyyyMMdd").cast("int"))
    fact = lookup_keys(fact, dim_customer, "customer_id", "customer_id", "customer_key")
    fact = lookup_keys(fact, dim_product, "product_id", "product_id", "product_key", ["unit_cost"])
    return sales_measures(fact, "quantity", "unit_price", "unit_cost", "discount").drop("order_date", "customer_id", "product_id")


def _cube(df: DataFrame, keys: Sequence[str], totals: Sequence[str], size: int) -> DataFrame:
    """Sums (to four places), counts of sales and of different orders and customers per group.

    An order has one customer, so rows are summed per order, then per customer,
    and both counts are counts of rows: no distinct count that repeats every row.
    Hardly two sales share a customer and a group, so they are dealt out once before
    they are summed, to more tasks the larger ``size``, the fact's rows, is: summed
    where they are joined, each task would hold all its rows in several tables.
    """
    kept = lambda: [F.sum(c).alias(c) for c in (*totals, "__n")]
    sales = df.select(*keys, "customer_key", "order_id", *totals).repartition(_sales_tasks(df, size), *keys, "customer_key")
    rows = sales.withColumn("__n", F.col("sales_amount").isNotNull().cast("long"))
    by_order = rows.groupBy(*keys, "customer_key", "order_id").agg(*kept())
    orders = F.count("order_id").alias("__orders")
    by_customer = by_order.groupBy(*keys, "customer_key").agg(*kept(), orders)
    return by_customer.groupBy(*keys).agg(
        *[F.round(F.sum(c), 4).alias(c) for c in totals], F.sum("__n").alias("__n"), F.sum("__orders").alias("__orders"), F.count("customer_key").alias("__customers"))


def sales_monthly(fact: DataFrame, dims: Sequence[tuple[DataFrame, str]], keys: Sequence[str], size: int | None = None) -> DataFrame:
    """Monthly cube row: sums of sales, quantity and profit, distinct orders and customers, mean sale.

    ``size``: about how many rows the fact has, where that is known; else they are counted.
    """
    joined = fact
    for dim, key in dims:
        joined = joined.join(dim, key)
    return _cube(joined, keys, ["sales_amount", "quantity", "profit_amount"], fact.count() if size is None else size).select(
        *keys, F.col("sales_amount").alias("total_sales"), F.col("quantity").alias("total_quantity"), F.col("profit_amount").alias("total_profit"),
        F.col("__orders").alias("order_count"), F.col("__customers").alias("customer_count"), (F.col("sales_amount") / F.col("__n")).alias("avg_order_value"))


def store_daily(fact: DataFrame, size: int | None = None) -> DataFrame:
    """Daily row of a store; ``size`` as in :func:`sales_monthly`."""
    keys = ["date_key", "store_key"]
    return _cube(fact, keys, ["sales_amount", "quantity"], fact.count() if size is None else size).select(
        *keys, F.col("sales_amount").alias("total_sales"), F.col("__orders").alias("transaction_count"),
        F.col("__customers").alias("unique_customers"), (F.col("sales_amount") / F.col("__n")).alias("avg_transaction_value"),
        F.col("quantity").alias("total_items_sold"))


@dataclass(frozen=True)
class Summary:
    """A stored summary per key: row count, sums and exact numbers of different values, refreshed from changes.

    Two tables lie below ``path``, both in ``buckets`` folders by hash of the keys: ``totals``
    with a row per key, ``members`` with a row per key, counted column and value and how many
    rows have it, so that a value is uncounted when its last row goes. A refresh reads and
    replaces only the folders of changed keys, and of these the summary, never the rows it was
    made from. Sums of decimals and integers are exact, those of doubles up to rounding. NULL keys are a key;
    NULL values aren't counted and add nothing. Keys without rows are left out when read.
    Changes must be given once; after a driver lost while it replaced folders, build anew.
    """

    path: str
    keys: tuple[str, ...]
    sums: tuple[str, ...] = ()
    distinct: tuple[str, ...] = ()
    buckets: int = 64

    def build(self, rows: DataFrame) -> None:
        for name, table in self._deltas(rows.withColumn("sign", F.lit(1))).items():
            # The types, also of a summary without rows.
            table.limit(0).write.mode("overwrite").parquet(f"{self.path}/{name}-types")
            self._store(name, table)

    def refresh(self, signed_rows: DataFrame) -> None:
        """Apply rows that came (``sign`` 1) and went (-1)."""
        spark, deltas = signed_rows.sparkSession, self._deltas(signed_rows)
        deltas["totals"] = stored(deltas["totals"], "summary-changes")
        touched = [r[0] for r in deltas["totals"].select("bucket").distinct().collect()]  # at most ``buckets`` numbers
        if not touched:
            return
        for name, delta in deltas.items():
            old = self._open(spark, name)
            counts = ["n", *self.sums] if name == "totals" else ["n"]
            by = [c for c in old.columns if c not in counts]
            both = old.filter(F.col("bucket").isin(touched)).unionByName(delta)
            new = both.groupBy(*by).agg(*[F.sum(c).cast(old.schema[c].dataType).alias(c) for c in counts])
            self._store(name, new, "dynamic")

    def read(self, spark: SparkSession) -> DataFrame:
        """Keys, ``n``, the sums, and ``distinct_<column>`` for each counted column."""
        totals, members = (self._open(spark, name).filter("n > 0") for name in ("totals", "members"))
        if not self.distinct:
            return totals.drop("bucket")
        counts = members.groupBy("bucket", *self.keys).agg(*[F.count_if(F.col("counted") == c).alias(f"distinct_{c}") for c in self.distinct])
        zero = {c: F.coalesce(c, F.lit(0)) for c in (f"distinct_{d}" for d in self.distinct)}
        return join_null_safe(totals, counts, ["bucket", *self.keys], "left").withColumns(zero).drop("bucket")

    def _deltas(self, rows: DataFrame) -> dict[str, DataFrame]:
        placed = rows.withColumn("bucket", F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))
        by = ["bucket", *self.keys]
        zero = F.sum("sign") * 0
        sums = [F.coalesce(F.sum(F.col(c) * F.col("sign")), zero).alias(c) for c in self.sums]
        values = [F.struct(F.lit(c).alias("counted"), F.col(c).cast("string").alias("value")) for c in self.distinct]
        listed = F.array(*values) if values else F.array().cast("array<struct<counted:string,value:string>>")
        members = placed.select(*by, "sign", F.inline(listed)).filter("value IS NOT NULL")
        return {"totals": placed.groupBy(*by).agg(F.sum("sign").alias("n"), *sums),
                "members": members.groupBy(*by, "counted", "value").agg(F.sum("sign").alias("n"))}

    def _open(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.schema(spark.read.parquet(f"{self.path}/{name}-types").schema).parquet(f"{self.path}/{name}")

    def _store(self, name: str, rows: DataFrame, overwrite: str = "static") -> None:
        # A folder's rows are dealt out to several tasks, so a key with very many values is not one task's.
        spread = rows.repartition("bucket", F.pmod(F.xxhash64(*rows.columns), F.lit(SUMMARY_FILES)))
        spread.write.partitionBy("bucket").mode("overwrite").option("partitionOverwriteMode", overwrite).parquet(f"{self.path}/{name}")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows") for name, df in tables.items()
    ]
    out = counted[0]
    for part in counted[1:]:
        out = out.unionByName(part)
    return out


def latest_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The last row of each key by ``order``, with map-side combining."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r")).select(key, "r.*").select(*df.columns)


def upsert(table: DataFrame, incoming: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """INSERT OR REPLACE: the last incoming row of a key replaces the stored one."""
    last = latest_per_key(incoming, key, order).select(*table.columns)
    return table.join(last.select(key), key, "left_anti").select(*table.columns).unionByName(last)


def analysis_star(analysis: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Fact, skill and suggestion rows of analysis records.

    Needs analysis_id, overall_score, match_score, experience_years,
    experience_level and the arrays skills, matched, suggestions.
    """
    fact = analysis.select(
        "analysis_id", "overall_score", F.coalesce("match_score", F.lit(0)).alias("job_match_score"),
        "experience_years", "experience_level", F.size("skills").alias("skills_count"))
    found = analysis.select("analysis_id", F.explode("skills").alias("skill_name"),
                            F.lit("technical").alias("skill_category"), F.lit(0).alias("is_matched"))
    matched = analysis.select("analysis_id", F.explode("matched").alias("skill_name"),
                              F.lit("matched").alias("skill_category"), F.lit(1).alias("is_matched"))
    hints = analysis.select("analysis_id", F.explode("suggestions").alias("suggestion"))
    return fact, found.unionByName(matched), hints
