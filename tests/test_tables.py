"""Sources, star schema and changes of tables."""

import hashlib
import json
import os
from collections import Counter
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableloom.operators import changes as ch, relational as rel, warehouse as wh
from tableloom.session import scratch
from tableloom.sources import files as src


def rows(df, *cols):
    found = (tuple(r) for r in df.select(*cols).collect())
    return sorted(found, key=lambda r: [(v is None, 0 if v is None else v) for v in r])


def orders(spark):
    return spark.range(100).select("id", (F.col("id") % 4).alias("part"), (F.col("id") * 10).alias("score"))


def test_merge_updates_and_inserts(spark):
    source = spark.createDataFrame([(4, 0, 999), (500, 0, 7), (None, 1, 1)], "id long, part long, score long")
    got = ch.merged(orders(spark), source, "id")
    assert {r["outcome"]: r["count"] for r in got.groupBy("outcome").count().collect()} == {"kept": 99, "updated": 1, "inserted": 2}
    byid = {r["id"]: (r["part"], r["score"]) for r in got.collect()}
    assert byid[4] == (0, 999) and byid[500] == (0, 7) and byid[5] == (1, 50) and byid[None] == (1, 1)
    again = ch.merged(got.drop("outcome").filter("id IS NOT NULL"), source.filter("id IS NOT NULL"), "id").drop("outcome")
    assert rows(again, "*") == rows(got.drop("outcome").filter("id IS NOT NULL"), "*")


def test_merge_of_chosen_columns(spark):
    source = spark.createDataFrame([(4, 999), (500, 7)], "id long, score long")
    byid = {r["id"]: (r["part"], r["score"]) for r in ch.merged(orders(spark), source, "id", ["score"]).collect()}
    assert byid[4] == (0, 999) and byid[500] == (None, 7)


def test_evolve_and_changes(spark):
    old = orders(spark)
    new = ch.evolved(old, spark.createDataFrame([(300, "x")], "id long, url string"))
    assert new.columns == ["id", "part", "score", "url"]
    assert rows(new.filter("id >= 299"), "*") == [(300, None, None, "x")]
    new = ch.merged(new, spark.createDataFrame([(1, 1, -1, "y"), (301, 1, 0, None)], "id long, part long, score long, url string"), "id").drop("outcome")
    changed = {r["id"]: (r["change"], r["score"]) for r in ch.changes(old, new, "id").collect()}
    assert changed == {300: ("insert", None), 1: ("update", -1), 301: ("insert", 0)}
    back = {r["id"]: r["change"] for r in ch.changes(new, old, "id").collect()}
    assert back == {300: "delete", 301: "delete", 1: "update"}


def test_types_must_agree(spark):
    table = spark.createDataFrame([(1, 2)], "id long, x int")
    with pytest.raises(ValueError):
        ch.evolved(table, spark.createDataFrame([(2, "a")], "id long, x string"))
    assert ch.evolved(table, spark.createDataFrame([(2,)], "id int")).dtypes == table.dtypes


def test_clustering_keeps_rows_and_codes_are_not_negative(spark):
    table = orders(spark)
    assert rows(ch.clustered(table, ["id", "score"], 3), "*") == rows(table, "*")
    wide = table.select("id", *[(F.col("id") * (i + 1)).alias(f"c{i}") for i in range(7)])
    for n in (1, 2, 4, 5, 7):
        code = ch.z_order(wide, [f"c{i}" for i in range(n)])
        low, high = wide.select(code.alias("z")).agg(F.min("z"), F.max("z")).first()
        assert low == 0 and high > 0


def test_files_of_skewed_columns_are_skipped(spark):
    """Both columns skewed, the values of one shared by a third of the rows: a narrow filter reads few files, on either column."""
    table = spark.range(40000).select("id", F.pow(2.0, (F.col("id") * 7919 % 40000) / 2000).alias("x"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.pow(F.col("id") % 1000, 3)).alias("y"))
    path = scratch(spark, "clustered")
    ch.clustered(table, ["x", "y"], 64).write.parquet(path)
    back = spark.read.parquet(path)
    ranges = ch.file_ranges(back, ["x", "y"]).cache()
    assert rows(back, "id", "x", "y") == rows(table, "id", "x", "y") and ranges.agg(F.sum("rows")).first()[0] == 40000
    assert ranges.agg(F.max("rows")).first()[0] < 4 * 40000 / 64
    for column in ("x", "y"):
        for low, high in table.agg(F.percentile(column, F.array(*[F.lit(p) for p in (0.5, 0.52, 0.9, 0.92)])).alias("p")).select(F.array(F.struct(F.get("p", F.lit(0)), F.get("p", F.lit(1))), F.struct(F.get("p", F.lit(2)), F.get("p", F.lit(3))))).first()[0]:
            assert ranges.agg(ch.share_read(column, low, high)).first()[0] <= 0.35
    assert ranges.agg(ch.share_read("x", -5, -1)).first()[0] == 0
    ranges.unpersist()


def test_refreshed_summary_equals_a_rebuilt_one(spark):
    """Keys that come and go, updates, values whose last row goes, nulls; folders of other keys are not replaced."""
    before = spark.range(300).select("id", F.when(F.col("id") % 10 != 0, F.col("id") % 10).alias("k"), (F.col("id") % 7).cast("decimal(12,2)").alias("x"), F.when(F.col("id") % 4 != 0, F.col("id") % 13).alias("v"))
    first = before.filter("id < 250 AND (k IS NULL OR k != 3)")
    then = before.filter("id >= 20 AND (k IS NULL OR k NOT IN (4, 5))").withColumn("x", F.when(F.col("k") == 6, F.col("x") + 1).otherwise(F.col("x")).cast("decimal(12,2)"))
    last = then.filter("k IS NULL OR k != 7").withColumn("v", F.when(F.col("k") == 8, None).otherwise(F.col("v")))
    summary = wh.Summary(scratch(spark, "summary"), ("k",), ("x",), ("v",))
    state = first
    summary.build(first)
    for new in (then, last, last):
        files = set(spark.read.parquet(f"{summary.path}/totals").inputFiles())
        summary.refresh(ch.signed(ch.changes(state, new, "id"), state, "id"))
        state = new
        expected = new.groupBy("k").agg(F.count("*").alias("n"), F.sum("x").cast("decimal(38,2)").alias("x"), F.count_distinct("v").alias("distinct_v"))
        got = summary.read(spark)
        key = lambda r: (r[0] is not None, r)
        assert sorted(map(tuple, got.select("k", "n", "x", "distinct_v").collect()), key=key) == sorted(map(tuple, expected.collect()), key=key)
        kept = files & set(spark.read.parquet(f"{summary.path}/totals").inputFiles())
    assert kept == files  # no change, nothing written
    summary.refresh(spark.createDataFrame([(9, 1, -1)], "k long, v long, sign int").withColumn("x", F.lit(0).cast("decimal(12,2)")))
    assert len(files - set(spark.read.parquet(f"{summary.path}/totals").inputFiles())) == 1
    nothing = wh.Summary(scratch(spark, "summary"), ("k",), (), ())
    nothing.build(first.limit(0))
    assert nothing.read(spark).count() == 0


def test_tolerant_load(spark):
    path = scratch(spark, "csv")
    spark.createDataFrame([(str(i), "x" if i in (3, 5) else str(i)) for i in range(10)], "a string, b string").write.option("header", True).csv(path)
    schema = T.StructType.fromDDL("a int, b int")
    kept = src.load_csv(spark, path, schema, 2)
    assert kept.count() == 8 and kept.select("a").count() == 8
    with pytest.raises(PySparkException):
        src.load_csv(spark, path, schema, 1).collect()


def test_text_sources(spark):
    path = scratch(spark, "text")
    spark.createDataFrame([("2024-01-02T03:04:05 [WARN] disk [x] full",), ("junk",)], "value string").coalesce(1).write.text(path)
    assert [tuple(r) for r in src.parse_log(src.read_text(spark, path)).collect()] == [(datetime(2024, 1, 2, 3, 4, 5), "WARN", "disk [x] full")]
    raw = spark.createDataFrame([(bytearray("né".encode() + b"\xff!"),)], "b binary")
    assert raw.select(F.replace(F.make_valid_utf8(F.col("b").cast("string")), F.lit("�"), F.lit(""))).first()[0] == "né!"


def test_inventory_and_checksums(spark):
    path = scratch(spark, "files")
    for name in ("a", "b"):
        spark.range(20).coalesce(1).write.csv(f"{path}/{name}")
    spark.range(5).coalesce(1).write.csv(f"{path}/c")
    listed = src.list_files(spark, path, "part-").collect()
    assert len(listed) == 3 and src.list_files(spark, path, "none").count() == 0
    size = src.store_size(spark, path).first()
    assert size["object_count"] == 3 and size["total_size_bytes"] == sum(r["size"] for r in listed)
    assert size["total_size_mb"] == round(size["total_size_bytes"] / 1048576, 4)
    twice = src.duplicate_files(src.list_files(spark, path)).collect()
    assert [r["copies"] for r in twice] == [2] and "/a/" in twice[0]["first_path"]
    sums = {r["path"]: r["md5"] for r in src.file_hashes(src.list_files(spark, path)).collect()}
    assert len(sums) == 3 and sums[twice[0]["first_path"]] == twice[0]["md5"]


@pytest.mark.parametrize("block", [1, 7, 64, 1 << 20])
def test_json_array_read_by_several_tasks(spark, monkeypatch, block):
    """Strings with brackets, commas, quotes and runs of backslashes, nested values, white space, empty arrays, and cuts at any byte."""
    monkeypatch.setattr(src, "READ_BYTES", 5)
    root = scratch(spark, "arrays")
    os.makedirs(root)
    texts = ["plain", "a],[{b", 'q"u"o,te', "back\\", "back\\\\", '\\"', "\\" * 40 + '"', "ünïcode ☃", "", '"', "}" * 9]
    records = [{"id": i, "text": t, "list": [t, "x"] if i % 2 else [], "in": {"a": i}} for i, t in enumerate(texts)]
    files = {"one": json.dumps(records), "two": " \n" + json.dumps(records, indent=2, ensure_ascii=False) + "\n", "none": "[]", "blank": " [ \n ] ", "single": "[" + json.dumps(records[5]) + "]"}
    for name, text in files.items():
        with open(f"{root}/{name}", "w", encoding="utf-8") as file:
            file.write(text)
    found = src.json_elements(src.list_files(spark, root), block)
    got = sorted(json.dumps(json.loads(r["element"])) for r in found.collect())
    assert got == sorted(json.dumps(r) for r in [*records, *records, records[5]])
    if block == 64:
        back = src.read_json(spark, root, "id long, text string, list array<string>", array_files=True)
        assert sorted((r["id"], r["text"], r["list"]) for r in back.collect()) == sorted((r["id"], r["text"], r["list"]) for r in [*records, *records, records[5]])
        for bad in ('{"id": 1}', '[{"id": 1}, {"id"'):
            path = scratch(spark, "bad")
            os.makedirs(path)
            with open(f"{path}/x", "w") as file:
                file.write(bad)
            with pytest.raises(PySparkException):
                src.json_elements(src.list_files(spark, path), block).collect()


def test_duplicates_of_files_in_many_blocks(spark):
    """Binary files against whole checksums: copies, one byte changed in any block, blocks in another order, sizes at and beside block ends, empty files (not listed), odd names."""
    root = scratch(spark, "blocks")
    os.makedirs(f"{root}/sub folder")
    base = bytes(range(256)) * 5
    contents = {"a": base, "b c%20d": base, "sub folder/ä": base, "last": base[:-1] + b"x", "first": b"x" + base[1:], "turned": base[100:200] + base[:100] + base[200:],
                "edge": base[:200], "edge2": base[:200], "over": base[:201], "none": b"", "none2": b"", "one": b"q", "other": b"r"}
    for name, content in contents.items():
        with open(f"{root}/{name}", "wb") as file:
            file.write(content)
    expected = Counter((hashlib.md5(c).hexdigest(), len(c)) for c in contents.values() if c)
    for block in (100, 1 << 20):
        got = src.duplicate_files(src.list_files(spark, root), block).collect()
        assert {(r["md5"], r["length"]): r["copies"] for r in got} == {k: n for k, n in expected.items() if n > 1}
    assert Counter((r["md5"], r["length"]) for r in src.file_hashes(src.list_files(spark, root)).collect()) == expected


def test_approximate_count(spark):
    import __spark_entry__ as entry
    got = {r[0]: r[1] for r in entry.queries()["g6_approx_distinct"](spark, "/root/testdata/sf0.001").collect()}
    exact = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").groupBy("l_returnflag").agg(F.count_distinct("l_partkey")).collect()
    assert all(abs(got[f] - n) <= 0.1 * n for f, n in exact)


def test_partitioned_save_prunes(spark):
    stored = src.save(spark.range(50).select("id", (F.col("id") % 5).alias("p")), scratch(spark, "p"), partition_by=["p"], cluster_by=["id"])
    plan = stored.filter("p = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan
    assert stored.filter("p = 2").count() == 10


def test_scd2_is_idempotent_and_closes_rows(spark):
    dim = wh.scd2_open(spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string"), F.lit("2020-01-01"))
    updates = spark.createDataFrame([(1, "a"), (2, "c"), (3, "d"), (4, "e")], "k int, v string")
    once = wh.scd2_merge(dim, updates, "k", F.lit("2021-01-01"))
    got = {(r["k"], r["v"], str(r["effective_date"]), str(r["expiration_date"]), r["is_current"]) for r in once.collect()}
    assert got == {
        (1, "a", "2020-01-01", "9999-12-31", True), (2, "b", "2020-01-01", "2021-01-01", False), (2, "c", "2021-01-01", "9999-12-31", True),
        (3, None, "2020-01-01", "2021-01-01", False), (3, "d", "2021-01-01", "9999-12-31", True), (4, "e", "2021-01-01", "9999-12-31", True)}
    again = wh.scd2_merge(once, updates, "k", F.lit("2022-01-01"))
    assert rows(again, "*") == rows(once, "*")


def test_dim_date_default(spark):
    days = wh.dim_date(spark, F.lit("2023-01-01").cast("date"), F.lit(730))
    assert days.count() == 730
    new_year = days.filter("date_key = 20240101").first()
    assert (new_year["day_of_week"], new_year["holiday_name"], new_year["week_of_year"]) == (0, "New Year", 1)
    assert days.filter("is_holiday").count() == 4


def test_sales_measures(spark):
    df = spark.createDataFrame([(2, 30.0, 10.0, 0.5), (1, 200.0, 150.0, 0.0)], "q int, p double, c double, d double")
    got = [tuple(r) for r in wh.sales_measures(df, "q", "p", "c", "d").select(
        "discount_amount", "sales_amount", "cost_amount", "profit_amount", "tax_amount", "shipping_amount").collect()]
    assert got == [pytest.approx((30.0, 30.0, 20.0, 10.0, 2.4, 1.5)), pytest.approx((0.0, 200.0, 150.0, 50.0, 16.0, 0.0))]


def test_upsert_last_wins(spark):
    stored = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    incoming = spark.createDataFrame([(2, "c", 1), (2, "d", 2), (3, "e", 1)], "k int, v string, n int")
    assert rows(wh.upsert(stored, incoming, "k", ["n"]), "*") == [(1, "a"), (2, "d"), (3, "e")]


def test_join_strategy_is_named(spark):
    big, small = spark.range(1000).withColumnRenamed("id", "k"), spark.range(10).withColumnRenamed("id", "k")
    plan = lambda d: d._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(rel.join(big, small, ["k"], hint="broadcast"))
    assert "strategy" not in plan(rel.join(big, small, ["k"]))
    a = spark.createDataFrame([(None, 1), (2, 2)], "k int, x int")
    b = spark.createDataFrame([(None, 5), (2, 6)], "k int, y int")
    assert rel.join(a, b, ["k"]).count() == 1 and rel.join(a, b, ["k"], null_safe=True).count() == 2


def test_pairs_and_bands(spark):
    df = spark.createDataFrame([("g", i) for i in (5, 1, 3)] + [("h", 9), (None, 1), (None, 2)], "g string, id int")
    assert rows(rel.pairs_within(df, "g", "id"), "id_1", "id_2") == [(1, 3), (1, 5), (3, 5)]
    people = spark.createDataFrame([(1, -5.0), (2, 10.0), (3, 19.9), (4, 20.0), (5, None)], "p int, have double")
    bands = spark.createDataFrame([(-10.0, "a"), (10.0, "b")], "low double, name string")
    assert rows(rel.in_band(people, "have", bands, 10.0), "p", "name") == [(1, "a"), (2, "b"), (3, "b")]


def test_overlapping_ranges(spark):
    """Against a nested loop, with ties, ranges of one value, ends turned round, and nulls in keys, values and ends."""
    people = [(i, i * 7 % 23 if i % 9 else None, None if i % 5 == 0 else "ab"[i % 2]) for i in range(120)]
    ranges = [(i * 5 % 19, i * 5 % 19 + i % 6 - 1 if i % 8 else None, None if i % 4 == 0 else "ab"[i // 2 % 2]) for i in range(90)]
    got = rel.in_ranges(spark.createDataFrame(people, "p int, have int, k string"), "have",
                        spark.createDataFrame(ranges, "low int, high int, k string"), "low", "high", ["k"])
    assert got.columns == ["p", "have", "k", "ranges_held", "best_high"]
    for r in got.collect():
        held = [h for lo, h, k in ranges if h is not None and r["have"] is not None and k == r["k"] and lo <= r["have"] <= h]
        assert (r["ranges_held"], r["best_high"]) == (len(held), max(held, default=None))
    assert got.count() == 120


def test_sketches_of_slices(spark):
    df = spark.range(20000).select((F.col("id") % 2).alias("k"), (F.col("id") % 30).alias("day"), (F.col("id") % 7001).alias("v"))
    sketches = rel.distinct_sketches(df, ["k"], "day", "v")
    assert sketches.count() == 30
    for r in rel.sketched_counts(sketches, ["k"]).collect():
        assert abs(r["approx_distinct"] - 7001) <= 7001 * 3 * 1.04 / 64


def test_opened_versions_get_new_keys(spark):
    dim = wh.scd2_open(wh.with_key(spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string"), ["id"], "k"), F.lit("2020-01-01"))
    new = wh.scd2_merge(dim, spark.createDataFrame([(2, "c"), (1, "a"), (7, "z")], "id long, v string"), "id", F.lit("2021-01-01"), "k")
    assert rows(new.filter("is_current"), "id", "v", "k") == [(1, "a", 1), (2, "c", 3), (7, "z", 4)]


def test_qualified_counts_keep_zero(spark):
    have = spark.createDataFrame([("s", 1, 3), ("s", 1, 5), ("s", 2, 2)], "item string, person int, level int")
    need = spark.createDataFrame([("s", 3), ("s", 9), ("t", 1)], "item string, required int")
    assert rows(rel.qualified_counts(have, need, "item", "person", "level", "required"), "item", "required", "qualified") == [("s", 3, 1), ("s", 9, 0), ("t", 1, 0)]


def test_collect_by_key_chunks(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("k"), "id")
    got = rel.collect_by_key(df, "k", "id", ["id"], 20).collect()
    assert max(len(r["values"]) for r in got) == 20
    assert sorted(v for r in got for v in r["values"]) == list(range(100))


def test_fold_with_partitions_without_rows(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 2.0)], "k string, v double").coalesce(1)
    for some in (df.unionByName(df.filter("v > 9")), df.filter("v > 9").unionByName(df.filter("v > 9"))):
        want = [("a", 3.0), ("b", 2.0)] if some.count() else []
        assert rows(rel.reduce_by_key(some, "k", "v", max), "k", "v") == want


def test_cubes_deal_out_sales_by_size(spark, monkeypatch):
    monkeypatch.setattr(wh, "CUBE_ROWS", 5)
    sales = [(1 + i % 3, i % 4, i // 2, None if i % 7 == 0 else i % 5, float(i), 1.0) for i in range(60)]
    fact = spark.createDataFrame(sales, "date_key int, store_key int, order_id long, customer_key long, sales_amount double, quantity double")
    daily = wh.store_daily(fact)
    assert "hashpartitioning(date_key" in (plan := daily._jdf.queryExecution().toString()) and ", 12), REPARTITION_BY_NUM" in plan
    want = []
    for day, store in {s[:2] for s in sales}:
        own = [s for s in sales if s[:2] == (day, store)]
        total = sum(s[4] for s in own)
        want.append((day, store, total, len({(s[3], s[2]) for s in own}), len({s[3] for s in own} - {None}), total / len(own), float(len(own))))
    assert rows(daily, *daily.columns) == sorted(want)
