"""Cleaning and quality rules on small rows with expectations worked out by hand or in plain Python."""

import math
import statistics

import pytest
from pyspark.sql import functions as F

from tableloom.functions import scalar as fn
from tableloom.operators import clean, quality as dq


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame([
        (1, "ann o'neil-ray", "ANN@x.org ", "555-1", "5", "Python, SQL"),
        (2, "bob", "", "555-2", "", "Go"),
        (3, "cy", None, " ", "x", ""),
        (4, "di", "di@x.org", None, "9", None),
    ], "id int, name string, email string, phone string, experience_years string, skills string")


def rows(df, *cols):
    return [tuple(r) for r in df.orderBy("id").select(*cols).collect()]


def test_fill_defaults(people):
    got = rows(clean.fill(people), "email", "phone", "experience_years", "skills")
    assert got == [
        ("ANN@x.org ", "555-1", "5", "Python, SQL"), ("not_provided@example.com", "555-2", "0", "Go"),
        ("not_provided@example.com", "000-000-0000", "x", "Not specified"), ("di@x.org", "000-000-0000", "9", "Not specified")]


def test_fill_drop_and_report(people):
    assert rows(clean.fill(people, strategy="drop"), "id") == [(1,)]
    got = {r["column"]: r["missing"] for r in clean.missing_report(people, ["email", "phone", "skills"]).collect()}
    assert got == {"email": 2, "phone": 2, "skills": 2}


def test_impute_mean(people):
    assert rows(clean.impute_mean(people, ["experience_years"]), "experience_years") == [(5.0,), (7.0,), (7.0,), (9.0,)]
    none = people.withColumn("experience_years", F.lit(""))
    assert rows(clean.impute_mean(none, ["experience_years"]), "experience_years")[0] == (0.0,)


def test_normalise(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([85, 75, 90, 65, 80])], "id int, v double")
    assert [r[0] for r in rows(clean.min_max(df, "v", "s", 0, 100), "s")] == [80.0, 40.0, 100.0, 0.0, 60.0]
    z = [r[0] for r in rows(clean.z_score(df, "v", "z"), "z")]
    assert z == pytest.approx([(v - 79) / statistics.pstdev([85, 75, 90, 65, 80]) for v in [85, 75, 90, 65, 80]])
    assert [r[0] for r in rows(clean.decimal_scale(df, "v", "d"), "d")] == [0.85, 0.75, 0.9, 0.65, 0.8]
    flat = df.withColumn("v", F.lit(3.0))
    assert rows(clean.min_max(flat, "v", "s", 5, 9), "s")[0] == (5.0,)
    assert rows(clean.z_score(flat, "v", "z"), "z")[0] == (0.0,)


def test_scalar_functions(spark):
    df = spark.createDataFrame([("12abc",), ("abc",), (" -3.5 kg",), (None,), ("1e2",)], "s string")
    assert [r[0] for r in df.select(fn.leading_number(F.col("s"))).collect()] == [12.0, 0.0, -3.5, None, 100.0]
    one = spark.range(1)
    assert one.select(fn.title_case(F.lit("o'brien-smith élan 3rd"))).first()[0] == "O'Brien-Smith Élan 3Rd"
    assert one.select(fn.json_object_text(F.lit('Sure:\n```json\n{"a": {"b": 1}}\n```'))).first()[0] == '{"a": {"b": 1}}'
    assert one.select(fn.md5_partition(F.lit("abc"), 7)).first()[0] == int("900150983cd24fb0d6963f7d28e17f72", 16) % 7
    assert [one.select(fn.half_even(F.lit(x))).first()[0] for x in (0.5, 1.5, 2.5)] == [0.0, 2.0, 2.0]
    assert one.select(fn.split_list(F.lit(" a, ,b ,"))).first()[0] == ["a", "b"]


def test_etl_drops_and_elt_flags(spark):
    raw = spark.createDataFrame([
        (1, " al ", "A@B.c", None, "8", "60000"), (1, " al ", "A@B.c", None, "8", "60000"),
        (2, "bo", "nope", "1", "2 yrs", "x"), (3, "cy", None, "1", "-1", "1"),
    ], "id int, name string, email string, phone string, experience_years string, salary string")
    done = clean.etl(raw).collect()
    assert [(r["id"], r["name"], r["email"], r["experience_level"], r["salary_category"]) for r in done] == [(1, "Al", "a@b.c", "Senior", "Medium")]
    elt = {(r["id"], r["is_valid_email"], r["experience_years"], r["salary"]) for r in clean.elt(raw).collect()}
    assert elt == {(1, 1, 8.0, 60000.0), (2, 0, 2.0, 0.0)}


def test_narrow_types(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 5).alias("few"), F.col("id").cast("double").alias("x"), F.lit("a").alias("s"))
    assert dict(clean.narrow_types(df).dtypes) == {"id": "smallint", "few": "tinyint", "x": "float", "s": "string"}
    assert {r["column"]: r["new_type"] for r in clean.type_report(df).collect()}["s"] == "category"


def test_rules(spark):
    df = spark.createDataFrame([
        (1, "a@x", "10", "u"), (2, "a@x", "n", "v"), (3, None, None, None), (4, None, "99", "w")],
        "id int, email string, age string, ref string")
    reference = spark.createDataFrame([("u",), ("v",)], "ref string")
    rules = [dq.completeness("email"), dq.unique("email", "id"), dq.in_range("age", 0, 50, "warning"), dq.in_reference("ref", reference, "ref")]
    got = {r["id"]: (r["failures"], r["valid"]) for r in dq.flagged(df, rules).collect()}
    assert got == {
        1: ([], True), 2: (["email_unique", "age_range"], False), 3: (["email_complete"], False),
        4: (["email_complete", "email_unique", "age_range", "ref_reference"], False)}
    summary = dq.validate(df, rules).first()
    assert (summary["total"], summary["passed"], summary["failed"], summary["pass_rate"]) == (4, 1, 3, 0.25)
    counts = {r["rule"]: (r["violations"], r["samples"]) for r in dq.rule_results(df, rules, "id").collect()}
    assert counts["age_range"] == (2, [2, 4])
    with pytest.raises(ValueError):
        dq.gate(df, rules)


def test_pattern_is_anchored_at_the_start_only(spark):
    df = spark.createDataFrame([("ab1",), ("xab",), (None,)], "s string")
    assert [r[0] for r in df.select(dq.matches("s", "ab|zz").passes).collect()] == [True, False, True]


@pytest.mark.parametrize("values", [[3.0], [1.0, 5.0], [1.0, 2.0, 2.0, 9.0, 4.0], [float(i * 37 % 101) for i in range(200)], [7.0] * 50 + [1.0, 2.0]])
def test_baseline(spark, values):
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
    got = dq.baseline(df, "v").first()
    q = statistics.quantiles(values, n=4) if len(values) > 1 else [values[0]] * 3
    expected = (statistics.mean(values), statistics.stdev(values) if len(values) > 1 else 0.0, statistics.median(values), min(values), max(values), q[0], q[2])
    assert tuple(got) == pytest.approx(expected)


@pytest.mark.parametrize("accuracy", [8])
def test_order_statistics_narrow_their_brackets(spark, monkeypatch, accuracy):
    """Ranks found by narrowing alone, with coarse sketches, heavy ties at both ends, infinities, NaN and nulls."""
    monkeypatch.setattr(dq, "FEW_VALUES", 2)
    monkeypatch.setattr(dq, "SKETCH_ACCURACY", accuracy)
    values = [5.0] * 300 + [7.0] * 300 + [float(i * 37 % 1009) / 4 for i in range(400)] + [math.inf, -math.inf, math.nan]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v double").repartition(4)
    ranks = [1, 333, 501, 777, 1002]
    ordered = sorted(v for v in values if v == v)
    assert dq.order_statistics(df, "v", lambda n: ranks if n == 1003 else []) == [ordered[r - 1] for r in ranks]
    assert math.isnan(dq.order_statistics(df, "v", lambda n: [n])[0])
    assert dq.order_statistics(df.filter("v IS NULL"), "v", lambda n: [1]) == []
    assert dq.baseline(df.filter("v IS NULL"), "v").first()["q1"] is None


def test_outliers(spark):
    df = spark.createDataFrame([(i, 10.0 + i % 3) for i in range(60)] + [(99, 500.0)], "id int, v double")
    assert [r["id"] for r in dq.zscore_outliers(df, "v").collect()] == [99]
    assert [r["id"] for r in dq.iqr_outliers(df, "v").collect()] == [99]
    assert dq.zscore_outliers(df.withColumn("v", F.lit(1.0)), "v").count() == 0


def test_ingest(spark):
    df = spark.createDataFrame([
        ("c1", "A", "a@x.y", "5", "100", "90", "f1", 1), ("c1", "B", "a@x.y", "5", "100", "90", "f1", 2),
        ("", "C", "bad", "70", "100", "70", "f1", 3), ("c2", None, "a@x.y", "five", None, "1", "f2", 4)],
        "candidate_id string, full_name string, email string, experience_years string, current_salary string, expected_salary string, file string, n int")
    accepted, rejected, audit = dq.ingest(df, "file", ["n"])
    assert [(r["candidate_id"], r["full_name"]) for r in accepted.collect()] == [("c1", "B")]
    assert {r["rejection_reason"] for r in rejected.collect()} == {
        "Missing candidate_id; Invalid email format; Experience years out of range; Expected salary too low",
        "Missing full_name; Invalid experience_years"}
    assert {(r["file"], r["records_read"], r["records_inserted"], r["records_rejected"]) for r in audit.collect()} == {("f1", 3, 2, 1), ("f2", 1, 0, 1)}
