"""Scalar function, cleaning and data-quality queries."""

from pyspark.sql import functions as F

from tableloom.functions import scalar as fn
from tableloom.operators import clean, quality as dq
from tableloom.plans.registry import query

# Raw candidates derived from customers by the same text in both engines: blanks,
# NULLs, bad numbers and duplicates appear at fixed keys.
RAW = """SELECT c_custkey AS id,
 ' ' || lower(c_mktsegment) || ' o''brien-' || lower(substr(c_name, 1, 8)) || ' ' AS name,
 CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 10 = 1 THEN '  ' WHEN c_custkey % 10 = 2 THEN 'bad-address'
  ELSE ' User' || CAST(c_custkey AS STRING) || '@Example.COM ' END AS email,
 CASE WHEN c_custkey % 7 = 0 THEN '' WHEN c_custkey % 7 = 1 THEN NULL ELSE '555-' || CAST(c_nationkey AS STRING) END AS phone,
 CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 13 = 1 THEN 'n/a' WHEN c_custkey % 13 = 2 THEN '4 years'
  ELSE CAST(c_custkey % 23 - 1 AS STRING) END AS experience_years,
 CASE WHEN c_custkey % 17 = 0 THEN 'unknown' ELSE CAST(c_nationkey * 8000 AS STRING) END AS salary
FROM {customer}"""
RAW_SQL = "(" + RAW.format(customer="customer") + ")"


def raw(t):
    return t.spark.sql(RAW, customer=t.customer)


# A twice-loaded raw table, so that duplicates exist.
def raw_twice(t):
    return raw(t).unionByName(raw(t).filter("salary = '8000'"))


RAW_TWICE_SQL = f"(SELECT * FROM {RAW_SQL} UNION ALL SELECT * FROM {RAW_SQL} WHERE salary = '8000')"

# --- scalar functions -------------------------------------------------------------


@query("f1_trim_case", f"SELECT id, trim(name) AS a, lower(trim(email)) AS b, upper(name) AS c FROM {RAW_SQL}")
def _(t):
    return raw(t).select("id", F.trim("name").alias("a"), F.lower(F.trim("email")).alias("b"), F.upper("name").alias("c"))


TITLE_SQL = r"array_to_string(list_transform(regexp_extract_all({0}, '\p{{L}}+|\P{{L}}+'), lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), '')"


@query("f2_title", f"SELECT id, {TITLE_SQL.format('name')} AS title FROM {RAW_SQL}")
def _(t):
    return raw(t).select("id", fn.title_case(F.col("name")).alias("title"))


@query("f3_coalesce", f"SELECT id, COALESCE(NULLIF(TRIM(phone), ''), '000-000-0000') AS phone FROM {RAW_SQL}")
def _(t):
    return raw(t).select("id", F.coalesce(fn.blank_to_null(F.col("phone")), F.lit("000-000-0000")).alias("phone"))


LEADING_SQL = r"CASE WHEN {0} IS NULL THEN NULL ELSE COALESCE(TRY_CAST(regexp_extract({0}, '^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)', 1) AS DOUBLE), 0) END"


@query("f4_safe_cast", f"SELECT id, TRY_CAST(experience_years AS DOUBLE) AS strict, {LEADING_SQL.format('experience_years')} AS leading FROM {RAW_SQL}")
def _(t):
    y = F.col("experience_years")
    return raw(t).select("id", fn.to_number(y).alias("strict"), fn.leading_number(y).alias("leading"))


@query("f5_round", "SELECT l_orderkey, l_linenumber, ROUND(l_extendedprice / 7, 2) AS r FROM lineitem")
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", F.round(F.col("l_extendedprice") / 7, 2).alias("r"))


@query("f6_half_even", "SELECT p_partkey, CAST(round_even(p_size / 2.0, 0) AS BIGINT) AS half FROM part")
def _(t):
    return t.part.select("p_partkey", fn.half_even(F.col("p_size") / 2).cast("long").alias("half"))


@query("f7_capped_percent", "SELECT p_partkey, CAST(LEAST(floor(CAST(p_size AS DOUBLE) / 40 * 100), 100) AS INT) AS pct FROM part")
def _(t):
    return t.part.select("p_partkey", fn.capped_percent(F.col("p_size").cast("double"), F.lit(40)).alias("pct"))


DATE_SQL = """CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, CAST(d AS STRING) AS full_date, CAST(isodow(d) - 1 AS INT) AS day_of_week, dayname(d) AS day_name,
 CAST(day(d) AS INT) AS day_of_month, CAST(dayofyear(d) AS INT) AS day_of_year, CAST(weekofyear(d) AS INT) AS week_of_year,
 CAST(month(d) AS INT) AS month_number, monthname(d) AS month_name, CAST(quarter(d) AS INT) AS quarter, CAST(year(d) AS INT) AS year, isodow(d) >= 6 AS is_weekend"""


@query("f8_date_parts", f"SELECT o_orderkey, {DATE_SQL} FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)")
def _(t):
    return t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("d")).select("o_orderkey", *fn.date_parts("d"))


@query("f9_hour", "SELECT event_id, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour FROM events")
def _(t):
    return t.events.select("event_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").cast("string").alias("hour"))


@query("f10_split_list", """
SELECT p_partkey, array_to_string(list_filter(list_transform(string_split(s, ','), lambda x: trim(x)), lambda x: x <> ''), '|') AS parts
FROM (SELECT p_partkey, replace(p_name, ' ', ' , ') || ', ,' || p_type AS s FROM part)""")
def _(t):
    s = F.concat(F.replace("p_name", F.lit(" "), F.lit(" , ")), F.lit(", ,"), F.col("p_type"))
    return t.part.select("p_partkey", F.array_join(fn.split_list(s), "|").alias("parts"))


@query("f11_size_first", """
SELECT p_partkey, CAST(len(string_split(p_name, ' ')) AS INT) AS n, string_split(p_name, ' ')[1] AS first FROM part""")
def _(t):
    w = F.split("p_name", " ")
    return t.part.select("p_partkey", F.size(w).alias("n"), F.get(w, F.lit(0)).alias("first"))


@query("f12_fingerprint", """
SELECT c_custkey, md5('{"c_custkey":' || c_custkey || ',"c_mktsegment":"' || c_mktsegment || '","c_name":"' || c_name || '"}') AS h FROM customer""")
def _(t):
    return t.customer.select("c_custkey", fn.fingerprint(["c_name", "c_mktsegment", "c_custkey"]).alias("h"))


@query("f13_md5_partition", """
SELECT c_custkey, CAST((CAST('0x' || substr(h, 1, 8) AS UBIGINT) % 6 * 4 + CAST('0x' || substr(h, 9, 8) AS UBIGINT) % 6 * 4
 + CAST('0x' || substr(h, 17, 8) AS UBIGINT) % 6 * 4 + CAST('0x' || substr(h, 25, 8) AS UBIGINT)) % 6 AS INT) AS part FROM (SELECT c_custkey, md5(c_name) AS h FROM customer)""")
def _(t):
    return t.customer.select("c_custkey", fn.md5_partition(F.col("c_name"), 6).alias("part"))


@query("f14_json_field", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events")
def _(t):
    return t.events.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


@query("f15_clean_word", r"SELECT c_custkey, regexp_replace(c_name || ' é-ß', '[^\p{L}\p{N}]', '', 'g') AS w FROM customer")
def _(t):
    return t.customer.select("c_custkey", fn.clean_word(F.concat("c_name", F.lit(" é-ß"))).alias("w"))


@query("f16_json_from_reply", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k, props AS body FROM events")
def _(t):
    reply = F.concat(F.lit("Here it is:\n```json\n"), F.col("props"), F.lit("\n``` done"))
    body = fn.json_object_text(reply)
    return t.events.select("event_id", F.from_json(body, "k int")["k"].alias("k"), body.alias("body"))


@query("f17_percent_change", """
SELECT l_orderkey, l_linenumber, ROUND((l_extendedprice - l_quantity * 937) / (l_quantity * 937) * 100, 2) + 0.0 AS pct FROM lineitem""")
def _(t):
    then = F.col("l_quantity") * 937
    return t.lineitem.select("l_orderkey", "l_linenumber", fn.percent_change(F.col("l_extendedprice"), then).alias("pct"))


@query("f18_bucket_right", "SELECT p_partkey, CASE WHEN p_size <= 10 THEN 'S' WHEN p_size <= 30 THEN 'M' ELSE 'L' END AS b FROM part")
def _(t):
    from tableloom.operators.relational import bucket
    return t.part.select("p_partkey", bucket(F.col("p_size"), [10, 30], ["S", "M", "L"], right=True).alias("b"))


@query("f19_bucket_left", "SELECT p_partkey, CASE WHEN p_size < 10 THEN 'S' WHEN p_size < 30 THEN 'M' ELSE 'L' END AS b FROM part")
def _(t):
    from tableloom.operators.relational import bucket
    return t.part.select("p_partkey", bucket(F.col("p_size"), [10, 30], ["S", "M", "L"]).alias("b"))


@query("f20_levels", """
SELECT p_partkey, CASE WHEN y >= 8 THEN 'Principal/Staff' WHEN y >= 5 THEN 'Senior' WHEN y >= 3 THEN 'Mid-Level' WHEN y >= 1 THEN 'Junior' ELSE 'Entry Level' END AS five,
 CASE WHEN y >= 7 THEN 'Senior' WHEN y >= 3 THEN 'Mid' ELSE 'Junior' END AS three,
 CASE WHEN y < 3 THEN 'Junior' WHEN y < 7 THEN 'Mid-level' ELSE 'Senior' END AS long_three FROM (SELECT p_partkey, p_size % 12 AS y FROM part)""")
def _(t):
    y = F.col("p_size") % 12
    return t.part.select("p_partkey", fn.level(y).alias("five"), fn.level(y, fn.THREE_STEP).alias("three"),
                         fn.level(y, fn.THREE_STEP_LONG).alias("long_three"))


@query("f21_composite", "SELECT c_custkey, c_acctbal * 0.5 + c_nationkey * 5000 + 3 * 10000 AS s FROM customer")
def _(t):
    return t.customer.select("c_custkey", fn.composite_score(F.col("c_acctbal"), F.col("c_nationkey"), F.lit(3)).alias("s"))


# --- cleaning ---------------------------------------------------------------------

MISSING = "({0} IS NULL OR trim({0}) = '')"


@query("c1_fill", f"""
SELECT id, CASE WHEN {MISSING.format('email')} THEN 'not_provided@example.com' ELSE email END AS email,
 CASE WHEN {MISSING.format('phone')} THEN '000-000-0000' ELSE phone END AS phone,
 CASE WHEN {MISSING.format('experience_years')} THEN '0' ELSE experience_years END AS experience_years FROM {RAW_SQL}""")
def _(t):
    return clean.fill(raw(t), ["email", "phone", "experience_years"]).select("id", "email", "phone", "experience_years")


@query("c2_drop_missing", f"SELECT id, email, phone FROM {RAW_SQL} WHERE NOT {MISSING.format('email')} AND NOT {MISSING.format('phone')}")
def _(t):
    return clean.fill(raw(t), ["email", "phone"], strategy="drop").select("id", "email", "phone")


@query("c3_impute_mean", f"""
SELECT id, ROUND(COALESCE(TRY_CAST(experience_years AS DOUBLE), (SELECT AVG(TRY_CAST(experience_years AS DOUBLE)) FROM {RAW_SQL})), 8) AS experience_years FROM {RAW_SQL}""")
def _(t):
    return clean.impute_mean(raw(t), ["experience_years"]).select("id", F.round("experience_years", 8).alias("experience_years"))


@query("c4_missing_report", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", COUNT(*) FILTER (WHERE {MISSING.format(c)}) AS missing FROM {RAW_SQL}" for c in ("email", "phone", "experience_years", "salary")))
def _(t):
    return clean.missing_report(raw(t), ["email", "phone", "experience_years", "salary"])


@query("c5_min_max", """
SELECT o_orderkey, ROUND((o_totalprice - lo) / (hi - lo) * 100, 8) AS scaled FROM orders, (SELECT MIN(o_totalprice) AS lo, MAX(o_totalprice) AS hi FROM orders)""")
def _(t):
    return clean.min_max(t.orders, "o_totalprice", "scaled", 0, 100).select("o_orderkey", F.round("scaled", 8).alias("scaled"))


@query("c6_z_score", """
SELECT o_orderkey, ROUND((o_totalprice - m) / sd, 8) + 0.0 AS z FROM orders, (SELECT AVG(o_totalprice) AS m, stddev_pop(o_totalprice) AS sd FROM orders)""")
def _(t):
    return clean.z_score(t.orders, "o_totalprice", "z").select("o_orderkey", (F.round("z", 8) + F.lit(0.0)).alias("z"))


@query("c7_decimal_scale", """
SELECT o_orderkey, o_totalprice / pow(10.0, len(CAST(CAST(floor(m) AS BIGINT) AS STRING))) AS scaled FROM orders, (SELECT MAX(abs(o_totalprice)) AS m FROM orders)""")
def _(t):
    return clean.decimal_scale(t.orders, "o_totalprice", "scaled").select("o_orderkey", "scaled")


CATEGORY_RIGHT = "CASE WHEN salary <= 0 OR salary IS NULL THEN NULL WHEN salary <= 50000 THEN 'Low' WHEN salary <= 100000 THEN 'Medium' WHEN salary <= 150000 THEN 'High' ELSE 'Premium' END"
ETL_SQL = f"""
SELECT id, name, email, phone, experience_years, salary, CASE WHEN experience_years >= 7 THEN 'Senior' WHEN experience_years >= 3 THEN 'Mid' ELSE 'Junior' END AS experience_level,
 {CATEGORY_RIGHT} AS salary_category FROM (
 SELECT DISTINCT id, trim({TITLE_SQL.format('name')}) AS name, trim(lower(COALESCE(NULLIF(email, ''), 'unknown@example.com'))) AS email,
  COALESCE(NULLIF(phone, ''), '000-000-0000') AS phone,
  TRY_CAST(COALESCE(NULLIF(experience_years, ''), '0') AS DOUBLE) AS experience_years, TRY_CAST(salary AS DOUBLE) AS salary FROM {RAW_TWICE_SQL})
WHERE contains(email, '@') AND experience_years >= 0"""


@query("c8_etl", ETL_SQL)
def _(t):
    return clean.etl(raw_twice(t))


ELT_SQL = f"""
SELECT id, UPPER(TRIM(name)) AS name, LOWER(TRIM(email)) AS email, COALESCE(NULLIF(TRIM(phone), ''), '000-000-0000') AS phone, y AS experience_years, s AS salary,
 CASE WHEN y >= 7 THEN 'Senior' WHEN y >= 3 THEN 'Mid' ELSE 'Junior' END AS experience_level,
 CASE WHEN s < 50000 THEN 'Low' WHEN s < 100000 THEN 'Medium' WHEN s < 150000 THEN 'High' ELSE 'Premium' END AS salary_category,
 CASE WHEN LOWER(email) LIKE '%@%' THEN 1 ELSE 0 END AS is_valid_email FROM
 (SELECT *, COALESCE({LEADING_SQL.format('experience_years')}, 0) AS y, COALESCE({LEADING_SQL.format('salary')}, 0) AS s FROM {RAW_TWICE_SQL}) WHERE y >= 0"""


@query("c9_elt", ELT_SQL)
def _(t):
    return clean.elt(raw_twice(t))


@query("c10_compare", f"SELECT 'etl' AS approach, COUNT(*) AS rows FROM ({ETL_SQL}) UNION ALL SELECT 'elt', COUNT(*) FROM ({ELT_SQL})")
def _(t):
    return clean.compare_loads(raw_twice(t))


PEOPLE = """SELECT p_partkey AS id, ' ' || p_name || ' ' AS name, ' P' || CAST(p_partkey AS STRING) || '@Shop.ORG' AS email, p_size AS experience_years,
 p_retailprice AS current_salary, p_retailprice + p_size * 3 AS expected_salary, p_name AS skill_text FROM {part}"""


@query("c11_enrich", f"""
SELECT id, trim({TITLE_SQL.format('name')}) AS name, trim(lower(email)) AS email, CASE WHEN experience_years < 3 THEN 'Junior' WHEN experience_years < 7 THEN 'Mid-level' ELSE 'Senior' END AS experience_level,
 ROUND((expected_salary - current_salary) / current_salary * 100, 2) AS salary_expectation_pct, CAST(len(string_split(skill_text, ' ')) AS INT) AS skill_count, string_split(skill_text, ' ')[1] AS primary_skill
FROM ({PEOPLE.format(part='part')})""")
def _(t):
    people = t.spark.sql(PEOPLE, part=t.part).withColumn("skills", F.split("skill_text", " "))
    return clean.enrich(people).select("id", "name", "email", "experience_level", "salary_expectation_pct", "skill_count", "primary_skill")


@query("c12_chain", f"""
SELECT id, trim({TITLE_SQL.format('name')}) AS name, trim(lower(email)) AS email, phone FROM {RAW_SQL} WHERE NOT {MISSING.format('email')} AND NOT {MISSING.format('phone')}""")
def _(t):
    steps = [lambda d: clean.fill(d, ["email", "phone"], strategy="drop"), clean.standardise]
    return clean.chain(raw(t), steps).select("id", "name", "email", "phone")


@query("c13_type_report", """
SELECT 'p_partkey' AS "column", 'bigint' AS old_type, CASE WHEN MAX(p_partkey) < 128 THEN 'tinyint' WHEN MAX(p_partkey) < 32768 THEN 'smallint' ELSE 'int' END AS new_type FROM part
UNION ALL SELECT 'p_size', 'int', CASE WHEN MAX(p_size) < 128 THEN 'tinyint' ELSE 'smallint' END FROM part
UNION ALL SELECT 'p_retailprice', 'double', 'float'
UNION ALL SELECT 'p_brand', 'string', CASE WHEN COUNT(DISTINCT p_brand) < COUNT(*) * 0.5 THEN 'category' ELSE 'string' END FROM part""")
def _(t):
    return clean.type_report(t.part.select("p_partkey", "p_size", "p_retailprice", "p_brand"))


@query("c14_transform", "SELECT event_id AS id, upper(event_type) AS name, value, CASE WHEN value > 50 THEN 'high' ELSE 'low' END AS category FROM events")
def _(t):
    e = t.events.select(F.col("event_id").alias("id"), F.col("event_type").alias("name"), "value")
    return clean.transform_values(e).drop("processed_at")


@query("c15_enrich_skills", """
WITH e AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS skill FROM part),
 s AS (SELECT skill, COUNT(*) AS uses FROM e GROUP BY 1 HAVING len(skill) > 4) SELECT p_partkey, skill, CAST(uses AS DOUBLE) AS uses FROM e LEFT JOIN s USING (skill)""")
def _(t):
    people = t.part.select("p_partkey", F.replace("p_name", F.lit(" "), F.lit(", ")).alias("skills"))
    skills = people.select(F.explode(fn.split_list(F.col("skills"))).alias("skill")).groupBy("skill") \
        .agg(F.count(F.lit(1)).alias("uses")).filter("length(skill) > 4")
    return clean.enrich_skills(people, skills).select("p_partkey", "skill", F.col("uses").cast("double").alias("uses"))


# --- data quality -----------------------------------------------------------------

@query("q1_completeness", f"SELECT id, NOT {MISSING.format('email')} AS ok FROM {RAW_SQL}")
def _(t):
    return raw(t).select("id", dq.completeness("email").passes.alias("ok"))


# Some rows come twice, and some copies lack the number that orders them.
COPIED_SQL = f"(SELECT id, phone FROM {RAW_SQL} UNION ALL SELECT id, phone FROM {RAW_SQL} WHERE id % 7 <> 3 UNION ALL SELECT NULL, phone || '!' FROM {RAW_SQL} WHERE id % 11 = 0)"


@query("q2_unique", f"SELECT id, phone, row_number() OVER (PARTITION BY phone ORDER BY id NULLS LAST) = 1 AS ok FROM {COPIED_SQL}")
def _(t):
    r = raw(t).select("id", "phone")
    copied = r.unionByName(r.filter("id % 7 <> 3")).unionByName(r.filter("id % 11 = 0").select(
        F.lit(None).cast("long").alias("id"), F.concat("phone", F.lit("!")).alias("phone")))
    return dq.flagged(copied, [dq.unique("phone", "id")]).select("id", "phone", F.col("valid").alias("ok"))


RANGE_SQL = "(experience_years IS NULL OR COALESCE(TRY_CAST(experience_years AS DOUBLE) BETWEEN 0 AND 15, FALSE))"


@query("q3_range", f"SELECT id, {RANGE_SQL} AS ok FROM {RAW_SQL}")
def _(t):
    return raw(t).select("id", dq.in_range("experience_years", 0, 15).passes.alias("ok"))


@query("q4_pattern", f"SELECT id, phone IS NULL OR regexp_matches(phone, '^(?:\\d{{3}}-\\d)') AS ok FROM {RAW_SQL}")
def _(t):
    return raw(t).select("id", dq.matches("phone", r"\d{3}-\d").passes.alias("ok"))


@query("q5_reference", "SELECT l_orderkey, l_linenumber, k IS NULL OR k IN (SELECT p_partkey FROM part WHERE p_size > 10) AS ok FROM (SELECT *, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_partkey END AS k FROM lineitem)")
def _(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") != 7, F.col("l_partkey")).alias("k"))
    rule = dq.in_reference("k", t.part.filter("p_size > 10"), "p_partkey")
    return dq.flagged(lines, [rule]).select("l_orderkey", "l_linenumber", F.col("valid").alias("ok"))


@query("q6_enum", "SELECT o_orderkey, o_orderpriority IN ('1-URGENT', '2-HIGH') AS ok FROM orders")
def _(t):
    return t.orders.select("o_orderkey", dq.one_of("o_orderpriority", ["1-URGENT", "2-HIGH"]).passes.alias("ok"))


@query("q7_type", f"SELECT id, salary IS NULL OR TRY_CAST(salary AS INT) IS NOT NULL AS ok FROM {RAW_SQL}")
def _(t):
    return raw(t).select("id", dq.is_type("salary", "int").passes.alias("ok"))


@query("q8_required", f"SELECT id, NOT ({MISSING.format('email')} OR {MISSING.format('phone')}) AS ok FROM {RAW_SQL}")
def _(t):
    return dq.flagged(raw(t), [dq.completeness("email"), dq.completeness("phone")]).select("id", F.col("valid").alias("ok"))


def candidate_rules():
    return [dq.completeness("email"), dq.in_range("experience_years", 0, 15), dq.matches("phone", r"\d{3}-\d", "warning"),
            dq.unique("email", "id")]


CHECKED_SQL = f"""(SELECT id, NOT {MISSING.format('email')} AS email_complete, {RANGE_SQL} AS experience_years_range,
 phone IS NULL OR regexp_matches(phone, '^(?:\\d{{3}}-\\d)') AS phone_pattern, row_number() OVER (PARTITION BY email ORDER BY id) = 1 AS email_unique FROM {RAW_SQL})"""


@query("q9_validate", f"""
SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE ok) AS passed, COUNT(*) FILTER (WHERE NOT ok) AS failed, ROUND(AVG(CAST(ok AS INT)), 8) AS pass_rate
FROM (SELECT email_complete AND experience_years_range AND email_unique AS ok FROM {CHECKED_SQL})""")
def _(t):
    return dq.validate(raw(t), candidate_rules()).withColumn("pass_rate", F.round("pass_rate", 8))


@query("q10_rule_results", " UNION ALL ".join(
    f"""SELECT '{n}' AS rule, '{c}' AS "column", '{s}' AS severity, COUNT(*) FILTER (WHERE NOT {n}) AS violations,
 (SELECT string_agg(id, ',' ORDER BY id) FROM (SELECT id FROM {CHECKED_SQL} WHERE NOT {n} ORDER BY id LIMIT 5)) AS samples FROM {CHECKED_SQL}"""
    for n, c, s in [("email_complete", "email", "error"), ("experience_years_range", "experience_years", "error"),
                    ("phone_pattern", "phone", "warning"), ("email_unique", "email", "error")]))
def _(t):
    found = dq.rule_results(raw(t), candidate_rules(), "id")
    return found.withColumn("samples", F.array_join(F.transform("samples", lambda k: k.cast("string")), ","))


@query("q11_split_valid", f"""
SELECT id, CASE WHEN failures = '' THEN 'valid' ELSE 'invalid' END AS side, failures FROM (SELECT id, concat_ws(',', CASE WHEN NOT email_complete THEN 'email_complete' END,
 CASE WHEN NOT experience_years_range THEN 'experience_years_range' END, CASE WHEN NOT email_unique THEN 'email_unique' END) AS failures FROM {CHECKED_SQL})""")
def _(t):
    rules = [r for r in candidate_rules() if r.severity == "error"]
    good, bad = dq.split_valid(raw(t), rules)
    return good.select("id", F.lit("valid").alias("side"), F.lit("").alias("failures")).unionByName(
        bad.select("id", F.lit("invalid").alias("side"), F.array_join("failures", ",").alias("failures")))


# Fixed choice of bad rows: some customers lose their name, or ask for too little or too much.
INCOMING = """SELECT CASE WHEN c_custkey % 19 = 0 THEN '' ELSE 'C' || CAST(c_custkey AS STRING) END AS candidate_id, c_name AS full_name,
 CASE WHEN c_custkey % 6 = 0 THEN 'none' ELSE c_name || '@mail.org' END AS email,
 CASE WHEN c_custkey % 9 = 0 THEN 'ten' ELSE CAST(c_custkey % 60 AS STRING) END AS experience_years,
 CAST(c_nationkey * 1000 AS STRING) AS current_salary, CAST(CAST(floor(c_acctbal) AS INT) * 2 AS STRING) AS expected_salary, c_mktsegment AS source FROM {customer}"""
REASON_SQL = """concat_ws('; ', CASE WHEN candidate_id = '' THEN 'Missing candidate_id' END, CASE WHEN NOT (contains(email, '@') AND contains(email, '.')) THEN 'Invalid email format' END,
 CASE WHEN TRY_CAST(experience_years AS INT) IS NULL THEN 'Invalid experience_years' WHEN CAST(experience_years AS INT) > 50 THEN 'Experience years out of range' END,
 CASE WHEN current_salary <> '0' AND expected_salary <> '0' AND CAST(expected_salary AS INT) < CAST(current_salary AS INT) * 0.8 THEN 'Expected salary too low' END)"""
INCOMING_SQL = f"(SELECT *, {REASON_SQL} AS reason FROM ({INCOMING.format(customer='customer')}))"


@query("q12_ingest_reasons", f"SELECT full_name, reason FROM {INCOMING_SQL}")
def _(t):
    return t.spark.sql(INCOMING, customer=t.customer).select("full_name", dq.ingest_reasons().alias("reason"))


@query("q13_ingest_audit", f"""
SELECT source, COUNT(*) AS records_read, COUNT(*) FILTER (WHERE reason = '') AS records_inserted, COUNT(*) FILTER (WHERE reason <> '') AS records_rejected FROM {INCOMING_SQL} GROUP BY 1""")
def _(t):
    _, _, audit = dq.ingest(t.spark.sql(INCOMING, customer=t.customer), "source", ["full_name"])
    return audit


QUARTILES = """WITH v AS (SELECT {c} AS x, row_number() OVER (ORDER BY {c}) AS rn FROM {t}), n AS (SELECT COUNT(*) AS n FROM v),
 p AS (SELECT n, (n + 1) // 4 AS j1, (n + 1) - ((n + 1) // 4) * 4 AS d1, (3 * (n + 1)) // 4 AS j3, 3 * (n + 1) - ((3 * (n + 1)) // 4) * 4 AS d3 FROM n),
 s AS (SELECT AVG({c}) AS mean, stddev_samp({c}) AS std, median({c}) AS median, MIN({c}) AS min, MAX({c}) AS max FROM {t}),
 q AS (SELECT ((SELECT x FROM v WHERE rn = j1) * (4 - d1) + (SELECT x FROM v WHERE rn = j1 + 1) * d1) / 4 AS q1,
  ((SELECT x FROM v WHERE rn = j3) * (4 - d3) + (SELECT x FROM v WHERE rn = j3 + 1) * d3) / 4 AS q3 FROM p)"""


@query("q14_baseline", QUARTILES.format(c="value", t="events") + """
SELECT ROUND(mean, 8) AS mean, ROUND(std, 8) AS std, ROUND(median, 8) AS median, min, max, ROUND(q1, 8) AS q1, ROUND(q3, 8) AS q3 FROM s, q""")
def _(t):
    return dq.baseline(t.events, "value").select(*[F.round(c, 8).alias(c) for c in ("mean", "std", "median")], "min", "max",
                                                 *[F.round(c, 8).alias(c) for c in ("q1", "q3")])


@query("q15_zscore", """
SELECT event_id, ROUND(abs(value - m) / sd, 6) AS score FROM events, (SELECT AVG(value) AS m, stddev_samp(value) AS sd FROM events) WHERE abs(value - m) / sd > 2.5""")
def _(t):
    return dq.zscore_outliers(t.events, "value", 2.5).select("event_id", F.round("score", 6).alias("score"))


@query("q16_iqr", QUARTILES.format(c="value", t="events") + """
SELECT event_id, value FROM events, q WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""")
def _(t):
    return dq.iqr_outliers(t.events, "value").select("event_id", "value")


@query("q17_anomaly_summary", QUARTILES.format(c="value", t="events") + """
SELECT 'zscore' AS method, COUNT(*) AS anomalies FROM events, s WHERE abs(value - mean) / std > 3
UNION ALL SELECT 'iqr', COUNT(*) FROM events, q WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""")
def _(t):
    return dq.anomaly_summary(t.events, "value")


CHECK_SQL = {
    "not_empty": r"len(regexp_replace(text, '^\s+|\s+$', '', 'g')) > 100", "has_contact_info": "contains(text, '@')",
    "has_experience_section": "contains(upper(text), 'EXPERIENCE') OR contains(upper(text), 'WORK')",
    "has_skills_section": "contains(upper(text), 'SKILL')",
    "has_education": "contains(upper(text), 'EDUCATION') OR contains(upper(text), 'DEGREE')",
    "reasonable_length": "len(text) > 200 AND len(text) < 10000",
    "no_excessive_whitespace": "(len(text) - len(replace(text, chr(10) || chr(10) || chr(10), ''))) / 3 < 5",
    "no_suspicious_chars": r"len(regexp_replace(text, '[\x00-\x7F]', '', 'g')) / greatest(len(text), 1) < 0.1",
}


@query("q18_text_quality", f"""
SELECT *, CASE WHEN quality_score >= 70 THEN 'Resume passes quality checks' ELSE 'Resume needs improvement before analysis' END AS recommendation FROM (
 SELECT doc_id, {', '.join(CHECK_SQL)}, CAST({' + '.join(f'CAST({c} AS INT)' for c in CHECK_SQL)} AS INT) AS checks_passed,
  CAST(round_even(({' + '.join(f'CAST({c} AS INT)' for c in CHECK_SQL)}) / 8.0 * 100, 0) AS INT) AS quality_score
 FROM (SELECT doc_id, {', '.join(f'({e}) AS {c}' for c, e in CHECK_SQL.items())} FROM documents))""")
def _(t):
    return dq.text_quality(t.documents.select("doc_id", "text")).drop("text")


@query("q19_quality_report", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", ROUND(AVG(CAST(NOT {MISSING.format(c)} AS INT)) * 100, 6) AS completeness_pct,
 ROUND(COUNT(DISTINCT {c}) / COUNT({c}) * 100, 6) AS uniqueness_pct, ROUND(AVG(CAST({v} AS INT)) * 100, 6) AS validity_pct FROM {RAW_SQL}"""
    for c, v in [("email", "TRUE"), ("phone", "TRUE"), ("experience_years", RANGE_SQL)]))
def _(t):
    report = dq.quality_report(raw(t), ["email", "phone", "experience_years"], [dq.in_range("experience_years", 0, 15)])
    return report.select("column", *[F.round(c, 6).alias(c) for c in ("completeness_pct", "uniqueness_pct", "validity_pct")])


@query("q20_gate", "SELECT event_id, event_type, value FROM events")
def _(t):
    rules = [dq.completeness("event_type"), dq.in_range("value", 0, float("inf"))]
    return dq.gate(t.events.select("event_id", "event_type", "value"), rules)
