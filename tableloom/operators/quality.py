"""Rule-based data quality, ingest validation and outlier detection.

Rules become boolean columns, so any number of them costs one pass; only
uniqueness and reference rules add a join.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableloom.functions.scalar import strip
from tableloom.operators.clean import is_missing
from tableloom.operators.ordered import join_null_safe

#: Values left in a bracket that are listed rather than narrowed further.
FEW_VALUES = 10_000
#: A sketch's ranks are off by at most one in this many.
SKETCH_ACCURACY = 10_000


@dataclass(frozen=True)
class Rule:
    name: str
    column: str
    passes: Column
    severity: str = "error"
    prepare: Callable[[DataFrame], DataFrame] | None = None


def completeness(column: str, severity: str = "error", name: str | None = None) -> Rule:
    return Rule(name or f"{column}_complete", column, ~is_missing(column), severity)


def in_range(column: str, low: float, high: float, severity: str = "error") -> Rule:
    """Inclusive; NULL passes, text that is no number fails."""
    value = F.col(column).cast("string").try_cast("double")
    return Rule(f"{column}_range", column, F.col(column).isNull() | F.coalesce(value.between(low, high), F.lit(False)), severity)


def matches(column: str, pattern: str, severity: str = "error") -> Rule:
    """Anchored at the start only; NULL passes."""
    return Rule(f"{column}_pattern", column, F.col(column).isNull() | F.col(column).cast("string").rlike(f"^(?:{pattern})"), severity)


def one_of(column: str, values: Sequence, severity: str = "error") -> Rule:
    return Rule(f"{column}_enum", column, F.col(column).isNull() | F.col(column).isin(*values), severity)


def is_type(column: str, kind: str, severity: str = "error") -> Rule:
    """The text can be read as ``kind`` (a Spark type name); NULL passes."""
    return Rule(f"{column}_type", column, F.col(column).isNull() | F.col(column).try_cast(kind).isNotNull(), severity)


def unique(column: str, order: str, severity: str = "error") -> Rule:
    """Every occurrence after the first by ``order`` fails; NULL counts as a value, and rows without an order come last.

    Of rows with the same value and order one passes, the first by a hash of the
    whole row, so exact copies fail but for one.
    """
    first, copy = f"__first_{column}", f"__copy_{column}"
    place = F.struct(F.col(order).isNull(), F.col(order))

    def prepare(df: DataFrame) -> DataFrame:
        copies = Window.partitionBy(column, order).orderBy(F.xxhash64(*df.columns))
        numbered = df.withColumn(copy, F.row_number().over(copies))
        return join_null_safe(numbered, df.groupBy(column).agg(F.min(place).alias(first)), [column])

    return Rule(f"{column}_unique", column, (place == F.col(first)) & (F.col(copy) == 1), severity, prepare)


def in_reference(column: str, reference: DataFrame, ref_column: str, severity: str = "error") -> Rule:
    """The value occurs in the reference table; NULL passes."""
    mark = f"__known_{column}"

    def prepare(df: DataFrame) -> DataFrame:
        known = reference.select(F.col(ref_column).alias("__ref")).distinct().withColumn(mark, F.lit(True))
        return df.join(known, F.col(column) == F.col("__ref"), "left").drop("__ref")

    return Rule(f"{column}_reference", column, F.col(column).isNull() | F.coalesce(F.col(mark), F.lit(False)), severity, prepare)


def flagged(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows with ``failures``, the names of failed rules, and ``valid``."""
    prepared = df
    for rule in rules:
        prepared = rule.prepare(prepared) if rule.prepare else prepared
    passed = {r.name: F.coalesce(r.passes, F.lit(False)) for r in rules}  # what can't be told fails
    failed = F.array_compact(F.array(*[F.when(~passed[r.name], F.lit(r.name)) for r in rules]))
    serious = [passed[r.name] for r in rules if r.severity == "error"]
    valid = F.lit(True)
    for passes in serious:
        valid = valid & passes
    return prepared.select(*df.columns, failed.alias("failures"), valid.alias("valid"))


def validate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Total, passed and failed rows and the pass rate; only ``error`` rules fail a row."""
    return flagged(df, rules).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("valid").alias("passed"),
        F.count_if(~F.col("valid")).alias("failed"),
        F.coalesce(F.avg(F.col("valid").cast("double")), F.lit(0.0)).alias("pass_rate"),
    )


def rule_results(df: DataFrame, rules: Sequence[Rule], key: str, samples: int = 5) -> DataFrame:
    """Violations per rule and the keys of the first few; rules without any are listed too."""
    spark = df.sparkSession
    broken = flagged(df, rules).select(F.explode("failures").alias("rule"), F.col(key).alias("k"))
    counts = broken.groupBy("rule").agg(F.count(F.lit(1)).alias("violations"))
    order = Window.partitionBy("rule").orderBy("k")
    few = (
        broken.withColumn("rn", F.row_number().over(order)).filter(F.col("rn") <= samples)
        .groupBy("rule").agg(F.sort_array(F.collect_list("k")).alias("samples"))
    )
    listed = spark.createDataFrame([(r.name, r.column, r.severity) for r in rules], "rule string, column string, severity string")
    return listed.join(counts, "rule", "left").join(few, "rule", "left").select(
        "rule", "column", "severity", F.coalesce("violations", F.lit(0)).alias("violations"), "samples")


def split_valid(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and the others with the list of rules each one breaks."""
    checked = flagged(df, rules)
    return checked.filter("valid").drop("valid", "failures"), checked.filter(~F.col("valid")).drop("valid")


def ingest_reasons() -> Column:
    """Why a candidate row is refused, joined by ``"; "``; empty when it is not."""
    email = F.coalesce(F.col("email"), F.lit(""))
    years = F.col("experience_years").cast("string")
    whole = years.try_cast("int")
    now, wanted = (F.col(c).cast("string").try_cast("int") for c in ("current_salary", "expected_salary"))
    return F.array_join(F.array_compact(F.array(
        F.when(is_missing("candidate_id"), "Missing candidate_id"),
        F.when(is_missing("full_name"), "Missing full_name"),
        F.when(~(F.contains(email, F.lit("@")) & F.contains(email, F.lit("."))), "Invalid email format"),
        F.when(whole.isNotNull() & ~whole.between(0, 50), "Experience years out of range")
        .when(years.isNotNull() & whole.isNull(), "Invalid experience_years"),
        F.when((now != 0) & (wanted != 0) & (wanted < now * 0.8), "Expected salary too low"),
    )), "; ")


def ingest(df: DataFrame, source: str, order: Sequence[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Accepted rows (last one per candidate), refused rows with reasons, audit per source."""
    checked = df.withColumn("rejection_reason", ingest_reasons())
    good, bad = checked.filter("rejection_reason = ''"), checked.filter("rejection_reason <> ''")
    rest = [c for c in df.columns if c != "candidate_id"]
    accepted = (
        good.groupBy("candidate_id")
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r")).select("candidate_id", "r.*")
    )
    rejected = bad.select(source, F.to_json(F.struct(*df.columns)).alias("record_data"), "rejection_reason")
    audit = checked.groupBy(source).agg(
        F.count(F.lit(1)).alias("records_read"),
        F.count_if(F.col("rejection_reason") == "").alias("records_inserted"),
        F.count_if(F.col("rejection_reason") != "").alias("records_rejected"),
    )
    return accepted, rejected, audit


def order_statistics(df: DataFrame, column: str, ranks: Callable[[int], Sequence[int]]) -> list[float]:
    """The values at the ranks (from 1, ascending, NaN last, NULL not counted) that ``ranks`` names for the number of values.

    Nothing is sorted or shuffled but partial aggregates. Each pass takes a quantile sketch of the
    values inside the brackets of all ranks still open, counts exactly how many values lie
    below and at the last pass's bracket ends, and narrows the brackets by those counts. A rank is settled
    when an end of its bracket holds it, or when at most ``FEW_VALUES`` values are left inside,
    which are then listed. The sketch only proposes ends; every step goes by exact counts, and each
    pass leaves its ends out, so values shared by many rows are settled at once.
    """
    given = df.filter(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("v"))
    real = ~F.isnan("v")
    n, numbers, low, high = given.agg(F.count("v"), F.count_if(real), F.min(F.when(real, F.col("v"))), F.max(F.when(real, F.col("v")))).first()
    wanted = list(ranks(n)) if n else []
    found = {r: math.nan for r in wanted if r > numbers}
    # Per open rank: how many values lie below its bracket, how many inside, and the ends, themselves inside.
    brackets = {r: (0, numbers, low, high) for r in wanted if r <= numbers}
    while brackets:
        inside = {b: F.col("v").between(b[2], b[3]) for b in set(brackets.values())}
        few = {b: F.collect_list(F.when(c, F.col("v"))) for b, c in inside.items() if b[1] <= FEW_VALUES}
        listed = [*few]
        lists = given.agg(*[few[b] for b in listed]).first() if listed else ()
        for b, values in zip(listed, lists):
            values = sorted(values)
            for r in [r for r, x in brackets.items() if x == b]:
                found[r] = values[r - b[0] - 1]
                del brackets[r]
        if brackets:
            brackets = _narrowed(given, brackets, found)
    return [found[r] for r in wanted]


def _narrowed(given: DataFrame, brackets: dict[int, tuple], found: dict[int, float]) -> dict[int, tuple]:
    """Brackets of the ranks that stay open after one sketch and one exact count; settled ones go to ``found``."""
    v, asked = F.col("v"), list(brackets.items())
    margin = 2 / SKETCH_ACCURACY

    def proposed(r: int, b: tuple) -> Column:
        share = (r - b[0]) / b[1]
        return F.percentile_approx(F.when(v.between(b[2], b[3]), v), [max(0.0, share - margin), min(1.0, share + margin)], SKETCH_ACCURACY)

    ends = given.agg(*[proposed(r, b) for r, b in asked]).first()
    counts = []
    for (r, b), (lo, hi) in zip(asked, ends):
        for x, y in ((lo, hi), (b[2], lo), (hi, b[3])):
            strictly = (v > x) & (v < y)
            counts += [F.min(F.when(strictly, v)), F.max(F.when(strictly, v)), F.count_if(strictly)]
        counts += [F.count_if(v < lo), F.count_if(v <= lo), F.count_if(v < hi), F.count_if(v <= hi)]
    told = given.agg(*[c.alias(f"c{i}") for i, c in enumerate(counts)]).first()
    still = {}
    for i, ((r, b), (lo, hi)) in enumerate(zip(asked, ends)):
        row = told[13 * i:13 * i + 13]
        below_lo, upto_lo, below_hi, upto_hi = row[9:]
        sides = [row[0:3], row[3:6], row[6:9]]
        if below_lo < r <= upto_lo:
            found[r] = lo
        elif below_hi < r <= upto_hi:
            found[r] = hi
        elif upto_lo < r <= below_hi:
            still[r] = (upto_lo, sides[0][2], sides[0][0], sides[0][1])
        elif r <= below_lo:
            # The sketch missed: go on between the old end, which may hold the rank itself, and the new one.
            at_old = below_lo - b[0] - sides[1][2]
            if r <= b[0] + at_old:
                found[r] = b[2]
            else:
                still[r] = (b[0] + at_old, sides[1][2], sides[1][0], sides[1][1])
        elif r <= upto_hi + sides[2][2]:
            still[r] = (upto_hi, sides[2][2], sides[2][0], sides[2][1])
        else:
            found[r] = b[3]
    return still


def baseline(df: DataFrame, column: str) -> DataFrame:
    """Mean, sample deviation, median, extremes and exclusive quartiles, all exact.

    Quartile i of n values lies at i(n+1)/4 and is interpolated between its
    two neighbours; see ``order_statistics`` for how they are found.
    """
    size = []

    def places(n: int) -> list[int]:
        size.append(n)
        lower = [max(1, min(i * (n + 1) // 4, n - 1)) for i in (1, 3)]
        return [(n + 1) // 2, n // 2 + 1, *[min(j + k, n) for j in lower for k in (0, 1)]]

    at = order_statistics(df, column, places)
    median = q1 = q3 = None
    if at:
        n = size[0]
        median = (at[0] + at[1]) / 2

        def quartile(i: int, low: float, high: float) -> float:
            delta = i * (n + 1) - max(1, min(i * (n + 1) // 4, n - 1)) * 4
            return (low * (4 - delta) + high * delta) / 4 if n > 1 else low

        q1, q3 = quartile(1, at[2], at[3]), quartile(3, at[4], at[5])
    v = F.col(column).cast("double")
    return df.filter(F.col(column).isNotNull()).agg(
        F.avg(v).alias("mean"), F.when(F.count(v) > 1, F.stddev_samp(v)).when(F.count(v) == 1, 0.0).alias("std"),
        F.lit(median).cast("double").alias("median"), F.min(v).alias("min"), F.max(v).alias("max"),
        F.lit(q1).cast("double").alias("q1"), F.lit(q3).cast("double").alias("q3"))


def zscore_outliers(df: DataFrame, column: str, threshold: float = 3.0) -> DataFrame:
    """Rows more than ``threshold`` sample deviations from the mean; none if there is no spread."""
    s = df.agg(F.struct(F.avg(column).alias("m"), F.stddev_samp(column).alias("sd"))).scalar()
    score = F.try_divide(F.abs(F.col(column) - s.getField("m")), s.getField("sd"))
    return df.withColumn("score", score).filter(F.col("score") > threshold)


def iqr_outliers(df: DataFrame, column: str) -> DataFrame:
    """Rows further than 1.5 quartile ranges outside the quartiles."""
    q = baseline(df, column).select(F.struct("q1", "q3").alias("s")).scalar()
    q1, q3 = q.getField("q1"), q.getField("q3")
    low, high = q1 - (q3 - q1) * 1.5, q3 + (q3 - q1) * 1.5
    return df.withColumns({"lower_bound": low, "upper_bound": high}).filter(
        (F.col(column) < F.col("lower_bound")) | (F.col(column) > F.col("upper_bound")))


def anomaly_summary(df: DataFrame, column: str, threshold: float = 3.0) -> DataFrame:
    def counted(rows: DataFrame, method: str) -> DataFrame:
        return rows.agg(F.count(F.lit(1)).alias("anomalies")).select(F.lit(method).alias("method"), "anomalies")
    return counted(zscore_outliers(df, column, threshold), "zscore").unionByName(counted(iqr_outliers(df, column), "iqr"))


def text_checks(text: Column) -> dict[str, Column]:
    """The eight yes/no checks of a document."""
    upper = F.upper(text)
    has = lambda *words: F.lit(False) if not words else _any_of(upper, words)
    size = F.length(text)
    odd = F.length(F.regexp_replace(text, r"[\x00-\x7F]", ""))
    gaps = (size - F.length(F.replace(text, F.lit("\n\n\n"), F.lit("")))) / 3
    return {
        "not_empty": F.length(strip(text)) > 100,
        "has_contact_info": F.contains(text, F.lit("@")),
        "has_experience_section": has("EXPERIENCE", "WORK"),
        "has_skills_section": has("SKILL"),
        "has_education": has("EDUCATION", "DEGREE"),
        "reasonable_length": (size > 200) & (size < 10000),
        "no_excessive_whitespace": gaps < 5,
        "no_suspicious_chars": odd / F.greatest(size, F.lit(1)) < 0.1,
    }


def _any_of(text: Column, words: Sequence[str]) -> Column:
    found = F.contains(text, F.lit(words[0]))
    for word in words[1:]:
        found = found | F.contains(text, F.lit(word))
    return found


def text_quality(df: DataFrame, text: str = "text") -> DataFrame:
    """The eight checks, how many passed, the score in percent and a verdict at 70."""
    checks = text_checks(F.col(text))
    passed = sum((F.col(c).cast("int") for c in checks), F.lit(0))
    scored = df.withColumns(checks).withColumn("checks_passed", passed)
    return scored.withColumn("quality_score", F.bround(F.col("checks_passed") / len(checks) * 100).cast("int")).withColumn(
        "recommendation",
        F.when(F.col("quality_score") >= 70, "Resume passes quality checks")
        .otherwise("Resume needs improvement before analysis"))


def quality_report(df: DataFrame, columns: Sequence[str], validity: Sequence[Rule] = ()) -> DataFrame:
    """Per column: percent complete, percent distinct of the given values, percent valid."""
    valid = {r.column: r.passes for r in validity}
    rows = F.array(*[
        F.struct(
            F.lit(c).alias("column"),
            (F.avg((~is_missing(c)).cast("double")) * 100).alias("completeness_pct"),
            (F.try_divide(F.count_distinct(c), F.count(c)) * 100).alias("uniqueness_pct"),
            (F.avg(valid.get(c, F.lit(True)).cast("double")) * 100).alias("validity_pct"),
        ) for c in columns
    ])
    return df.agg(rows.alias("r")).select(F.inline("r"))


def gate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The table unchanged, or an error when any row fails a rule; nothing is loaded in part."""
    failed = validate(df, rules).first()["failed"]
    if failed:
        raise ValueError(f"data validation failed for {failed} rows, nothing loaded")
    return df
