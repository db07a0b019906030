"""Cleaning, normalising and typed loading of candidate-like tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableloom.functions import scalar as fn
from tableloom.operators.relational import bucket

# What a missing field becomes.
DEFAULTS = {
    "email": "not_provided@example.com",
    "phone": "000-000-0000",
    "experience_years": "0",
    "skills": "Not specified",
}
OTHER_DEFAULT = "Unknown"


def is_missing(name: str) -> Column:
    """NULL, or text of nothing but white space."""
    return F.col(name).isNull() | (fn.strip(F.col(name).cast("string")) == "")


def fill(df: DataFrame, columns: Sequence[str] | None = None, defaults: dict | None = None, strategy: str = "default") -> DataFrame:
    """Replace missing fields by a default, or drop the rows that have one."""
    columns = list(columns or [f.name for f in df.schema if isinstance(f.dataType, T.StringType)])
    if strategy == "drop":
        return df.filter(~reduce(Column.__or__, [is_missing(c) for c in columns]))
    given = {**DEFAULTS, **(defaults or {})}
    return df.withColumns({
        c: F.when(is_missing(c), F.lit(given.get(c, OTHER_DEFAULT))).otherwise(F.col(c)) for c in columns
    })


def impute_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing numbers become the column's mean; 0 when the column has none."""
    number = {c: F.col(c).cast("string").try_cast("double") for c in columns}
    means = df.agg(F.struct(*[F.coalesce(F.avg(v), F.lit(0.0)).alias(c) for c, v in number.items()])).scalar()
    return df.withColumns({c: F.coalesce(v, means.getField(c)) for c, v in number.items()})


def missing_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of missing cells per column, in one pass."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.count_if(is_missing(c)).alias("missing")) for c in columns])
    return df.agg(cells.alias("r")).select(F.inline("r"))


def min_max(df: DataFrame, column: str, name: str, low: float = 0.0, high: float = 1.0) -> DataFrame:
    """Scale into ``[low, high]``; a constant column becomes ``low``."""
    s = df.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi"))).scalar()
    lo, hi = s.getField("lo"), s.getField("hi")
    scaled = F.lit(low) + F.try_divide(F.col(column) - lo, hi - lo) * (high - low)
    return df.withColumn(name, F.when(hi == lo, F.lit(float(low))).otherwise(scaled))


def z_score(df: DataFrame, column: str, name: str) -> DataFrame:
    """Distance from the mean in population standard deviations; 0 when they are 0."""
    s = df.agg(F.struct(F.avg(column).alias("m"), F.stddev_pop(column).alias("sd"))).scalar()
    value = F.try_divide(F.col(column) - s.getField("m"), s.getField("sd"))
    return df.withColumn(name, F.when(s.getField("sd") == 0, F.lit(0.0)).otherwise(value))


def decimal_scale(df: DataFrame, column: str, name: str) -> DataFrame:
    """Divide by 10 to the number of integer digits of the largest absolute value."""
    top = df.agg(F.max(F.abs(column)).alias("m")).scalar()
    digits = F.length(F.floor(top).cast("string"))
    return df.withColumn(name, F.when(top == 0, F.col(column)).otherwise(F.col(column) / F.pow(F.lit(10.0), digits)))


def standardise(df: DataFrame) -> DataFrame:
    """Lower-case trimmed e-mail, title-case trimmed name."""
    return df.withColumns({"email": F.trim(F.lower("email")), "name": F.trim(fn.title_case(F.col("name")))})


def etl(raw: DataFrame) -> DataFrame:
    """Clean before loading: dedupe, fill, cast, standardise, level, filter, categorise.

    Only fields that are NULL or empty, as a file's empty field is read, are
    filled. Rows without an ``@`` in the e-mail, such as one of blanks, or with a
    bad or negative experience are left out.
    """
    defaults = {**DEFAULTS, "email": "unknown@example.com"}
    filled = raw.distinct().withColumns({
        c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(defaults[c])) for c in ("email", "phone", "experience_years")})
    typed = filled.withColumns({c: fn.to_number(F.col(c)) for c in ("experience_years", "salary")})
    kept = typed.transform(standardise).filter(F.contains("email", F.lit("@")) & (F.col("experience_years") >= 0))
    category = bucket(F.col("salary"), [50000, 100000, 150000], ["Low", "Medium", "High", "Premium"], right=True)
    return kept.withColumns({
        "experience_level": fn.level(F.col("experience_years"), fn.THREE_STEP),
        "salary_category": F.when(F.col("salary") > 0, category),
    })


def elt(raw: DataFrame) -> DataFrame:
    """Clean after loading: bad numbers count as 0 and bad e-mails are flagged, not dropped."""
    years = F.coalesce(fn.leading_number(F.col("experience_years")), F.lit(0.0))
    salary = F.coalesce(fn.leading_number(F.col("salary")), F.lit(0.0))
    return raw.filter(years >= 0).select(
        "id",
        F.upper(F.trim("name")).alias("name"),
        F.lower(F.trim("email")).alias("email"),
        F.coalesce(fn.blank_to_null(F.col("phone")), F.lit(DEFAULTS["phone"])).alias("phone"),
        years.alias("experience_years"),
        salary.alias("salary"),
        fn.level(years, fn.THREE_STEP).alias("experience_level"),
        bucket(salary, [50000, 100000, 150000], ["Low", "Medium", "High", "Premium"]).alias("salary_category"),
        F.when(F.contains(F.lower("email"), F.lit("@")), 1).otherwise(0).alias("is_valid_email"),
    )


def compare_loads(raw: DataFrame) -> DataFrame:
    """Rows each approach keeps."""
    def counted(df: DataFrame, how: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(how).alias("approach"), "rows")
    return counted(etl(raw), "etl").unionByName(counted(elt(raw), "elt"))


def enrich(df: DataFrame) -> DataFrame:
    """Clean names and e-mails, add level, wanted raise in percent, skill count and first skill."""
    return df.transform(standardise).withColumns({
        "experience_level": fn.level(F.col("experience_years"), fn.THREE_STEP_LONG),
        "salary_expectation_pct": fn.percent_change(F.col("expected_salary"), F.col("current_salary")),
        "skill_count": F.size("skills"),
        "primary_skill": F.get("skills", F.lit(0)),
    })


def chain(df: DataFrame, steps: Sequence[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Apply steps in order; the first one that cannot be planned raises and stops the chain."""
    return reduce(DataFrame.transform, steps, df)


_INTS = [(T.ByteType(), 7), (T.ShortType(), 15), (T.IntegerType(), 31)]


def type_report(df: DataFrame) -> DataFrame:
    """Narrowest type that holds each column, and whether few values repeat often."""
    cells = []
    for f in df.schema:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            target = F.lit("bigint")
            for kind, bits in reversed(_INTS):
                fits = (F.min(c) >= -(1 << bits)) & (F.max(c) < (1 << bits))
                target = F.when(fits, F.lit(kind.simpleString())).otherwise(target)
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            target = F.lit("float")
        elif isinstance(f.dataType, T.StringType):
            rare = F.approx_count_distinct(c) < F.count(F.lit(1)) * 0.5
            target = F.when(rare, "category").otherwise("string")
        else:
            target = F.lit(f.dataType.simpleString())
        cells.append(F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("old_type"), target.alias("new_type")))
    return df.agg(F.array(*cells).alias("r")).select(F.inline("r"))


def narrow_types(df: DataFrame) -> DataFrame:
    """Cast numbers to the narrowest type that holds them (one row of statistics is read)."""
    plan = {r["column"]: r["new_type"] for r in type_report(df).collect()}
    return df.select(*[
        F.col(c) if plan[c] in ("category", "string") else F.col(c).cast(plan[c]).alias(c) for c in df.columns
    ])


def transform_values(df: DataFrame, threshold: float = 50) -> DataFrame:
    """Upper-case name, high/low category, processing time."""
    return df.select(
        "id", F.upper("name").alias("name"), "value",
        F.when(F.col("value") > threshold, "high").otherwise("low").alias("category"),
        F.current_timestamp().alias("processed_at"),
    )


def enrich_skills(df: DataFrame, skills: DataFrame, column: str = "skills") -> DataFrame:
    """One row per skill of a comma list, with the skill's attributes where known."""
    each = df.withColumn("skill", F.explode(fn.split_list(F.col(column))))
    return each.join(skills, "skill", "left")
