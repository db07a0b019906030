"""Scalar expressions and small row helpers with exactly defined edge cases."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Characters that Python's str.split treats as white space.
WHITE = r"\s\x1C-\x1F\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row.

    An expression used inside a lambda is otherwise evaluated again for every
    array element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def keep_first(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """One row per key: the one with the smallest ``order`` value.

    An aggregate with map-side combining, so copies of one key collapse
    before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    kept = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(order)).alias("__row"))
    return kept.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest]).select(*df.columns)


def title_case(text: Column) -> Column:
    """Capital after every non-letter, small letters elsewhere (``O'Brien-Smith``)."""
    letters = F.regexp_extract_all(text, F.lit(r"(\p{L}+|\P{L}+)"), 1)
    return F.array_join(F.transform(letters, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 30)))), "")


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def to_number(text: Column) -> Column:
    """Number or NULL, never an error."""
    return text.try_cast("double")


def leading_number(text: Column) -> Column:
    """Leading number of a text, 0 when there is none; NULL stays NULL."""
    digits = F.regexp_extract(text, r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)", 1)
    return F.when(text.isNull(), F.lit(None)).when(digits == "", F.lit(0.0)).otherwise(digits.try_cast("double"))


def capped_percent(part: Column, whole: Column) -> Column:
    """``part / whole`` in percent, cut to an integer and capped at 100; 0 for an empty whole."""
    share = F.floor(F.try_divide(part, whole) * 100)
    return F.coalesce(F.least(share, F.lit(100)), F.lit(0)).cast("int")


def percent_change(now: Column, then: Column, places: int = 2) -> Column:
    return F.round(F.try_divide(now - then, then) * 100, places)


def half_even(value: Column, places: int = 0) -> Column:
    return F.bround(value, places)


def split_list(text: Column, sep: str = ",") -> Column:
    """Trimmed, non-blank parts of a delimited text."""
    return F.filter(F.transform(F.split(text, sep, -1), lambda s: F.trim(s)), lambda s: s != "")


def fingerprint(columns: Sequence[str]) -> Column:
    """MD5 of the row's JSON with columns in name order."""
    return F.md5(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}))


def md5_partition(key: Column, n: int) -> Column:
    """``int(md5(key), 16) mod n``, taken over the digest in 15-digit pieces."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    pieces = [(1, 15), (16, 15), (31, 2)]
    rest = F.lit(0).cast("long")
    for start, width in pieces:
        value = F.conv(F.substring(digest, start, width), 16, 10).cast("long")
        rest = (rest * F.lit(pow(16, width, n)) + value) % F.lit(n)
    return rest.cast("int")


def clean_word(word: Column) -> Column:
    return F.regexp_replace(word, r"[^\p{L}\p{N}]", "")


def strip(text: Column) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(text, f"^[{WHITE}]+|[{WHITE}]+$", "")


def whitespace_words(text: Column) -> Column:
    """Parts between runs of white space; empty ones dropped."""
    return F.filter(F.split(text, f"[{WHITE}]+"), lambda w: w != "")


def json_object_text(text: Column) -> Column:
    """Outermost ``{...}`` of a reply, after code fences are removed."""
    bare = F.trim(F.replace(F.replace(F.trim(text), F.lit("```json"), F.lit("")), F.lit("```"), F.lit("")))
    found = F.regexp_extract(bare, r"(?s)\{.*\}", 0)
    return F.when(found == "", bare).otherwise(found)


def ladder(value: Column, steps: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """First label whose threshold the value reaches, thresholds falling."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for floor, label in steps:
        out = out.when(value >= floor, label)
    return out.otherwise(otherwise)


# The three experience scales, (years from, label), then the label below them.
FIVE_STEP = ([(8, "Principal/Staff"), (5, "Senior"), (3, "Mid-Level"), (1, "Junior")], "Entry Level")
THREE_STEP = ([(7, "Senior"), (3, "Mid")], "Junior")
THREE_STEP_LONG = ([(7, "Senior"), (3, "Mid-level")], "Junior")


def level(years: Column, scale=FIVE_STEP) -> Column:
    return ladder(years, *scale)


def composite_score(salary: Column, years: Column, skills: Column) -> Column:
    """Fixed weights: half the salary, 5000 per year, 10000 per skill."""
    return salary * 0.5 + years * 5000 + skills * 10000


def date_parts(day: str) -> list[Column]:
    """Calendar attributes of a date column, weekday counted from Monday = 0."""
    d = F.col(day)
    return [
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        d.cast("string").alias("full_date"),
        F.weekday(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_of_year"),
        F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        (F.weekday(d) >= 5).alias("is_weekend"),
    ]
