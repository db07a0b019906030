"""Rule-based analysis of documents and matching against a job text.

Every operator is a set of column expressions over one row, so a corpus is
read once with no shuffle; only word counts group. Term lists are arguments.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableloom.functions import scalar as fn

# The default dictionary of terms, in reporting order.
TERMS = (
    "python", "javascript", "typescript", "java", "c++", "c#", "go", "rust", "sql",
    "react", "vue", "angular", "node.js", "django", "flask", "fastapi", "spring",
    "aws", "gcp", "azure", "docker", "kubernetes", "terraform", "linux",
    "postgresql", "mongodb", "redis", "mysql", "elasticsearch", "kafka",
    "spark", "hadoop", "airflow", "pandas", "numpy", "scikit-learn", "tensorflow",
    "git", "jenkins", "ci/cd", "rest api", "graphql", "microservices",
    "machine learning", "deep learning", "nlp", "data engineering", "etl",
)
UPPER_TERMS = ("aws", "gcp", "sql", "nlp", "etl")

# Words that never count as a keyword.
STOP_WORDS = (
    "the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for",
    "of", "with", "by", "from", "as", "is", "was", "are", "be", "been",
    "have", "has", "do", "does", "did", "will", "would", "could", "should",
    "your", "our", "we", "you", "they", "them", "that", "this", "these",
    "about", "more", "other", "some", "any", "all", "each", "no", "not",
    "can", "may", "must", "need", "use", "used", "using", "uses", "include",
    "includes", "experience", "years", "knowledge", "proficiency", "strong",
    "preferred", "required", "working", "work", "able", "ability", "skills",
)

# Patterns of the rule-based analysis, matched without regard to case.
BACHELOR, MASTER, PHD = r"b\.?tech|b\.?e\.|bachelor", r"m\.?tech|m\.?e\.|master", r"ph\.?d"
GRADES, GPA = r"gpa|cgpa|percentage", r"(?:gpa|cgpa)[:\s]*(\d+\.?\d*)"
YEARS = r"(\d+)\+?\s*years?"
SECTIONS = ("summary|objective", "experience", "education", "skills")
SUMMARY, METRICS = "summary|objective|profile", r"\d+%|\d+x|\$\d+"
CERTIFICATES, LINKS = "certif|aws|gcp|azure|pmp|scrum", "github|linkedin|portfolio"
HEADINGS = ("EXPERIENCE", "EDUCATION", "SKILLS", "SUMMARY", "CERTIFICATIONS")

# Line ends as Python's splitlines sees them.
LINE_END = r"\r\n|[\n\r\x0B\f\x1C\x1D\x1E\x85\u2028\u2029]"


def _array(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _ci(pattern: str) -> str:
    return f"(?i){pattern}"


def extract_terms(text: Column, terms: Sequence[str] = TERMS, whole_words: bool = False) -> Column:
    """Dictionary terms that occur in the text, in dictionary order.

    Plain substrings by default, so "java" is found inside "javascript".
    """
    if not whole_words:
        return fn.bind(F.lower(text), lambda low: F.filter(_array(terms), lambda term: F.contains(low, term)))
    found = [F.when(F.lower(text).rlike(rf"(?<![\p{{L}}\p{{N}}])\Q{t}\E(?![\p{{L}}\p{{N}}])"), F.lit(t)) for t in terms]
    return F.array_compact(F.array(*found))


def format_term(term: Column) -> Column:
    capital = F.concat(F.upper(F.substring(term, 1, 1)), F.lower(F.substring(term, 2, 1 << 30)))
    return F.when(term.isin(*UPPER_TERMS), F.upper(term)).when(term == "ci/cd", "CI/CD").otherwise(capital)


def education(text: Column) -> Column:
    """Degrees and the GPA mentioned; one default entry when there is nothing."""
    gpa = F.regexp_extract(text, _ci(GPA), 1)
    found = F.array_compact(F.array(
        F.when(text.rlike(_ci(BACHELOR)), "Bachelor's Degree"),
        F.when(text.rlike(_ci(MASTER)), "Master's Degree"),
        F.when(text.rlike(_ci(PHD)), "PhD"),
        F.when(text.rlike(_ci(GRADES)) & (gpa != ""), F.concat(F.lit("GPA: "), gpa)),
    ))
    return fn.bind(found, lambda f: F.when(F.size(f) == 0, F.array(F.lit("Education details not found"))).otherwise(f))


def years(text: Column) -> Column:
    """First "N years"; 0 when there is none. Numbers beyond 18 digits count as the largest one of 18."""
    digits = F.ltrim(F.regexp_extract(text, _ci(YEARS), 1), F.lit("0"))
    return F.when(F.length(digits) > 18, F.lit(10**18 - 1)).otherwise(F.coalesce(digits.try_cast("long"), F.lit(0)))


def signals(text: Column) -> dict[str, Column]:
    return {
        "has_summary": text.rlike(_ci(SUMMARY)),
        "has_metrics": text.rlike(_ci(METRICS)),
        "has_certs": text.rlike(_ci(CERTIFICATES)),
        "has_links": text.rlike(_ci(LINKS)),
    }


def features(df: DataFrame, text: str = "text", terms: Sequence[str] = TERMS) -> DataFrame:
    """The columns every later step reads: terms, years, level, education, signals."""
    t = F.col(text)
    return df.withColumns({
        "terms": extract_terms(t, terms), "years": years(t), "education": education(t), **signals(t),
    }).withColumn("level", fn.level(F.col("years")))


def score(text: Column) -> Column:
    """Overall score of a row of :func:`features`, at most 99."""
    studied = F.get("education", F.lit(0)) != "Education details not found"
    sections = sum((F.when(text.rlike(_ci(s)), 5).otherwise(0) for s in SECTIONS), F.lit(0))
    total = (
        F.least(F.size("terms") * 5, F.lit(35)) + F.least(F.col("years") * 4, F.lit(30))
        + F.when(studied, 15).otherwise(6) + sections + 10
    )
    return F.least(total, F.lit(99)).cast("int")


def suggestions() -> Column:
    """Up to five suggestions for a row of :func:`features`, in fixed order."""
    first = F.array_compact(F.array(
        F.when(~F.col("has_summary"), "Add a professional summary at the top of your resume"),
        F.when(~F.col("has_metrics"), 'Add quantifiable achievements (e.g. "improved performance by 40%")'),
        F.when(~F.col("has_links"), "Include GitHub/LinkedIn profile links"),
        F.when(~F.col("has_certs"), "Add relevant certifications (AWS, GCP, etc.)"),
        F.when(F.size("terms") < 5, "Expand your skills section with more technical keywords"),
    ))
    some = F.when(F.size(first) == 0, _array(["Consider adding a projects section with links"])).otherwise(first)
    return F.slice(F.concat(some, _array(["Tailor your resume keywords to match each job description"])), 1, 5)


def strengths() -> Column:
    found = F.array_compact(F.array(
        F.when(F.size("terms") >= 8, F.format_string("Strong technical profile with %d identified skills", F.size("terms"))),
        F.when(F.col("years") >= 3, F.format_string("%d+ years of professional experience", F.col("years"))),
        F.when(F.col("has_metrics"), "Good use of quantifiable achievements and metrics"),
        F.when(F.col("has_certs"), "Has relevant industry certifications"),
        F.when(F.col("has_links"), "Includes professional online presence"),
    ))
    return F.when(F.size(found) == 0, _array(["Resume has clear structure and formatting"])).otherwise(found)


def keywords_shown() -> Column:
    return F.transform(F.slice("terms", 1, 8), format_term)


def experience_text() -> Column:
    top = F.when(F.size("terms") > 0, F.array_join(F.slice("terms", 1, 3), ", ")).otherwise("software development")
    span = F.when(F.col("years") > 0, F.format_string("%d+ years of experience", F.col("years"))).otherwise("entry-level experience")
    return F.concat(F.col("level"), F.lit(" professional with "), span, F.lit(" and strengths in "), top, F.lit("."))


def summary_text() -> Column:
    metrics = F.when(F.col("has_metrics"), "It includes measurable achievements and strong impact signals.").otherwise(
        "It would benefit from measurable achievements and clearer impact statements.")
    certs = F.when(F.col("has_certs"), "Relevant certifications strengthen the profile.").otherwise(
        "Adding certifications could improve credibility.")
    head = F.format_string(
        "This resume shows a %s profile with %d technical skills identified.", F.lower("level"), F.size("terms"))
    return F.concat_ws(" ", head, metrics, certs)


def analyze(df: DataFrame, text: str = "text", terms: Sequence[str] = TERMS) -> DataFrame:
    """The full record per document; the input columns are kept."""
    return features(df, text, terms).select(
        *df.columns,
        F.transform("terms", format_term).alias("skills"),
        experience_text().alias("experience"),
        summary_text().alias("summary"),
        strengths().alias("strengths"),
        suggestions().alias("suggestions"),
        score(F.col(text)).alias("overall_score"),
        F.col("years").alias("experience_years"),
        F.col("level").alias("experience_level"),
    )


def match_score(text: Column, job: Column) -> Column:
    """Share of the job's distinct words found as substrings of the text, in whole percent.

    Words keep their punctuation; words of two letters or fewer and stop words are left out.
    """
    wanted = F.array_distinct(F.filter(
        fn.whitespace_words(F.lower(job)), lambda w: (F.length(w) > 2) & ~w.isin(*STOP_WORDS)))
    found = fn.bind(
        F.struct(F.lower(text).alias("low"), wanted.alias("wanted")),
        lambda b: F.struct(F.size(F.filter(b["wanted"], lambda w: F.contains(b["low"], w))).alias("hits"), F.size(b["wanted"]).alias("of")))
    scored = fn.bind(found, lambda f: fn.capped_percent(f["hits"], f["of"]))
    return F.when((F.coalesce(text, F.lit("")) == "") | (F.coalesce(job, F.lit("")) == ""), 0).otherwise(scored)


def words(text: Column) -> Column:
    """Distinct cleaned words of three letters or more that are no stop words."""
    # White space stays, so cleaning the whole text at once cleans each word.
    cleaned = F.regexp_replace(F.lower(text), rf"[^\p{{L}}\p{{N}}{fn.WHITE}]", "")
    kept = F.filter(F.split(cleaned, f"[{fn.WHITE}]+"), lambda w: (F.length(w) >= 3) & ~w.isin(*STOP_WORDS))
    return F.array_distinct(kept)


def skill_match(text_words: Column, job_words: Column, k: int = 10, given: Column | None = None) -> tuple[Column, Column]:
    """Words of the job that the text has and lacks, sorted, the first ``k`` of each.

    Both are empty where ``given`` is not true: without a text and a job there is nothing to compare.
    """
    found = (F.array_intersect(text_words, job_words), F.array_except(job_words, text_words))
    shown = tuple(F.slice(F.array_sort(f), 1, k) for f in found)
    if given is None:
        return shown
    return tuple(F.when(given, s).otherwise(F.array().cast("array<string>")) for s in shown)


def overlap(a: Column, b: Column) -> Column:
    """Percent of ``b``'s items found in ``a``, trimmed and lower-cased, half to even; 0 if ``b`` is empty."""
    def tidy(items: Column) -> Column:
        low = F.transform(items, lambda s: F.lower(F.trim(s)))
        return F.array_distinct(F.filter(low, lambda s: s.isNotNull() & (s != "")))

    have, want = tidy(a), tidy(b)
    share = F.try_divide(F.size(F.array_intersect(have, want)), F.size(want)) * 100
    return F.coalesce(F.bround(share), F.lit(0.0)).cast("int")


def lines(text: Column) -> Column:
    """Lines of a text, as Python's ``splitlines``: no empty line after a last line end."""
    def without_last(parts: Column) -> Column:
        return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)

    return fn.bind(F.split(text, LINE_END, -1), without_last)


def sections(text: Column) -> Column:
    """Map-like struct of the lines under experience, education and skills headings.

    A line with EDUCATION or SKILL is a heading and starts its section; lines
    before any heading belong to experience. The heading positions are found
    first and each one owns the slice up to the next, so a document is walked
    once however long it is.
    """
    def kind(line: Column) -> Column:
        upper = F.upper(line)
        return F.when(F.contains(upper, F.lit("EDUCATION")), "education").when(F.contains(upper, F.lit("SKILL")), "skills")

    def owned(b: Column, section: str) -> Column:
        def body(head: Column, i: Column) -> Column:
            end = F.coalesce(F.get(b["heads"], i + 1)["at"], F.size(b["kept"]))
            return F.when(head["kind"] == section, F.slice(b["kept"], head["at"] + 2, end - head["at"] - 1)) \
                .otherwise(F.array().cast("array<string>"))
        return F.flatten(F.transform(b["heads"], body)).alias(section)

    def with_heads(kept: Column) -> Column:
        marked = F.transform(kept, lambda s, i: F.struct(kind(s).alias("kind"), i.alias("at")))
        start = F.array(F.struct(F.lit("experience").alias("kind"), F.lit(-1).alias("at")))
        heads = F.concat(start, F.filter(marked, lambda m: m["kind"].isNotNull()))
        return F.struct(kept.alias("kept"), heads.alias("heads"))

    kept = F.filter(F.transform(lines(text), fn.strip), lambda s: s != "")
    return fn.bind(fn.bind(kept, with_heads), lambda b: F.struct(*[owned(b, s) for s in ("experience", "education", "skills")]))


def keywords(text: Column) -> Column:
    """Distinct lower-case tokens of ``[A-Za-z0-9+#.]`` with three characters or more, sorted."""
    tokens = F.regexp_extract_all(text, F.lit(r"([A-Za-z0-9+#.]{3,})"), 1)
    return F.array_sort(F.array_distinct(F.transform(tokens, F.lower)))


def word_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """How often each cleaned word occurs, with its length; short and empty ones included.

    Raw words are counted first, so cleaning runs once per different word.
    """
    raw = df.select(F.explode(fn.whitespace_words(F.lower(text))).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("c"))
    word = fn.clean_word(F.col("w"))
    return raw.groupBy(word.alias("word")).agg(F.sum("c").alias("n"), F.max(F.length(word)).alias("len"))


def word_count_report(df: DataFrame, text: str = "text", k: int = 20, longer_than: int = 2) -> DataFrame:
    """The ``k`` most frequent words beside the totals of words and of different words.

    The length test reads an aggregate, so it stays above the shuffle and the
    totals reuse the counts instead of making them again.
    """
    counts = word_counts(df, text)
    long = F.col("len") > longer_than
    totals = counts.agg(F.struct(F.sum("n").alias("all"), F.count_if(long).alias("different"))).scalar()
    return counts.filter(long).orderBy(F.desc("n"), "word").limit(k).select(
        "word", "n", totals.getField("all").alias("total_words"), totals.getField("different").alias("unique_words"))


def text_features(df: DataFrame, text: str = "text") -> DataFrame:
    t = F.col(text)
    return df.withColumns({
        "word_count": F.size(fn.whitespace_words(t)),
        "line_count": F.size(lines(t)),
        "char_count": F.length(t),
        "has_email": F.contains(t, F.lit("@")),
        "has_phone": t.rlike(r"\p{Nd}"),
        "sections_found": fn.bind(F.upper(t), lambda upper: F.filter(_array(HEADINGS), lambda h: F.contains(upper, h))),
    })


def top_terms(df: DataFrame, terms: str = "terms", k: int = 15) -> DataFrame:
    each = df.select(F.explode(terms).alias("term"))
    return each.groupBy("term").agg(F.count(F.lit(1)).alias("frequency")).orderBy(F.desc("frequency"), "term").limit(k)


def prevalence(df: DataFrame, key: str, terms: str, value: str, matched: str, k: int | None = None) -> DataFrame:
    """Per term: documents with it, percent of all, mean score, how often it was also asked for."""
    total = df.agg(F.count(F.lit(1))).scalar()
    each = df.select(key, value, matched, F.explode(F.array_distinct(terms)).alias("term"))
    table = each.groupBy("term").agg(
        F.count(F.lit(1)).alias("docs"),
        F.round(F.count(F.lit(1)) * 100.0 / F.first(total), 2).alias("prevalence_pct"),
        F.round(F.avg(value), 1).alias("avg_score"),
        F.sum(F.array_contains(F.col(matched), F.col("term")).cast("int")).alias("times_matched"),
    )
    return table if k is None else table.orderBy(F.desc("docs"), "term").limit(k)


REQUIRED = ("skills", "experience", "summary", "strengths", "suggestions")


def prefer_valid(primary: DataFrame, fallback: DataFrame, key: str) -> DataFrame:
    """The primary record where all five fields are there, otherwise the fallback one."""
    first = primary.select(key, F.struct(*REQUIRED).alias("__first"))
    good = F.lit(True)
    for field in REQUIRED:
        good = good & F.col(f"__first.{field}").isNotNull()
    both = fallback.join(first, key, "left").withColumn("__good", F.coalesce(good, F.lit(False)))
    return both.select(
        key, F.when(F.col("__good"), "primary").otherwise("local").alias("source"),
        *[F.when(F.col("__good"), F.col(f"__first.{c}")).otherwise(F.col(c)).alias(c) for c in REQUIRED])
