"""Document analysis and matching queries over whole texts."""

from pyspark.sql import functions as F


from tableloom.operators import relational as rel, text as tx, warehouse as wh
from tableloom.plans.registry import query
from tableloom.session import stored

# Chosen for the invented prose of the corpus, where technology terms are rare.
CORPUS_TERMS = (
    "the", "of", "and", "to", "in", "that", "for", "on", "was", "with", "be", "by", "are", "this",
    "der", "die", "und", "que", "les", "des", "el", "la", "en", "un", "tion", "heit", "eaux",
)

# A document with the parts a résumé has, added at fixed keys by the same text in both engines.
RESUME = """SELECT doc_id, source, lang, text
 || CASE WHEN doc_id % 4 <> 0 THEN chr(10) || 'Summary of a profile' ELSE '' END
 || CASE WHEN doc_id % 3 = 0 THEN chr(10) || ' EDUCATION: B.Tech and M.E.' || chr(10) || 'CGPA: 8.' || CAST(doc_id % 10 AS STRING) ELSE '' END
 || chr(10) || 'SKILLS' || chr(10) || 'python, sql, javascript' || CASE WHEN doc_id % 5 = 0 THEN ', docker, kubernetes, machine learning, ci/cd, github' ELSE '' END
 || chr(10) || 'Professional Experience: ' || CAST(doc_id % 12 AS STRING) || '+ years, grew sales by ' || CAST(doc_id % 90 AS STRING) || CASE WHEN doc_id % 2 = 0 THEN '%' ELSE ' points' END AS text
FROM {documents}"""
RESUME_SQL = "(" + RESUME.format(documents="documents") + ")"


def resumes(t):
    return t.spark.sql(RESUME, documents=t.documents)


def with_job(t):
    """Each document beside the job text assigned to it by key, an equi-join."""
    jobs = t.benchmark.agg(F.count(F.lit(1))).scalar()
    docs = resumes(t).withColumn("item_id", F.pmod(F.col("doc_id"), jobs))
    return docs.join(t.benchmark.withColumnRenamed("text", "job"), "item_id")


PAIR_SQL = f"(SELECT d.*, b.text AS job FROM {RESUME_SQL} d JOIN benchmark b ON d.doc_id % (SELECT COUNT(*) FROM benchmark) = b.item_id)"


def sql_list(values):
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def terms_sql(terms, text="text"):
    return f"list_filter({sql_list(terms)}, lambda t: contains(lower({text}), t))"


def joined(column, sep="|"):
    return F.array_join(column, sep)


FORMAT_SQL = "CASE WHEN {0} IN ('aws', 'gcp', 'sql', 'nlp', 'etl') THEN upper({0}) WHEN {0} = 'ci/cd' THEN 'CI/CD' ELSE upper(substr({0}, 1, 1)) || lower(substr({0}, 2)) END"


def like_sql(pattern):
    return f"regexp_matches(text, '{pattern}', 'i')"


EDU_SQL = f"""list_filter([CASE WHEN {like_sql(tx.BACHELOR)} THEN 'Bachelor''s Degree' END, CASE WHEN {like_sql(tx.MASTER)} THEN 'Master''s Degree' END,
 CASE WHEN {like_sql(tx.PHD)} THEN 'PhD' END, CASE WHEN {like_sql(tx.GRADES)} AND regexp_extract(text, '{tx.GPA}', 1, 'i') <> '' THEN 'GPA: ' || regexp_extract(text, '{tx.GPA}', 1, 'i') END],
 lambda x: x IS NOT NULL)"""
FEATURES_SQL = f"""(SELECT *, CASE WHEN len(edu) = 0 THEN ['Education details not found'] ELSE edu END AS education,
 CASE WHEN years >= 8 THEN 'Principal/Staff' WHEN years >= 5 THEN 'Senior' WHEN years >= 3 THEN 'Mid-Level' WHEN years >= 1 THEN 'Junior' ELSE 'Entry Level' END AS level
 FROM (SELECT *, {terms_sql(tx.TERMS)} AS terms, COALESCE(TRY_CAST(regexp_extract(text, '{tx.YEARS}', 1, 'i') AS BIGINT), 0) AS years, {EDU_SQL} AS edu,
  {like_sql(tx.SUMMARY)} AS has_summary, {like_sql(tx.METRICS)} AS has_metrics, {like_sql(tx.CERTIFICATES)} AS has_certs, {like_sql(tx.LINKS)} AS has_links FROM {RESUME_SQL}))"""
SCORE_SQL = f"""CAST(least(least(len(terms) * 5, 35) + least(years * 4, 30) + CASE WHEN education[1] <> 'Education details not found' THEN 15 ELSE 6 END
 + {' + '.join(f"CASE WHEN {like_sql(s)} THEN 5 ELSE 0 END" for s in tx.SECTIONS)} + 10, 99) AS INT)"""
SUGGEST_SQL = """list_slice(CASE WHEN len(s) = 0 THEN ['Consider adding a projects section with links'] ELSE s END || ['Tailor your resume keywords to match each job description'], 1, 5)"""
SUGGEST_BASE = """list_filter([CASE WHEN NOT has_summary THEN 'Add a professional summary at the top of your resume' END,
 CASE WHEN NOT has_metrics THEN 'Add quantifiable achievements (e.g. "improved performance by 40%")' END, CASE WHEN NOT has_links THEN 'Include GitHub/LinkedIn profile links' END,
 CASE WHEN NOT has_certs THEN 'Add relevant certifications (AWS, GCP, etc.)' END, CASE WHEN len(terms) < 5 THEN 'Expand your skills section with more technical keywords' END], lambda x: x IS NOT NULL)"""
STRENGTH_BASE = """list_filter([CASE WHEN len(terms) >= 8 THEN 'Strong technical profile with ' || len(terms) || ' identified skills' END,
 CASE WHEN years >= 3 THEN years || '+ years of professional experience' END, CASE WHEN has_metrics THEN 'Good use of quantifiable achievements and metrics' END,
 CASE WHEN has_certs THEN 'Has relevant industry certifications' END, CASE WHEN has_links THEN 'Includes professional online presence' END], lambda x: x IS NOT NULL)"""
STRENGTH_SQL = "CASE WHEN len(st) = 0 THEN ['Resume has clear structure and formatting'] ELSE st END"
EXPERIENCE_SQL = """level || ' professional with ' || CASE WHEN years > 0 THEN years || '+ years of experience' ELSE 'entry-level experience' END || ' and strengths in '
 || CASE WHEN len(terms) > 0 THEN array_to_string(list_slice(terms, 1, 3), ', ') ELSE 'software development' END || '.'"""
SUMMARY_SQL = """'This resume shows a ' || lower(level) || ' profile with ' || len(terms) || ' technical skills identified. '
 || CASE WHEN has_metrics THEN 'It includes measurable achievements and strong impact signals.' ELSE 'It would benefit from measurable achievements and clearer impact statements.' END || ' '
 || CASE WHEN has_certs THEN 'Relevant certifications strengthen the profile.' ELSE 'Adding certifications could improve credibility.' END"""


@query("x1_terms", f"SELECT doc_id, array_to_string({terms_sql(tx.TERMS)}, '|') AS terms, array_to_string({terms_sql(CORPUS_TERMS)}, '|') AS common FROM documents")
def _(t):
    return t.documents.select("doc_id", joined(tx.extract_terms(F.col("text"))).alias("terms"),
                              joined(tx.extract_terms(F.col("text"), CORPUS_TERMS)).alias("common"))


@query("x2_format_term", f"SELECT doc_id, array_to_string(list_transform({terms_sql(tx.TERMS)}, lambda t: {FORMAT_SQL.format('t')}), '|') AS shown FROM {RESUME_SQL}")
def _(t):
    return resumes(t).select("doc_id", joined(F.transform(tx.extract_terms(F.col("text")), tx.format_term)).alias("shown"))


@query("x3_education", f"SELECT doc_id, array_to_string(education, '|') AS education FROM {FEATURES_SQL}")
def _(t):
    return resumes(t).select("doc_id", joined(tx.education(F.col("text"))).alias("education"))


@query("x4_years", f"SELECT doc_id, years FROM {FEATURES_SQL}")
def _(t):
    return resumes(t).select("doc_id", tx.years(F.col("text")).alias("years"))


@query("x5_score", f"SELECT doc_id, {SCORE_SQL} AS score FROM {FEATURES_SQL}")
def _(t):
    return tx.features(resumes(t)).select("doc_id", tx.score(F.col("text")).alias("score"))


@query("x6_signals", f"SELECT doc_id, has_summary, has_metrics, has_certs, has_links FROM {FEATURES_SQL}")
def _(t):
    return resumes(t).select("doc_id", *[c.alias(n) for n, c in tx.signals(F.col("text")).items()])


@query("x7_suggestions", f"SELECT doc_id, array_to_string({SUGGEST_SQL}, '|') AS suggestions FROM (SELECT *, {SUGGEST_BASE} AS s FROM {FEATURES_SQL})")
def _(t):
    return tx.features(resumes(t)).select("doc_id", joined(tx.suggestions()).alias("suggestions"))


@query("x8_strengths", f"SELECT doc_id, array_to_string({STRENGTH_SQL}, '|') AS strengths FROM (SELECT *, {STRENGTH_BASE} AS st FROM {FEATURES_SQL})")
def _(t):
    return tx.features(resumes(t)).select("doc_id", joined(tx.strengths()).alias("strengths"))


@query("x9_summary", f"""
SELECT doc_id, array_to_string(list_transform(list_slice(terms, 1, 8), lambda t: {FORMAT_SQL.format('t')}), '|') AS keywords, {EXPERIENCE_SQL} AS experience, {SUMMARY_SQL} AS summary FROM {FEATURES_SQL}""")
def _(t):
    return tx.features(resumes(t)).select("doc_id", joined(tx.keywords_shown()).alias("keywords"),
                                          tx.experience_text().alias("experience"), tx.summary_text().alias("summary"))


ANALYSIS_SQL = f"""(SELECT doc_id, list_transform(terms, lambda t: {FORMAT_SQL.format('t')}) AS skills, {EXPERIENCE_SQL} AS experience, {SUMMARY_SQL} AS summary,
 {STRENGTH_SQL} AS strengths, {SUGGEST_SQL} AS suggestions, {SCORE_SQL} AS overall_score, years AS experience_years, level AS experience_level
 FROM (SELECT *, {SUGGEST_BASE} AS s, {STRENGTH_BASE} AS st FROM {FEATURES_SQL}))"""


@query("x10_analysis", f"""
SELECT doc_id, array_to_string(skills, '|') AS skills, experience, summary, array_to_string(strengths, '|') AS strengths, array_to_string(suggestions, '|') AS suggestions,
 overall_score, experience_years, experience_level FROM {ANALYSIS_SQL}""")
def _(t):
    a = tx.analyze(resumes(t).select("doc_id", "text")).drop("text")
    return a.withColumns({c: joined(F.col(c)) for c in ("skills", "strengths", "suggestions")})


STOP_SQL = sql_list(tx.STOP_WORDS)
SPLIT_SQL = r"list_filter(regexp_split_to_array(lower({0}), '\s+'), lambda w: w <> '')"
JOB_WORDS_SQL = f"list_distinct(list_filter({SPLIT_SQL.format('job')}, lambda w: len(w) > 2 AND NOT list_contains({STOP_SQL}, w)))"
WORDS_SQL = rf"list_distinct(list_filter(list_transform({SPLIT_SQL}, lambda w: regexp_replace(w, '[^\p{{{{L}}}}\p{{{{N}}}}]', '', 'g')), lambda w: len(w) >= 3 AND NOT list_contains({STOP_SQL}, w)))"


@query("x11_match_score", f"""
SELECT doc_id, CASE WHEN len(jw) = 0 THEN 0 ELSE CAST(least(floor(len(list_filter(jw, lambda w: contains(lt, w))) / len(jw) * 100), 100) AS INT) END AS score
FROM (SELECT doc_id, lower(text) AS lt, {JOB_WORDS_SQL} AS jw FROM {PAIR_SQL})""")
def _(t):
    return with_job(t).select("doc_id", tx.match_score(F.col("text"), F.col("job")).alias("score"))


@query("x12_words", f"SELECT doc_id, CAST(len(w) AS INT) AS n, md5(array_to_string(list_sort(w), ' ')) AS words FROM (SELECT doc_id, {WORDS_SQL.format('text')} AS w FROM documents)")
def _(t):
    d = t.documents.select("doc_id", tx.words(F.col("text")).alias("w"))
    return d.select("doc_id", F.size("w").alias("n"), F.md5(joined(F.array_sort("w"), " ")).alias("words"))


# Every 17th document comes as an empty text.
@query("x13_skill_match", f"""
SELECT doc_id, CASE WHEN doc_id % 17 = 0 THEN '' ELSE array_to_string(list_slice(list_sort(list_filter(jw, lambda w: list_contains(dw, w))), 1, 10), '|') END AS matched,
 CASE WHEN doc_id % 17 = 0 THEN '' ELSE array_to_string(list_slice(list_sort(list_filter(jw, lambda w: NOT list_contains(dw, w))), 1, 10), '|') END AS missing
FROM (SELECT doc_id, {WORDS_SQL.format('text')} AS dw, {WORDS_SQL.format('job')} AS jw FROM {PAIR_SQL})""")
def _(t):
    # Job words are prepared once per job text, before the join.
    jobs = t.benchmark.select("item_id", tx.words(F.col("text")).alias("jw"))
    n = t.benchmark.agg(F.count(F.lit(1))).scalar()
    given = resumes(t).withColumn("text", F.when(F.col("doc_id") % 17 == 0, "").otherwise(F.col("text")))
    docs = given.select("doc_id", F.pmod(F.col("doc_id"), n).alias("item_id"), tx.words(F.col("text")).alias("dw"), (F.col("text") != "").alias("given"))
    matched, missing = tx.skill_match(F.col("dw"), F.col("jw"), given=F.col("given"))
    return docs.join(jobs, "item_id").select("doc_id", joined(matched).alias("matched"), joined(missing).alias("missing"))


@query("x14_overlap", f"""
SELECT doc_id, CAST(CASE WHEN len(b) = 0 THEN 0 ELSE round_even(len(list_filter(b, lambda x: list_contains(a, x))) / len(b) * 100, 0) END AS INT) AS overlap
FROM (SELECT doc_id, {terms_sql(CORPUS_TERMS)} AS a, {terms_sql(CORPUS_TERMS, 'job')} AS b FROM {PAIR_SQL})""")
def _(t):
    have, want = (tx.extract_terms(F.col(c), CORPUS_TERMS) for c in ("text", "job"))
    loud = F.transform(have, lambda s: F.concat(F.lit(" "), F.upper(s)))
    return with_job(t).select("doc_id", tx.overlap(loud, want).alias("overlap"))


@query("x15_sections", f"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM {RESUME_SQL}),
 k AS (SELECT doc_id, i, trim(raw, ' ' || chr(9)) AS line FROM l WHERE trim(raw, ' ' || chr(9)) <> ''),
 h AS (SELECT *, CASE WHEN contains(upper(line), 'EDUCATION') THEN 'education' WHEN contains(upper(line), 'SKILL') THEN 'skills' END AS head FROM k),
 s AS (SELECT *, COALESCE(last_value(head IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING), 'experience') AS sec FROM h)
SELECT doc_id, COALESCE(string_agg(line, '|' ORDER BY i) FILTER (WHERE sec = 'experience' AND head IS NULL), '') AS experience,
 COALESCE(string_agg(line, '|' ORDER BY i) FILTER (WHERE sec = 'education' AND head IS NULL), '') AS education,
 COALESCE(string_agg(line, '|' ORDER BY i) FILTER (WHERE sec = 'skills' AND head IS NULL), '') AS skills FROM s GROUP BY doc_id""")
def _(t):
    return resumes(t).select("doc_id", tx.sections(F.col("text")).alias("s")).select(
        "doc_id", *[joined(F.col(f"s.{c}")).alias(c) for c in ("experience", "education", "skills")])


@query("x16_keywords", """
SELECT doc_id, CAST(len(k) AS INT) AS n, md5(array_to_string(k, ' ')) AS keywords FROM
 (SELECT doc_id, list_sort(list_distinct(list_transform(regexp_extract_all(text, '[A-Za-z0-9+#.]{3,}'), lambda w: lower(w)))) AS k FROM documents)""")
def _(t):
    d = t.documents.select("doc_id", tx.keywords(F.col("text")).alias("k"))
    return d.select("doc_id", F.size("k").alias("n"), F.md5(joined(F.col("k"), " ")).alias("keywords"))


@query("x17_word_count", rf"""
WITH r AS (SELECT unnest({SPLIT_SQL.format('text')}) AS w FROM documents), c AS (SELECT regexp_replace(w, '[^\p{{L}}\p{{N}}]', '', 'g') AS word FROM r),
 n AS (SELECT word, COUNT(*) AS n FROM c WHERE len(word) > 2 GROUP BY 1)
SELECT word, n, (SELECT COUNT(*) FROM r) AS total_words, (SELECT COUNT(*) FROM n) AS unique_words FROM n ORDER BY n DESC, word LIMIT 20""")
def _(t):
    return tx.word_count_report(t.documents)


@query("x18_text_features", r"""
SELECT doc_id, CAST(len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) AS INT) AS word_count,
 CAST(len(string_split(text, chr(10))) - CASE WHEN text LIKE '%' || chr(10) OR text = '' THEN 1 ELSE 0 END AS INT) AS line_count, CAST(len(text) AS INT) AS char_count,
 contains(text, '@') AS has_email, regexp_matches(text, '[0-9]') AS has_phone,
 array_to_string(list_filter(['EXPERIENCE', 'EDUCATION', 'SKILLS', 'SUMMARY', 'CERTIFICATIONS'], lambda h: contains(upper(text), h)), '|') AS sections_found FROM """ + RESUME_SQL)
def _(t):
    d = tx.text_features(resumes(t).select("doc_id", "text")).drop("text")
    return d.withColumn("sections_found", joined(F.col("sections_found")))


@query("x20_top_terms", f"""
SELECT term, COUNT(*) AS frequency FROM (SELECT unnest({terms_sql(tx.TERMS + CORPUS_TERMS)}) AS term FROM {RESUME_SQL}) GROUP BY 1 ORDER BY frequency DESC, term LIMIT 15""")
def _(t):
    return tx.top_terms(resumes(t).select(tx.extract_terms(F.col("text"), tx.TERMS + CORPUS_TERMS).alias("terms")))


REMOTE_SQL = "lang = 'en' AND source <> 'src5'"


@query("x21_prefer_valid", f"""
SELECT doc_id, CASE WHEN {REMOTE_SQL} THEN 'primary' ELSE 'local' END AS source, CASE WHEN {REMOTE_SQL} THEN 'remote ' || doc_id ELSE summary END AS summary,
 array_to_string(skills, '|') AS skills FROM {ANALYSIS_SQL} JOIN (SELECT doc_id, lang, source FROM documents) USING (doc_id)""")
def _(t):
    # Analysed once, as both sides read it.
    local = stored(tx.analyze(resumes(t).select("doc_id", "lang", "source", "text")).select("doc_id", "lang", "source", *tx.REQUIRED), "analysis")
    # The primary results exist for English documents, and those of one source lack a field.
    remote = local.filter("lang = 'en'").withColumns({
        "summary": F.concat(F.lit("remote "), F.col("doc_id")),
        "strengths": F.when(F.col("source") != "src5", F.col("strengths")),
    })
    return tx.prefer_valid(remote, local, "doc_id").select("doc_id", "source", "summary", joined(F.col("skills")).alias("skills"))


@query("j12_cooccurrence", f"""
WITH d AS (SELECT doc_id, unnest({terms_sql(CORPUS_TERMS)}) AS term FROM documents)
SELECT a.term AS item_1, b.term AS item_2, COUNT(*) AS co_occurrences FROM d a JOIN d b ON a.doc_id = b.doc_id AND a.term < b.term GROUP BY 1, 2""")
def _(t):
    return rel.cooccurrence(t.documents.select(tx.extract_terms(F.col("text"), CORPUS_TERMS).alias("terms")), "terms")


@query("g21_prevalence", f"""
WITH f AS (SELECT doc_id, {terms_sql(CORPUS_TERMS)} AS a, {terms_sql(CORPUS_TERMS, 'job')} AS b, len(text) AS n FROM {PAIR_SQL}),
 e AS (SELECT doc_id, n, b, unnest(a) AS term FROM f)
SELECT term, COUNT(*) AS docs, ROUND(CAST(COUNT(*) * 100.0 AS DOUBLE) / (SELECT COUNT(*) FROM f), 2) AS prevalence_pct, ROUND(AVG(n), 1) AS avg_score,
 CAST(SUM(CAST(list_contains(b, term) AS INT)) AS BIGINT) AS times_matched FROM e GROUP BY 1""")
def _(t):
    d = with_job(t).select("doc_id", F.length("text").alias("n"), tx.extract_terms(F.col("text"), CORPUS_TERMS).alias("a"),
                           tx.extract_terms(F.col("job"), CORPUS_TERMS).alias("b"))
    return tx.prevalence(d, "doc_id", "a", "n", "b")


def analysis(t):
    """One analysis row per document with its match against the assigned job."""
    d = with_job(t)
    matched, _ = tx.skill_match(tx.words(F.col("text")), tx.words(F.col("job")))
    return tx.analyze(d.withColumns({"match_score": tx.match_score(F.col("text"), F.col("job")), "matched": matched})).select(
        F.col("doc_id").alias("analysis_id"), "overall_score", "match_score", "experience_years", "experience_level",
        "skills", "matched", "suggestions")


@query("a15_star_store", f"""
WITH a AS (SELECT * FROM {ANALYSIS_SQL}), m AS (SELECT doc_id, list_slice(list_sort(list_filter(jw, lambda w: list_contains(dw, w))), 1, 10) AS matched
  FROM (SELECT doc_id, {WORDS_SQL.format('text')} AS dw, {WORDS_SQL.format('job')} AS jw FROM {PAIR_SQL}))
SELECT 'fact' AS tbl, doc_id AS analysis_id, experience_level AS item, CAST(overall_score AS BIGINT) AS n FROM a
UNION ALL SELECT 'skill', doc_id, s, 0 FROM (SELECT doc_id, unnest(skills) AS s FROM a)
UNION ALL SELECT 'skill', doc_id, s, 1 FROM (SELECT doc_id, unnest(matched) AS s FROM m)
UNION ALL SELECT 'suggestion', doc_id, s, 0 FROM (SELECT doc_id, unnest(suggestions) AS s FROM a)""")
def _(t):
    # Analysed once, as the rows of all tables come from it.
    fact, skills, hints = wh.analysis_star(stored(analysis(t), "analysis"))
    return (
        fact.select(F.lit("fact").alias("tbl"), "analysis_id", F.col("experience_level").alias("item"), F.col("overall_score").cast("long").alias("n"))
        .unionByName(skills.select(F.lit("skill").alias("tbl"), "analysis_id", F.col("skill_name").alias("item"), F.col("is_matched").cast("long").alias("n")))
        .unionByName(hints.select(F.lit("suggestion").alias("tbl"), "analysis_id", F.col("suggestion").alias("item"), F.lit(0).cast("long").alias("n"))))


