"""Text analysis on short documents, checked against plain Python."""

import re

import pytest
from pyspark.sql import functions as F

from tableloom import plans
from tableloom.operators import relational as rel, text as tx

TEXT = """Jo Ray
Summary: backend work, 4+ years of JavaScript and SQL on AWS.
EDUCATION
B.Tech, GPA: 8.25
Skills
python, ci/cd, Docker
grew revenue 30%"""
JOB = "Python developer with strong SQL, docker skills and Kubernetes, (remote)"


def one(spark, column, text=TEXT, job=JOB):
    return spark.createDataFrame([(text, job)], "text string, job string").select(column.alias("x")).first()["x"]


def test_terms_are_substrings_in_dictionary_order(spark):
    low = TEXT.lower()
    assert one(spark, tx.extract_terms(F.col("text"))) == [t for t in tx.TERMS if t in low]
    assert "java" in one(spark, tx.extract_terms(F.col("text")))
    assert "java" not in one(spark, tx.extract_terms(F.col("text"), whole_words=True))


def test_education_years_signals(spark):
    assert one(spark, tx.education(F.col("text"))) == ["Bachelor's Degree", "GPA: 8.25"]
    assert one(spark, tx.education(F.col("text")), text="none") == ["Education details not found"]
    assert one(spark, tx.years(F.col("text"))) == 4
    assert one(spark, F.struct(*[c.alias(n) for n, c in tx.signals(F.col("text")).items()])).asDict() == {
        "has_summary": True, "has_metrics": True, "has_certs": True, "has_links": False}


def test_analysis(spark):
    df = spark.createDataFrame([(1, TEXT), (2, "")], "id int, text string")
    a, empty = tx.analyze(df).orderBy("id").collect()
    # python javascript java sql aws docker ci/cd: 7 terms -> 35 at most; 4 years -> 16; degree 15; summary, education, skills 15; base 10
    assert a["skills"] == ["Python", "Javascript", "Java", "SQL", "AWS", "Docker", "CI/CD"]
    assert a["overall_score"] == 35 + 16 + 15 + 15 + 10
    assert a["experience"] == "Mid-Level professional with 4+ years of experience and strengths in python, javascript, java."
    assert a["suggestions"] == ["Include GitHub/LinkedIn profile links", "Tailor your resume keywords to match each job description"]
    assert empty["overall_score"] == 16 and empty["strengths"] == ["Resume has clear structure and formatting"]
    assert len(empty["suggestions"]) == 5


def test_match(spark):
    words = {w for w in JOB.lower().split() if len(w) > 2 and w not in tx.STOP_WORDS}
    hits = sum(w in TEXT.lower() for w in words)
    assert one(spark, tx.match_score(F.col("text"), F.col("job"))) == int(hits / len(words) * 100)
    assert one(spark, tx.match_score(F.col("text"), F.col("job")), job="") == 0

    def cleaned(text):
        tokens = ("".join(c for c in w if c.isalnum()) for w in text.lower().split())
        return {w for w in tokens if len(w) >= 3 and w not in tx.STOP_WORDS}

    assert set(one(spark, tx.words(F.col("text")))) == cleaned(TEXT)
    matched, missing = tx.skill_match(tx.words(F.col("text")), tx.words(F.col("job")))
    assert one(spark, matched) == sorted(cleaned(TEXT) & cleaned(JOB))[:10]
    assert one(spark, missing) == sorted(cleaned(JOB) - cleaned(TEXT))[:10]


def test_overlap(spark):
    a, b = F.array(F.lit(" SQL"), F.lit("go"), F.lit("")), F.array(F.lit("sql"), F.lit("rust"), F.lit(" "))
    assert one(spark, tx.overlap(a, b)) == 50
    assert one(spark, tx.overlap(a, F.array(F.lit(" ")))) == 0


def python_sections(text):
    out, current = {"experience": [], "education": [], "skills": []}, "experience"
    for line in (x.strip() for x in text.splitlines()):
        if not line:
            continue
        if "EDUCATION" in line.upper():
            current = "education"
        elif "SKILL" in line.upper():
            current = "skills"
        else:
            out[current].append(line)
    return out


@pytest.mark.parametrize("text", [
    TEXT, "", "a\n\nb", "skills\nx\neducation\ny\r\nz\nSkill set\nw\x0bv", "Education", "a\x85b c\x1cd\te", " lead  \n\n"])
def test_sections_and_lines(spark, text):
    assert one(spark, tx.sections(F.col("text")), text=text).asDict() == python_sections(text)
    assert one(spark, tx.lines(F.col("text")), text=text) == text.splitlines()


def test_keywords(spark):
    expected = sorted({t.lower() for t in re.findall(r"[A-Za-z0-9+#.]{3,}", TEXT)})
    assert one(spark, tx.keywords(F.col("text"))) == expected


def test_word_count(spark):
    texts = ["The cat, the dog", "a cat! é-té | to", "x y z  cat"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = tx.word_count_report(df, k=2).collect()
    assert [(r["word"], r["n"]) for r in got] == [("cat", 3), ("the", 2)]
    assert got[0]["total_words"] == 13 and got[0]["unique_words"] == 4


def test_text_features(spark):
    df = tx.text_features(spark.createDataFrame([("Skills a@b\nx 7\n",)], "text string")).first()
    assert (df["word_count"], df["line_count"], df["char_count"], df["has_email"], df["has_phone"], df["sections_found"]) == (4, 2, 15, True, True, ["SKILLS"])


def test_prefer_valid(spark):
    schema = "id int, skills array<string>, experience string, summary string, strengths array<string>, suggestions array<string>"
    local = spark.createDataFrame([(i, ["l"], "l", "l", ["l"], ["l"]) for i in (1, 2, 3)], schema)
    remote = spark.createDataFrame([(1, ["r"], "r", "r", ["r"], ["r"]), (2, ["r"], "r", None, ["r"], ["r"])], schema)
    got = {r["id"]: (r["source"], r["summary"], r["skills"]) for r in tx.prefer_valid(remote, local, "id").collect()}
    assert got == {1: ("primary", "r", ["r"]), 2: ("local", "l", ["l"]), 3: ("local", "l", ["l"])}


def test_cooccurrence(spark):
    df = spark.createDataFrame([(["b", "a", "a"],), (["a", "c", "b"],), ([],)], "items array<string>")
    got = {(r[0], r[1]): r[2] for r in rel.cooccurrence(df, "items").collect()}
    assert got == {("a", "b"): 2, ("a", "c"): 1, ("b", "c"): 1}


@pytest.mark.parametrize("name", ["a15_star_store", "x21_prefer_valid"])
def test_documents_are_analysed_once(spark, tmp_path, name):
    text = "Bachelor of science, 4 years of java and sql for the machine learning team"
    docs = [(i, "src5" if i == 3 else "src1", "en" if i < 4 else "de", text if i != 2 else "") for i in range(6)]
    spark.createDataFrame(docs, "doc_id long, source string, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, "java and spark"), (1, "sql")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    df = plans.QUERIES[name](spark, str(tmp_path))
    assert df.inputFiles() and not any("documents.parquet" in f for f in df.inputFiles())
    got = df.collect()
    if name == "x21_prefer_valid":
        assert {r.doc_id: r.source for r in got} == {0: "primary", 1: "primary", 2: "primary", 3: "local", 4: "local", 5: "local"}
        assert all(r.summary == f"remote {r.doc_id}" for r in got if r.source == "primary")
    else:
        assert sorted(r.analysis_id for r in got if r.tbl == "fact") == list(range(6))
        assert {(r.analysis_id, r.item) for r in got if r.tbl == "skill" and r.n == 1} == {(0, "java"), (4, "java"), (1, "sql"), (3, "sql"), (5, "sql")}
