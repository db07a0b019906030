"""Registered queries of the subpackage: thin views of its operators on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableloom.llm import collocations, decontam, language, licenses, neardup, neighbours, packing, pages, pii, quality, secrets, spelling, tokenfiles
from tableloom.llm.common import bounded_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(fn: Callable[[Callable[[str], DataFrame]], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            bounded_batches(spark)
            return fn(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


@_query("op1_language")
def op1_language(table):
    docs = table("documents")
    models = language.learned(docs, "doc_id", "text", "lang")
    found = language.with_language(docs.select("doc_id", "text"), models, "text", "found")
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), F.col("found.lang").alias("lang_pred"),
                        F.col("found.score").alias("score"), F.col("found.bits").alias("bits"))


def _spans_sql(kind: str, rank: int, pattern: str, where: str = "true") -> str:
    """Rows (doc_id, kind, rank, s, e) of a pattern's leftmost matches; ``where`` sees the match m and t, the text from it on."""
    quoted = pattern.replace("'", "''")
    return rf"""SELECT doc_id, '{kind}' AS kind, {rank} AS rank, e - len(m) AS s, e FROM (
        SELECT doc_id, m[i] AS m, CAST(list_sum(list_transform(gaps[1:i], lambda x: len(x))) + list_sum(list_transform(m[1:i], lambda x: len(x))) AS BIGINT) AS e
        FROM (SELECT doc_id, m, gaps, unnest(range(1, len(m) + 1)) AS i
              FROM (SELECT doc_id, regexp_extract_all(text, '{quoted}') AS m, string_split_regex(text, '{quoted}') AS gaps FROM d))) WHERE {where}"""


def _digest_sql(base: int) -> str:
    """Per document: hash of its base spans and list of all spans, from ``found``."""
    one = "kind || ':' || s || ':' || e"
    return f"""SELECT d.doc_id, sha256(coalesce(string_agg({one}, ',' ORDER BY s, rank) FILTER (rank < {base}), '')) AS base_sha256,
        coalesce(string_agg({one}, ',' ORDER BY s, rank) FILTER (rank IS NOT NULL), '') AS spans,
        %s FROM (SELECT doc_id FROM d) d LEFT JOIN found USING (doc_id) GROUP BY d.doc_id"""


def _secrets_sql() -> str:
    parts = []
    for i, rule in enumerate(secrets.RULES):
        held = "m" if not rule.group else f"regexp_extract(m, '{rule.pattern.replace(chr(39), chr(39) * 2)}', {rule.group})"
        parts.append(_spans_sql(rule.kind, i, rule.pattern, f"len({held}) >= {rule.least}"))
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in secrets.BASE)
    return ("WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), found AS (" + " UNION ALL ".join(parts) + ") "
            + _digest_sql(len(secrets.BASE)) % counts)


@_query("op2_secrets", _secrets_sql())
def op2_secrets(table):
    found = secrets.scanned(table("documents"), "doc_id", "text")
    base = F.concat(*[F.col(r.kind) for r in secrets.BASE])
    every = F.concat(*[F.col(r.kind) for r in secrets.RULES])
    return found.select("doc_id", *[F.size(r.kind).cast("long").alias(f"n_{r.kind}") for r in secrets.BASE],
                        F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed(every).alias("spans"))


def _licenses_sql() -> str:
    words = "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    phrases = ", ".join(f"('{label}', '{p}', {len(p.split())})" for p, label in licenses.PHRASES.items())
    templates = ", ".join(f"({i}, '{label}', list_distinct(string_split('{t}', ' ')), {o}, {licenses.span(t)})"
                          for (i, label, _, o), (_, t) in zip(licenses._sets(), licenses.TEMPLATES))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {words.format("coalesce(text, '')")} AS w FROM documents),
phrases(label, p, k) AS (VALUES {phrases}), templates(t, label, w, o, s) AS (VALUES {templates}),
places AS (SELECT doc_id, label, i - 1 AS i FROM (SELECT doc_id, w, label, p, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, phrases WHERE len(w) >= k)
           WHERE w[i] = string_split(p, ' ')[1] AND array_to_string(w[i:i + k - 1], ' ') = p),
base AS (SELECT doc_id, count(*) AS n, min(i) AS a, max(i) AS b FROM places GROUP BY doc_id),
cut AS (SELECT doc_id, s, list_distinct(w[k * s + 1: k * s + 2 * s]) AS w
        FROM (SELECT doc_id, w, s, unnest(range(0, greatest(CAST(ceil((len(w) - 2 * s) / s) AS INT), 0) + 1)) AS k FROM d, (SELECT DISTINCT s FROM templates))),
held AS (SELECT doc_id, label, len(list_intersect(c.w, t.w)) / len(t.w) AS share FROM cut c JOIN templates t ON c.s = t.s AND len(list_intersect(c.w, t.w)) >= t.o),
labels AS (SELECT DISTINCT doc_id, label FROM places UNION SELECT DISTINCT doc_id, label FROM held)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(base.n, 0) AS n_base, base.a AS first_word, base.b AS last_word,
       coalesce((SELECT string_agg(label, ',' ORDER BY label) FROM (SELECT DISTINCT label FROM places p WHERE p.doc_id = d.doc_id)), '') AS base_labels,
       coalesce((SELECT string_agg(label, ',' ORDER BY label) FROM labels l WHERE l.doc_id = d.doc_id), '') AS labels,
       CASE WHEN base.n > 0 THEN 1.0 ELSE coalesce((SELECT max(share) FROM held h WHERE h.doc_id = d.doc_id), 0.0) END AS score
FROM d LEFT JOIN base USING (doc_id)"""


@_query("op3_licenses", _licenses_sql())
def op3_licenses(table):
    found = licenses.labelled(table("documents"), "doc_id", "text")
    return found.withColumns({c: F.concat_ws(",", c) for c in ("base_labels", "labels")})


@_query("op4_quality")
def op4_quality(table):
    rows = quality.judged(table("documents"), "doc_id", "text", "lang", "source")
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


_SHINGLES = r"""
    SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')))
                        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
    FROM (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x20\x09-\x0D]+') AS w FROM documents)"""


@_query("op5_pages")
def op5_pages(table):
    found = pages.extracted(table("pages"), "page_id", "url", "html")
    return found.withColumn("n_chars", F.length("text").cast("long"))


@_query("op6_near_duplicates", rf"""
WITH RECURSIVE sets AS ({_SHINGLES}),
classes AS (SELECT min(doc_id) AS id, s, len(s) AS n FROM (SELECT doc_id, list_sort(s) AS s FROM sets) WHERE len(s) > 0 GROUP BY s),
tokens AS (SELECT id, n, unnest(s) AS t FROM classes),
linked AS (
    SELECT a.id AS x, b.id AS y FROM tokens a JOIN tokens b ON a.t = b.t AND a.id < b.id
    AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n) GROUP BY a.id, b.id, a.n, b.n
    HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
edges AS (SELECT x, y FROM linked UNION SELECT y, x FROM linked),
reach AS (SELECT id AS x, id AS y FROM classes UNION SELECT r.x, e.y FROM reach r JOIN edges e ON r.y = e.x),
roots AS (SELECT x AS id, min(y) AS root FROM reach GROUP BY x)
SELECT d.doc_id, len(d.s) AS n_shingles, coalesce(r.root, d.doc_id) AS component_id, coalesce(r.root, d.doc_id) = d.doc_id AS kept
FROM sets d LEFT JOIN classes c ON list_sort(d.s) = c.s LEFT JOIN roots r ON r.id = c.id""")
def op6_near_duplicates(table):
    return neardup.groups(table("documents"), "doc_id", "text", neardup.TIGHT)


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file, which is part of every machine's image."""
    import public_tokenizers

    return public_tokenizers.path(name)


@_query("op7_packing")
def op7_packing(table):
    # The checksums are of the stored ids; only they go on to the placement.
    cut = packing.pieces(table("documents"), "doc_id", "text", vocabulary("word_bpe_49k.json"), end=1)
    narrow = cut.select("piece", "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return packing.packed(narrow).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@_query("op8_personal_data")
def op8_personal_data(table):
    docs = table("documents")
    tagger = pii.train(pii.training_sample(docs, "doc_id", "text"))
    found = docs.select("doc_id", pii.spans(F.col("text"), tagger).alias("s"))
    base = F.filter("s", lambda x: x["base"])
    of = lambda kind: F.size(F.filter("s", lambda x: x["base"] & (x["kind"] == kind))).cast("long")
    return found.select("doc_id", *[of(k).alias(f"n_{k}") for k in pii.KINDS], F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed(F.col("s")).alias("spans"))


@_query("op9_token_files")
def op9_token_files(table):
    segments = tokenfiles.write(table("documents"), "doc_id", "text", vocabulary("byte_bpe_50k.json"), end=0)
    return tokenfiles.read(segments).select(F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


@_query("op10_decontaminate", rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents), b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
sizes AS (SELECT DISTINCT least(len(w), 10) AS k FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
grams AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
          FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k)),
found AS (SELECT DISTINCT doc_id, i, k, item_id FROM grams JOIN windows USING (g)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(x, ',' ORDER BY x) AS s
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
       sha256(coalesce(items.s, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""")
def op10_decontaminate(table):
    found = decontam.matches(table("documents"), "doc_id", "text", table("benchmark"), "item_id", "text")
    named = F.concat_ws(",", F.array_sort(F.transform("items", lambda x: x.cast("string"))))
    return found.select(F.col("key").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(named, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@_query("op11_neighbours")
def op11_neighbours(table):
    return neighbours.nearest(table("embeddings"), "vec_id", "embedding", F.col("vec_id") % 100 == 0)


def _spelling_sql() -> str:
    """The checksum is linear: each byte adds a value that depends on its distance from the end, found by rule."""
    one = "xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END)"
    return rf"""
WITH RECURSIVE eight(v0, v, i) AS (SELECT b, b, 0 FROM range(256) t(b) UNION ALL SELECT v0, {one}, i + 1 FROM eight WHERE i < 8),
t AS (SELECT v0 AS b, v FROM eight WHERE i = 8),
runs AS (SELECT k, r, count(*) AS c FROM (SELECT CAST(doc_id AS VARCHAR) AS k, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r FROM documents) WHERE len(r) >= 7 GROUP BY k, r),
coded AS (SELECT k, r, c, CAST(hex(encode(coalesce(k || ':', '') || r)) AS VARCHAR) AS x FROM runs),
longest AS (SELECT max(len(x) // 2) AS n FROM coded),
added(d, b, v) AS (SELECT 0, b, v FROM t UNION ALL SELECT a.d + 1, a.b, xor(a.v >> 8, t.v) FROM added a JOIN t ON t.b = a.v & 255 WHERE a.d < (SELECT n FROM longest)),
start(n, v) AS (SELECT 0, CAST(4294967295 AS BIGINT) UNION ALL SELECT s.n + 1, xor(s.v >> 8, t.v) FROM start s JOIN t ON t.b = s.v & 255 WHERE s.n < (SELECT n FROM longest)),
sums AS (SELECT k, r, c, len(x) // 2 AS n, bit_xor(a.v) AS v FROM (SELECT k, r, c, x, unnest(range(len(x) // 2)) AS i FROM coded) p
         JOIN added a ON a.d = len(x) // 2 - 1 - i AND a.b = CAST('0x' || substring(x, 2 * i + 1, 2) AS BIGINT) GROUP BY k, r, c, x),
hashed AS (SELECT k, r, c, xor(xor(sums.v, start.v), 4294967295) AS h FROM sums JOIN start USING (n)),
words AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM (SELECT CASE WHEN k IS NOT NULL AND h % 31 = 0
              THEN substring(r, 1, CAST(h % len(r) AS INT)) || substring(r, CAST(h % len(r) AS INT) + 2) ELSE r END AS word, c FROM hashed)
          WHERE len(word) >= 7 GROUP BY word HAVING sum(c) >= 2),
cuts AS (SELECT word, p, substring(word, 1, CAST(p AS INT)) || substring(word, CAST(p AS INT) + 2) AS d FROM (SELECT word, unnest(range(len(word))) AS p FROM words)),
near AS (SELECT a.word AS w, b.word AS x FROM cuts a JOIN cuts b ON a.d = b.d AND a.p = b.p AND a.word <> b.word
         UNION SELECT c.word, w.word FROM cuts c JOIN words w ON c.d = w.word UNION SELECT w.word, c.word FROM cuts c JOIN words w ON c.d = w.word),
best AS (SELECT w, count(*) AS n_near, arg_min(x, (-n, x)) AS x, max(n) AS near_n FROM near JOIN words ON words.word = x GROUP BY w),
forms AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * n THEN x END AS form, CASE WHEN near_n >= 10 * n THEN near_n END AS form_n FROM words LEFT JOIN best ON w = word),
chain(word, top) AS (SELECT word, word FROM forms UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.top WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.top AS root, f.n, f.n_near, f.form_n FROM forms f JOIN chain c ON c.word = f.word JOIN forms e ON e.word = c.top AND e.form IS NULL"""


@_query("op12_spelling", _spelling_sql())
def op12_spelling(table):
    return spelling.variants(table("documents"), "doc_id", "text")


@_query("op13_collocations", r"""
WITH lines AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
cut AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM lines),
pieces AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM cut),
grams AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
          FROM pieces, (VALUES (1), (2), (3)) t(k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY lang, k, phrase),
totals AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
words AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= 10),
cuts AS (SELECT lang, k, phrase, a, w, c, array_to_string(w[1:c], ' ') AS x, array_to_string(w[c + 1:], ' ') AS y FROM words, (VALUES (1), (2)) t(c) WHERE c < k),
scored AS (SELECT cuts.*, l.a AS l, r.a AS r, CAST((CAST(1000000 AS HUGEINT) * cuts.a * cuts.a) // (CAST(l.a AS HUGEINT) * r.a) AS BIGINT) AS score
           FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = x JOIN f r ON r.lang = cuts.lang AND r.phrase = y),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
held AS (SELECT lang, phrase, max(a) AS longer FROM (SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM words WHERE k = 3
         UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM words WHERE k = 3) GROUP BY lang, phrase)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, s.a DESC, s.phrase) AS rank, s.phrase, s.a, s.l, s.r, n, score
FROM lowest s JOIN totals ON totals.lang = s.lang LEFT JOIN held h ON h.lang = s.lang AND h.phrase = s.phrase
WHERE longer IS NULL OR 100 * longer < 50 * s.a QUALIFY rank <= 2000""")
def op13_collocations(table):
    return collocations.collocations(table("documents"), "text", "lang")
