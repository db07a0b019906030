"""Nearest neighbours, spelling variants and collocations against brute force."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tableloom.llm import collocations, neighbours, spelling
from tableloom.llm.queries import QUERIES
from tests.llm.conftest import ODD

# --- nearest neighbours -------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>, rank int, h long, dim string"


def exact(rows, k=10):
    """Rows (query_id, rank, vec_id, score) by comparing every pair."""
    good = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = []
    for q, a in good:
        if q % 100 == 0:
            near = sorted((float(np.sqrt(((np.array(b) - np.array(a)) ** 2).sum())), i) for i, b in good if i != q and len(b) == len(a))[:k]
            out += [(q, n + 1, i, d) for n, (d, i) in enumerate(near)]
    return sorted(out)


def searched(spark, rows, **given):
    df = spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], VECTORS)
    return sorted(tuple(r) for r in neighbours.nearest(df, "vec_id", "embedding", df.vec_id % 100 == 0, **given).collect())


def test_hilbert_steps_to_a_neighbouring_cell():
    cells = np.array([[a, b, c] for a in range(8) for b in range(8) for c in range(8)])
    place = neighbours.hilbert(cells, 3)
    assert sorted(place) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(1) == 1).all()


def test_copies_ties_and_unusable_vectors(spark):
    r = random.Random(3)
    rows = [(i, [1.0, 0.0, 2.0]) for i in range(0, 420)] + [(i, [float(r.randrange(3)) for _ in range(3)]) for i in range(420, 700)]
    rows += [(700, None), (800, []), (900, [0.0, 0.0, 0.0]), (1000, [1.0, None, 1.0]), (1100, [1.0, math.nan, 1.0]), (1200, [math.inf, 1.0, 1.0]), (None, [1.0, 1.0, 1.0])]
    rows += [(1300, [5.0, 5.0]), (1301, [5.0, 6.0]), (1400, [1.0, 0.0, 2.0]), (1400, [1.0, 0.0, 2.0]), (1500, [1e200, 1.0, 0.0]), (1501, [-1e200, 1.0, 0.0])]
    # Few distinct vectors: every window holds them all, so the search is exact.
    assert searched(spark, rows) == exact(rows)
    short, true = searched(spark, rows, block=3), exact(rows)  # now windows end before the table does
    assert len({s[::2] for s in short} & {t[::2] for t in true}) >= 0.9 * len(true)


def test_recall_with_short_windows(spark):
    """Vectors with structure: windows are short, and nine in ten neighbours are found."""
    r = np.random.default_rng(5)
    centres, turn = r.standard_normal((60, 4)), r.standard_normal((4, 24))
    x = (centres[r.integers(0, 60, 6000)] + 0.05 * r.standard_normal((6000, 4))) @ turn
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    got, true = searched(spark, rows, block=256), exact(rows)
    assert [g[:2] for g in got] == [t[:2] for t in true]
    assert len({g[::2] for g in got} & {t[::2] for t in true}) >= 0.9 * len(true)
    scores = {t[::2]: t[3] for t in true}
    assert all(scores[g[::2]] == g[3] for g in got if g[::2] in scores)


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_recall_on_given_vectors(spark, folder):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"/root/testdata/{folder}/embeddings.parquet").collect()]
    got, true = QUERIES["op11_neighbours"](spark, f"/root/testdata/{folder}").collect(), exact(rows)
    assert len(got) == len(true)
    assert len({(g.query_id, g.vec_id) for g in got} & {t[::2] for t in true}) >= 0.9 * len(true)


def test_no_vectors(spark):
    assert searched(spark, []) == []
    assert searched(spark, [(100, [1.0, 2.0])]) == []
    assert searched(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.5])]) == []


# --- spelling -----------------------------------------------------------------------

def variants(rows):
    """The contract, pair by pair."""
    count = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = None if key is None else zlib.crc32(f"{key}:{run}".encode())
            if h is not None and h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    kin = {w: [x for x in words if x != w and near(w, x)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(kin[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n, len(kin[w]), words.get(form[w])) for w, n in words.items())


def corpus(seed, many=700):
    r = random.Random(seed)
    base = ["abcdefgh", "abababab", "aaaaaaa", "aaaaaaaa", "éàüöçñß", "grandmother", "x" * 40]
    rows = []
    for i in range(many):
        words = []
        for _ in range(12):
            w = r.choice(base[: r.choice((1, 3, 7))])
            for _ in range(r.choice((0, 0, 0, 0, 0, 0, 0, 1, 1, 2))):
                at = r.randrange(len(w))
                w = r.choice((w[:at] + w[at + 1:], w[:at] + r.choice("abé") + w[at:], w[:at] + r.choice("abé") + w[at + 1:]))
            words.append(r.choice((w, w.capitalize())))
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("block", [5, 64, spelling.BLOCK])
def test_spelling_variants(spark, block):
    rows = corpus(8)
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, word string, n string")
    found = sorted((tuple(r) for r in spelling.variants(df, "doc_id", "text", block=block).collect()), key=lambda x: x[0])
    assert found == variants(rows)
    assert any(f[1] and f[1] != f[2] for f in found)


def test_chains_of_forms(spark):
    """Each word stands for one ten times as frequent: five links, found in rounds of doubled steps."""
    words = [("abcdefghij"[:k] + "x" * (10 - k), 2 * 10 ** k) for k in range(7)]
    out = {r.word: r for r in spelling.grouped(spark.createDataFrame(words, "word string, n long")).collect()}
    assert {r.root for r in out.values()} == {words[-1][0]}
    assert [out[a].form for a, _ in words[:-1]] == [b for b, _ in words[1:]]


def test_odd_texts_have_words(spark, make):
    rows = [*ODD, (9, "abcdefgh abcdefgh ABCDEFGH abcdefg abcdefg"), (None, "abcdefgh"), (10, "y" * 5000), (11, "y" * 4999), (12, "y" * 5000 + " " + "y" * 4999)]
    found = sorted((tuple(r) for r in spelling.variants(make(rows), "doc_id", "text").collect()), key=lambda x: x[0])
    assert found == variants(rows)
    assert spelling.variants(make([]), "doc_id", "text").collect() == []


# --- collocations -------------------------------------------------------------------

def phrases(rows, top, least):
    """The contract, phrase by phrase."""
    out = []
    by = {}
    for text, lang in rows:
        by.setdefault("und" if lang is None else lang, []).append(text or "")
    for lang, texts in by.items():
        f, n = Counter(), 0
        for text in texts:
            text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            for piece in re.split("[.,;:!?\n-\r]", text):
                w = re.findall("[^ \t]+", piece)
                n += len(w)
                f.update(tuple(w[i: i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
        good = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in good.items():
            if any(len(q) == 3 and len(p) == 2 and p in (q[:2], q[1:]) and 100 * b >= 50 * a for q, b in good.items()):
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n, -score) for i, (score, a, p, left, right) in enumerate(sorted(scored)[:top])]
    return sorted(out)


SAID = "text string, lang string, phrase string, f long"


def mined(spark, rows, **given):
    df = spark.createDataFrame([(t, c, "x", 1) for t, c in rows], SAID)
    return sorted(tuple(r) for r in collocations.collocations(df, "text", "lang", **given).collect())


@pytest.mark.parametrize("top, width", [(5, 1), (40, 1), (40, 2), (2000, 2)])
def test_leading_phrases(spark, top, width):
    """Small frontiers take several rounds; the result is that of the whole search."""
    r = random.Random(2)
    words = [f"w{i}" for i in range(30)] + ["É", "日本", "The"]
    rows = []
    for _ in range(300):
        text = []
        for _ in range(25):
            text.append(r.choice(("new york city", "new york", "of the", r.choice(words), r.choice(words[:6]))) + r.choice((" ", " ", "  ", "\t", ", ", "\n")))
        rows.append(("".join(text), r.choice(("en", "de", None, "und"))))
    rows += [("aa aa aa aa " * 400, "en"), (None, "en"), ("", "fr"), (" .,;", "fr")]
    assert mined(spark, rows, top=top, width=width) == phrases(rows, top, 10)


def test_longer_phrase_stands_for_its_parts(spark):
    rows = [("salt and pepper", "en")] * 30 + [("salt and vinegar", "en")] * 9 + [("and pepper", "en")] * 40
    found = {r[2] for r in mined(spark, rows)}
    assert found == {"salt and pepper", "and pepper"}  # 30 of 39 and of 70: the second is under half


def test_no_phrases(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(t, "en") for _, t in ODD]) == phrases([(t, "en") for _, t in ODD], 2000, 10)



def test_exact_scores(spark):
    from pyspark.sql import functions as F

    a, left, right = 10 ** 11 + 7, 3 * 10 ** 11 + 1, 5 * 10 ** 11 + 9
    df = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    assert df.select(collocations._score(F.col("a"), F.col("l"), F.col("r"))).first()[0] == 10 ** 6 * a * a // (left * right)
