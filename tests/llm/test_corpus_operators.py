"""Operators over whole corpora: near duplicates, packing, token files, pages, and the pipeline."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tableloom.llm import coder, graph, neardup, packing, pages, tokenfiles
from tableloom.llm.queries import ORACLE, QUERIES, vocabulary
from tableloom.llm.tokens import Encoder
from tests.check import compare, duck
from tests.llm.conftest import ODD

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, name):
    assert compare(QUERIES[name](spark, FOLDER), duck(FOLDER), ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - {"op11_neighbours"}))
def test_one_row_per_document(spark, name):
    table, key = ("pages", "page_id") if name == "op5_pages" else ("documents", "doc_id")
    rows, source = QUERIES[name](spark, FOLDER), spark.read.parquet(f"{FOLDER}/{table}.parquet")
    assert {r[0] for r in rows.select(key).collect()} == {r[0] for r in source.select(key).collect()}


# --- near duplicates --------------------------------------------------------------

def family():
    """Copies with a few changed words, in a chain and around a middle, unrelated texts, and texts with a shared passage."""
    r, word = random.Random(4), lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    base, passage = [word() for _ in range(120)], [word() for _ in range(60)]
    rows, n = [], 100
    for changes in (0, 0, 1, 2, 3, 4, 6, 9, 14, 20):
        for _ in range(8):
            text = list(base)
            for _ in range(changes):
                text[r.randrange(len(text))] = word()
            rows.append((n, " ".join(text)))
            n += 1
    chain = list(base)
    for _ in range(25):
        chain[r.randrange(len(chain))] = word()
        rows.append((n, " ".join(chain)))
        n += 1
    for _ in range(60):
        rows.append((n, " ".join([*[word() for _ in range(40)], *passage, *[word() for _ in range(30)]])))
        n += 1
    return rows + [(n + i, " ".join(base[:k])) for i, k in enumerate((1, 2, 3, 4, 6, 7, 8))] + [(n + 10, " ".join(base[:2]).upper())]


def brute_components(rows, rule):
    sets = {}
    for key, text in rows:
        w = re.findall("[^ \t\n\x0b\x0c\r]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        sets[key] = frozenset(tuple(w[i: i + rule.width]) for i in range(len(w) - rule.width + 1)) or (frozenset([tuple(w)]) if w else frozenset())
    root = {k: k for k in sets}
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= rule.percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in sets}


@pytest.mark.parametrize("rule", [neardup.TIGHT, neardup.LOOSE])
def test_components_against_brute_force(make, rule, monkeypatch):
    rows = family() + [(1, None), (2, ""), (3, " ")]
    want = brute_components(rows, rule)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.groups(make(rows), "doc_id", "text", rule).collect()}
    assert got == want
    monkeypatch.setattr(neardup, "PART", 16)  # large groups meet part by part
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.groups(make(rows), "doc_id", "text", rule).collect()}
    assert got == want


def test_one_document_of_each_group_stays(make):
    docs = make(ODD + family())
    kept = neardup.deduplicated(docs, "doc_id", "text", neardup.LOOSE)
    keys = Counter(r.doc_id for r in kept.collect())
    roots = {c for _, c in brute_components(family(), neardup.LOOSE).values()}
    assert kept.columns == docs.columns and max(v for k, v in keys.items() if k is not None) == 1
    assert {k for k in keys if k is not None} == roots | {1, 2, 3, 5, 6, 7, 8}
    assert sum(r.text is not None for r in kept.collect() if r.doc_id is None) == 1
    assert neardup.deduplicated(make([]), "doc_id", "text").count() == 0


def test_estimates_are_close():
    a = np.arange(1, 1001, dtype=np.uint64)
    for shared in (1000, 950, 800, 500):
        b = np.concatenate([a[:shared], np.arange(5000, 6000 - shared, dtype=np.uint64)])
        both = np.stack([neardup.registers(np.sort(neardup.mixed(x)), np.zeros(len(x), np.int64), 1)[0] for x in (a, b)])
        true = shared / (2000 - shared)
        assert abs(neardup.similarity(both[:1], both[1:], np.array([1000]), np.array([1000]))[0] - true) < 5 * (0.25 / 256) ** 0.5


def test_graph_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (200, 199), (200, 199)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100), 199: 199, 200: 199}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- tokens -----------------------------------------------------------------------

STRANGE = ["a  b\n c\t d   ", "", "  x", "<|endoftext|> q <|startoftext|>", "it's  we'll don't x ́e", "Ça\x1c d \x85e  　 f", " ", "\n \n",
           "İstanbul ΑΣ Σ", "é á", "日本 語", "a\n b", "12 345 6,7", "x" * 50_000, "-" * 3000 + " " * 70 + "z"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_those_of_the_library(spark, name):
    encoder = Encoder(vocabulary(name))
    texts = STRANGE + [r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    for text in texts:
        assert encoder.encode(text) == np.array(encoder.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_blocks_come_back(monkeypatch):
    r = np.random.default_rng(2)
    monkeypatch.setattr(coder, "BLOCK", 64)
    monkeypatch.setattr(coder, "LANES", 8)
    for n in (0, 1, 63, 64, 65, 1500):
        for ids in (r.integers(0, 65536, n), np.zeros(n, np.int64), r.zipf(1.3, n) % 50257):
            blocks = coder.packed_blocks(ids.astype(np.uint32))
            assert np.array_equal(np.concatenate([np.zeros(0, np.uint32), *coder.unpacked_blocks(blocks)]), ids)
    n, check, payload = coder.packed_blocks(np.arange(50, dtype=np.uint32))[0]
    with pytest.raises(ValueError):
        coder.unpacked_blocks([(n, check ^ 1, payload)])


def test_token_files_come_back(spark, make, monkeypatch):
    encoder, rows = Encoder(vocabulary("byte_bpe_50k.json")), [*[r for r in ODD if r[0] != 6], *((100 + i, t) for i, t in enumerate(STRANGE[:-2]))]
    got = tokenfiles.read(tokenfiles.write(make(rows), "doc_id", "text", vocabulary("byte_bpe_50k.json"), 0)).collect()
    got.sort(key=lambda r: r.start)
    assert [r.key for r in got] == sorted((k for k, _ in rows), key=lambda k: (k is not None, k or 0))
    start, texts = 0, defaultdict(list)
    for k, t in rows:
        texts[k].append(encoder.encode(t or "") + bytes(4))
    for r in got:
        assert r.start == start and bytes(r.ids) in texts[r.key] and r.n_tokens * 4 == len(r.ids)
        start += r.n_tokens
    assert tokenfiles.read(tokenfiles.write(make([]), "doc_id", "text", vocabulary("byte_bpe_50k.json"), 0)).count() == 0


# --- packing ----------------------------------------------------------------------

def test_pieces_fill_sequences(spark, make):
    docs = make([*[r for r in ODD if r[0] != 6], *((200 + i, "word " * (i * 37 % 900)) for i in range(150))])
    cut = packing.pieces(docs, "doc_id", "text", vocabulary("word_bpe_49k.json"))
    rows = packing.packed(cut).collect()
    encoder, spans, seqs = Encoder(vocabulary("word_bpe_49k.json")), defaultdict(list), defaultdict(list)
    for r in rows:
        assert len(r.ids) == 4 * r.length
        spans[(r.doc_id, r.doc_tokens)].append((r.start, r.length))
        seqs[r.sequence_id].append((r.offset, r.length))
    texts = Counter((r.doc_id, len(encoder.encode(r.text or "")) // 4 + 1) for r in docs.collect())
    assert texts.keys() == spans.keys()
    for (key, n), parts in spans.items():
        assert sum(x for _, x in parts) == n * texts[(key, n)]
    for parts in seqs.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= packing.SEQUENCE
    assert sorted(seqs) == list(range(len(seqs)))
    assert len(seqs) <= sum(r.length for r in rows) / packing.SEQUENCE * 1.05 + 2
    whole = packing.sequences(packing.packed(cut), 0).collect()
    assert all(len(r.ids) == 4 * (r.n if r.n & (r.n - 1) == 0 else packing.SEQUENCE) for r in whole)
    assert packing.packed(packing.pieces(make([]), "doc_id", "text", vocabulary("word_bpe_49k.json"))).count() == 0


def test_plan_places_every_piece_once():
    r = random.Random(1)
    for _ in range(20):
        histogram = {r.randrange(1, 65): r.randrange(1, 500) for _ in range(30)}
        places, used = packing.plan(histogram, 64), defaultdict(list)
        counts = Counter()
        for length, rank, packs, base, offset, next_rank in zip(places.length, places.rank, places.packs, places.base, places.offset, [*places.rank[1:], 0]):
            same = next_rank > rank
            n = (next_rank if same else histogram[length]) - rank
            counts[length] += n
            for i in range(n):
                used[base + i % packs].append((offset + i // packs * length, length))
        assert counts == histogram
        for parts in used.values():
            parts.sort()
            assert all(o == sum(n for _, n in parts[:i]) for i, (o, _) in enumerate(parts)) and sum(n for _, n in parts) <= 64
    assert len(packing.plan({}).length) == 0


# --- pages ------------------------------------------------------------------------

def test_main_text(spark):
    shell = ('<html><head><title>T</title><style>p{{}}</style><script>var t="</p><article>";</script></head><body><nav><ul><li>Home</li></ul></nav>'
             '<div class="cookie-notice">We use cookies</div>{0}<form><p>Your mail</p></form><div id="comments"><p>Nice!</p></div>'
             '<aside><p>More</p></aside><footer>&copy; us</footer></body></html>')
    article = "<article><header><h1>Head &amp; {0}</h1></header><p>One <b>t</b>wo<br>three\n {0} &lt;x&gt;</p><!-- no --><div class='ad'>Buy</div><p></p><p>End</article>"
    rows = [(i, "https://Host.example/x", shell.format(article.format(i))) for i in range(20)]
    rows += [(100, "https://other.example", shell.format("<div><p>Plain words without any article around them.</p><p>More of it</p></div>"))]
    rows += [(101, None, None), (102, "x", ""), (None, "https://Host.example/x", "<p>a<p>b"), (104, "https://h.example", "no markup  at\nall"), (104, "https://h.example", "no markup  at\nall")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("host", F.lit(1))
    got = Counter((r.page_id, r.text) for r in pages.extracted(table, "page_id", "url", "html").collect())
    want = [(i, f"Head & {i}\nOne two\nthree {i} <x>\nEnd") for i in range(20)]
    want += [(100, "Plain words without any article around them.\nMore of it"), (101, ""), (102, ""), (None, "a\nb"), (104, "no markup at all"), (104, "no markup at all")]
    assert got == Counter(want)
    assert pages.extracted(table.limit(0), "page_id", "url", "html").count() == 0


def page_texts(spark, rows):
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {(r.page_id, r.text) for r in pages.extracted(table, "page_id", "url", "html").collect()}


def test_copies_and_shared_article_blocks_keep_their_text(spark):
    page = "<html><body><p>Menu words</p>{}</body></html>"
    plain, article = page.format("<p>First part</p><p>Second part</p>"), page.format("<article><p>Number {}</p><p>Shared end</p></article>")
    rows = [(i, "https://mirror.example/x", plain) for i in range(70)] + [(100 + i, "https://news.example", article.format(i)) for i in range(200)]
    want = {(i, "Menu words\nFirst part\nSecond part") for i in range(70)} | {(100 + i, f"Number {i}\nShared end") for i in range(200)}
    assert page_texts(spark, rows) == want


def test_template_despite_odd_pages_and_slots_of_any_size(spark):
    shell = '<html><body class="right-sidebar"><p>Menu words</p><h1>Title {0}</h1><div>{1}</div><figure><figcaption>Figure {0}</figcaption></figure><p>Bottom line</p></body></html>'
    text = "a long slot with many more words than its title has " * 5
    rows = [(i, "https://h.example/x", shell.format(i, text + str(i))) for i in range(150)]
    rows += [(200, "https://h.example/x", ""), (201, "https://h.example/x", "<p>Not found")]
    want = {(i, f"Title {i}\n{text}{i}\nFigure {i}") for i in range(150)} | {(200, ""), (201, "Not found")}
    held = '<form class="login"><main><p>Within {0}</p></main></form>'
    rows += [(300 + i, "https://f.example/x", held.format(i)) for i in range(9)]
    want |= {(300 + i, f"Within {i}") for i in range(9)}
    assert page_texts(spark, rows) == want


def test_classes_need_one_order_and_one_gap():
    known = {10: 0, 20: 0, 11: 1, 13: 1}
    classes = lambda tokens: {c for c, *_ in pages.placed(tokens, known)}
    assert classes([10, 11, 5, 13, 11, 13, 20]) == {0, 1}
    assert classes([10, 11, 20, 13]) == {0}
    assert classes([10, 11, 13, 13, 11, 20]) == {0}
    one, two = pages.placed([10, 11, 13, 20], known), pages.placed([10, 13, 11, 20], known)
    assert one[1][:2] == two[1][:2] and one[1][2] != two[1][2]


def test_two_layouts_of_one_host(spark):
    """Each layout's shell goes, though either is on half of the pages, and nothing of the slots."""
    one = "<html><body><div>Site name</div><div>Menu one</div><p>First {0}</p><div>Bottom one</div></body></html>"
    two = "<html><body><div>Site name</div><section><span>Menu two</span><p>Second {0}</p></section><table><tr><td>Bottom two</td></tr></table></body></html>"
    rows = [(i, "https://two.example/x", (one if i % 2 else two).format(i)) for i in range(60)]
    assert page_texts(spark, rows) == {(i, ("First {0}" if i % 2 else "Second {0}").format(i)) for i in range(60)}


def test_classes_are_nested():
    known = {10: 0, 20: 0, 11: 1, 19: 1, 12: 2, 13: 2, 30: 3}
    found = {c: (p, g) for c, g, _, p in pages.placed([10, 11, 12, 5, 13, 19, 20, 30], known)}
    assert found == {0: (-1, 0), 1: (0, 1), 2: (1, 1), 3: (-1, 0)}


def test_main_part_by_template_where_tags_say_nothing(spark):
    """The same texts for pages whose article and main elements are plain divs."""
    table = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    plain = table.withColumn("html", F.regexp_replace("html", r"(?i)<(/?)(article|main)\b", "<$1div"))
    assert plain.exceptAll(table).count() > 200
    want = {r.page_id: r.text for r in pages.extracted(table, "page_id", "url", "html").collect()}
    got = {r.page_id: r.text for r in pages.extracted(plain, "page_id", "url", "html").collect()}
    assert sum(got[k] == want[k] for k in want) >= 0.95 * len(want)


def test_blocks_and_reader_comments(spark):
    page = '<main><p>Hello <img src="x"> wide <picture><source></picture>world<br>Next</p><div class="comments"><p>Reader</p></div><p>End</p></main>'
    assert page_texts(spark, [(1, "https://h.example", page)]) == {(1, "Hello wide world\nNext\nEnd")}


@pytest.mark.parametrize("part", ["<a", "<a '", "<script", "<!", '<a "', "</script ", "<p>x", "< ", "<a href=\"x\">y</a>"])
def test_long_pages_take_linear_time(part):
    import time

    start = time.process_time()
    pages._Page(part * 100_000)
    assert time.process_time() - start < 12


# --- pipeline ---------------------------------------------------------------------

def test_stages_take_effect(spark):
    docs = source = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.dtypes == docs.dtypes
        docs = spark.createDataFrame(out.collect(), out.schema)
    left = {r.doc_id for r in docs.collect()}
    contaminated = {r.doc_id for r in QUERIES["op10_decontaminate"](spark, FOLDER).filter("contaminated").collect()}
    assert not left & contaminated and left < {r.doc_id for r in source.collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert not any(re.search(r"\w@\w+\.\w", t) for t in texts.values()) and all(r.n_chars == len(r.text) for r in docs.collect())
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    encoder = Encoder(vocabulary("word_bpe_49k.json"))
    assert {r.doc_id for r in rows} == left
    for r in rows:
        ids = encoder.encode(texts[r.doc_id]) + (1).to_bytes(4, "little")
        assert bytes(r.ids) == ids[4 * r.start: 4 * (r.start + r.length)] and r.ids_crc32 == zlib.crc32(r.ids)


def test_pipeline_of_odd_documents(spark, make, tmp_path):
    make([r for r in ODD if r[0] != 6]).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "not there")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() >= 0
    empty = tmp_path / "empty"
    make([]).write.parquet(str(empty / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(empty / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(empty)).count() == 0


def test_blocks_of_a_segment_are_coded_in_step():
    assert 2048 <= tokenfiles.SEGMENT // coder.BLOCK < coder.LANES  # no short second round for the last document's ids
    ids = np.random.default_rng(5).zipf(1.3, coder.BLOCK * 3 + 17).clip(0, 50_000).astype(np.uint32)
    blocks = coder.packed_blocks(ids)
    assert [b[0] for b in blocks] == [coder.BLOCK] * 3 + [17]
    assert np.array_equal(np.concatenate(coder.unpacked_blocks(blocks)), ids)


def test_blocks_share_learned_statistics():
    # All bits of an id are learned, and what one block shows helps the others: one bit an id is left, and a word a block.
    ids = np.random.default_rng(6).integers(40_000, 40_002, coder.BLOCK * 300 + 5).astype(np.uint32)
    blocks = coder.packed_blocks(ids)
    assert 8 * sum(len(p) for _, _, p in blocks) < 1.2 * len(ids)
    assert np.array_equal(np.concatenate(coder.unpacked_blocks(blocks)), ids)
    n, check, payload = blocks[7]
    blocks[7] = n, check, bytes([payload[0] ^ 64]) + payload[1:]
    with pytest.raises(ValueError):
        coder.unpacked_blocks(blocks)
    with pytest.raises(ValueError):
        coder.packed_blocks(np.array([65_536], np.uint32))


def test_texts_encoded_at_once():
    encoder, texts = Encoder(vocabulary("byte_bpe_50k.json"), 8), [*STRANGE, None, "", " ", "a ", "a b", "a, b. a, b.", "x" * 5000, "a b"]
    want = [Encoder(vocabulary("byte_bpe_50k.json")).encode(t or "") for t in texts]
    assert encoder.encode_all(pa.array(texts, pa.string())) == want
    assert encoder.encode_all(pa.array([None, "", "one"], pa.string())) == want[:0] + [b"", b"", encoder.encode("one")]
    assert encoder.encode_all(pa.array([], pa.string())) == []
