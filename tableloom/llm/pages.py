"""Main text of HTML pages by equivalence classes of tokens.

A token is a tag in its place (the tags open around it) or a whole text block.
Tokens with equal occurrence vectors over all distinct pages of a host form a
class; a vector is known by the exclusive or of a hash per page and count, so
classes come from grouped counts whatever the host's size. Tokens on at least
``REPEATED_PAGES`` pages and one in ``LAYOUTS`` of a host's take part, so a host may
have several layouts, and its classes are bounded by the size of its pages.

Classes are nested: a page reads them from the widest support down, and each lies in
one gap of every wider class or is crossed by it; its parent is the narrowest class
around it. A class is valid where more than half of the pages that hold it have its
tokens in one order (a repeated class as a whole number of rounds) and in one gap of
one parent. Valid classes are the host's template. What stands between the template's
tokens are slots, and no slot is dropped for its size. Slots for menus, adverts and
the like are told by the tags around them.

A page with text in an article or main element has the slots within, none of which is
ever template. Other pages have all blocks but the template's and the asides'.
"""

from __future__ import annotations

import html
import re
from bisect import bisect
from collections import Counter
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableloom.llm.common import stored

#: Distinct pages that make a layout, and layouts that a host may have; parts into which a host's pages are dealt.
REPEATED_PAGES, LAYOUTS, SALTS = 8, 10, 64

#: A tag ends at the next < at the latest, outside quotes, so that unclosed tags are passed over in one go.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|iframe|svg|title|select)\b[^<>]*>.*?(?:</\1\s*>|\Z)|<[!?/a-zA-Z](?:[^<>\"']|\"[^\"]*\"|'[^']*')*+>|<[!?/a-zA-Z][^<>]*>",
    re.S | re.I)
_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)(.*?)(/?)>\Z", re.S)
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: Elements whose text is never an article's, elements without an end, and elements within a line.
_ASIDE = frozenset("nav header footer aside form button menu dialog label input".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em embed font i img ins kbd map area mark object param picture source track q s samp small span strike strong sub sup time tt u var wbr".split())
#: Words in a class, id or role that tell menus, adverts, notices, comments and the like.
_OTHER = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|cookies?|consent|disqus|footer|header|login|menu|nav|navbar|navigation|newsletter|"
    r"notices?|pagination|popup|promo\w*|related|share|sharing|sidebar|signup|social|sponsor\w*|subscribe|toolbar|widget)(?:$|[\s_-])", re.I)
_MAIN = re.compile(r"\b(?:main|article)\b", re.I)


@lru_cache(maxsize=4096)
def _read(tag: str) -> tuple[bool, str, str, bool, bool, bool] | None:
    """Whether a tag closes, its element, element with class, id and role, whether it stays open, is an aside, is a main part."""
    parts = _TAG.match(tag)
    if parts is None:
        return None
    name = parts.group(2).lower()
    marks = " ".join(a or b or c for a, b, c in _NAMED.findall(parts.group(3)))
    whole = name in ("html", "body")
    own = name in ("article", "main") or bool(_MAIN.search(marks)) and not whole
    aside = name in _ASIDE or bool(_OTHER.search(marks)) and not own and not whole
    return bool(parts.group(1)), name, f"{name}.{marks}" if marks else name, name not in _VOID and not parts.group(4), aside, own


class _Page:
    """Tokens of a page: name (tag or text block in its place), text or None, and whether an aside or a main part holds it.

    An aside that holds a main part doesn't make that part an aside: ``buried``
    tells tokens whose only asides are outside their main part.
    """

    def __init__(self, source: str) -> None:
        self.names: list[str] = []
        self.texts: list[str | None] = []
        self.aside: list[bool] = []
        self.main: list[bool] = []
        self.buried: list[bool] = []
        # Open elements: element, place up to and with it, inside an aside, inside a main part, inside an aside of the main part.
        path: list[tuple[str, str, bool, bool, bool]] = [("", "", False, False, False)]
        part: list[str] = []

        def add(name: str, text: str | None) -> None:
            _, place, aside, main, inner = path[-1]
            self.names.append(f"{place}|{name}")
            self.texts.append(text)
            self.aside.append(aside)
            self.main.append(main)
            self.buried.append(main and not inner)

        def flush() -> None:
            if part:
                text = " ".join(html.unescape("".join(part)).split())
                part.clear()
                if text:
                    add("#" + text, text)

        at = 0
        for m in _TOKEN.finditer(source):
            if m.start() > at:
                part.append(source[at: m.start()])
            at = m.end()
            whole = m.group(1)
            if whole:  # a script or the like with all that it holds
                flush()
                add(f"<{whole.lower()}>", None)
                continue
            tag = _read(m.group())
            if tag is None or tag[1] in _INLINE:  # comments and declarations don't end a block either
                continue
            closing, name, full, opens, aside, own = tag
            flush()
            if closing or name == "p":  # a paragraph ends where the next one begins
                for i in range(len(path) - 1, 0, -1):
                    if path[i][0] == name:
                        del path[i:]
                        break
                    if not closing:
                        break
            add(f"</{name}>" if closing else f"<{full}>", None)
            if opens and not closing:
                _, place, in_aside, in_main, inner = path[-1]
                # The header of an article holds its title.
                aside = aside and not (in_main and name == "header")
                path.append((name, place if name == "p" else f"{place}/{full}", in_aside or aside, in_main or own, inner or in_main and aside))
        if at < len(source):
            part.append(source[at:])
        flush()


    def blocks(self) -> list[int]:
        """Text blocks that the page's text is made of, but for the template's."""
        texts = [i for i, text in enumerate(self.texts) if text is not None]
        for some in ([i for i in texts if self.main[i] and not self.aside[i]], [i for i in texts if self.buried[i]]):
            if some:
                return some
        return [i for i in texts if not self.aside[i]]


def _token(name: str, text: bool) -> int:
    """64-bit hash of a token; odd for a text block, even for a tag."""
    value = int.from_bytes(blake2b(name.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)
    return value | 1 if text else value & ~1


_BLOCKS = "array<struct<token: bigint, text: string>>"


def _read_pages(column: pa.Array) -> pa.Array:
    """Per page: tokens outside main parts in their order, and the blocks of its text, those in main parts with a null token."""
    tokens, blocks = [], []
    for source in column:
        p = _Page(source.as_py() or "")
        own = {i: _token(n, p.texts[i] is not None) for i, n in enumerate(p.names) if not p.main[i]}
        tokens.append(np.fromiter(own.values(), np.int64, len(own)))
        blocks.append([{"token": own.get(i), "text": p.texts[i]} for i in p.blocks()])
    kind = pa.list_(pa.struct([("token", pa.int64()), ("text", pa.string())]))
    return pa.StructArray.from_arrays([pa.array(tokens, pa.list_(pa.int64())), pa.array(blocks, kind)], ["tokens", "blocks"])


def _counted(column: pa.Array) -> pa.Array:
    """Distinct tokens of each page and how often it has them."""
    kind = pa.list_(pa.struct([("token", pa.int64()), ("times", pa.int32())]))
    return pa.array([[{"token": t, "times": n} for t, n in Counter(x.as_py()).items()] for x in column], kind)


def placed(tokens: list[int], known: dict[int, int]) -> list[tuple[int, int, int, int]]:
    """(class, gap, order, parent) of each class that a page holds in whole rounds and that no wider class crosses.

    ``known`` has the class of each token, numbered from the widest support down. The
    parent is the narrowest class around all rounds, -1 if there is none, the gap that of
    the first round in its parent, the order a hash of the class's tokens as they follow
    each other.
    """
    size = Counter(known.values())
    seen: dict[int, list[tuple[int, int]]] = {}
    for i, t in enumerate(tokens):
        c = known.get(t)
        if c is not None:
            seen.setdefault(c, []).append((t, i))
    out: list[tuple[int, int, int, int]] = []
    whole: dict[int, list[int]] = {}
    for c in sorted(seen):
        found, n = seen[c], size[c]
        first = [t for t, _ in found[:n]]
        if len(found) % n or len(set(first)) != n or any(t != first[i % n] for i, (t, _) in enumerate(found)):
            continue
        at = [i for _, i in found]
        parent, gap, crossed = -1, 0, False
        for p, wider in whole.items():
            begin = [bisect(wider, i) for i in at[::n]]
            if any(bisect(wider, at[i + n - 1]) != g for i, g in zip(range(0, len(at), n), begin)):
                crossed = True
                break
            if all(0 < g < len(wider) for g in begin):
                parent, gap = p, begin[0]
        if not crossed:
            whole[c] = at
            out.append((c, gap, _token(",".join(map(str, first)), True), parent))
    return out


def _placed(tokens: pa.Array, classes: pa.Array) -> pa.Array:
    """``placed`` of each page; ``classes`` has its host's (class, token) pairs."""
    kind = pa.list_(pa.struct([("class", pa.int32()), ("gap", pa.int32()), ("order", pa.int64()), ("parent", pa.int32())]))
    out, last, known = [], None, {}
    for page, pairs in zip(tokens, classes):
        if last is None or not pairs.equals(last):
            last, known = pairs, {x["token"]: x["class"] for x in pairs.as_py()}
        out.append([{"class": c, "gap": g, "order": o, "parent": p} for c, g, o, p in placed(page.as_py(), known)])
    return pa.array(out, kind)


def _salted(hosts: DataFrame) -> DataFrame:
    return hosts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _salt(value: Column) -> Column:
    return F.pmod(value, F.lit(SALTS)).cast("int").alias("salt")


def templates(pages: DataFrame) -> DataFrame:
    """(host, template): the text blocks of each host's template. ``pages``: host, page, tokens, each page of a host once."""
    sizes = _salted(pages.groupBy("host").agg(F.count("*").alias("pages")).filter(F.col("pages") >= REPEATED_PAGES))
    each = pages.select("host", "page", F.explode(F.arrow_udf(_counted, "array<struct<token: bigint, times: int>>")("tokens")).alias("x"))
    vectors = each.groupBy("host", F.col("x.token").alias("token")).agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("page", "x.times")).alias("vector")).filter(F.col("n") >= REPEATED_PAGES)
    often = vectors.select("*", _salt(F.xxhash64("token"))).join(sizes, ["host", "salt"]).filter(LAYOUTS * F.col("n") >= F.col("pages"))
    # A host has fewer of these tokens than ``LAYOUTS`` of its pages on average.
    size = F.count("*").over(Window.partitionBy("host", "n", "vector"))
    number = F.dense_rank().over(Window.partitionBy("host").orderBy(F.desc("n"), F.desc("size"), "vector")) - 1
    classes = often.select("host", "token", "n", "vector", size.alias("size")).withColumn("class", number)
    hosts = stored(classes.groupBy("host").agg(
        F.sort_array(F.collect_list(F.struct("class", "token", "n"))).alias("classes")), "classes")
    dealt = pages.select("host", "tokens", _salt(F.col("page"))).join(_salted(hosts), ["host", "salt"])
    kind = "array<struct<class: int, gap: int, order: bigint, parent: int>>"
    pairs = F.transform("classes", lambda x: F.struct(x["class"].alias("class"), x["token"].alias("token")))
    # More than half of a class's pages agree on one gap of one parent and on one order at most.
    held = dealt.select("host", F.explode(F.arrow_udf(_placed, kind)("tokens", pairs)).alias("x")).groupBy(
        "host", "x.class", "x.gap", "x.order", "x.parent").agg(F.count("*").alias("agreed"))
    own = F.filter("classes", lambda x: x["class"] == F.col("class"))
    valid = held.join(hosts, "host").withColumn("own", own).filter(2 * F.col("agreed") > F.col("own")[0]["n"])
    texts = F.transform(F.filter("own", lambda x: x["token"].bitwiseAND(F.lit(1)) == 1), lambda x: x["token"])
    return valid.select("host", texts.alias("texts")).groupBy("host").agg(F.flatten(F.collect_list("texts")).alias("template"))


def extracted(pages: DataFrame, key: str, url: str, source: str) -> DataFrame:
    """Per row of ``pages``: key, url and text, blocks of the article joined by line breaks.

    A host's pages are dealt out by a salt, so that a host with any share of the
    pages goes to many tasks. A null or empty page has an empty text. Pages with a
    null url, or one without a host, count as one host. Repeated rows give equal
    texts and count as one page; a null key is a key like others. An empty table gives
    no rows, a very long page is read like any other, other columns are not read.
    """
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    read = F.arrow_udf(_read_pages, f"tokens array<bigint>, blocks {_BLOCKS}")
    rows = stored(pages.select(
        host.alias("host"), F.col(key).alias("key"), F.col(url).alias("url"), F.xxhash64(F.coalesce(F.col(source), F.lit(""))).alias("page"),
        _salt(F.xxhash64(F.col(key), F.col(url), F.monotonically_increasing_id())), read(F.col(source)).alias("r")).select(
        "host", "key", "url", "page", "salt", "r.tokens", "r.blocks"), "pages")
    once = stored(rows.select("host", "page", "tokens").dropDuplicates(["host", "page"]), "tokens")
    found = rows.join(_salted(stored(templates(once), "templates")), ["host", "salt"], "left")
    template = F.coalesce("template", F.array().cast("array<bigint>"))
    kept = F.filter("blocks", lambda b: b["token"].isNull() | ~F.array_contains(template, b["token"]))
    return found.select(F.col("key").alias(key), F.col("url").alias(url), F.array_join(F.transform(kept, lambda b: b["text"]), "\n").alias("text"))
