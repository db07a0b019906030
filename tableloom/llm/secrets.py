"""Secrets found by way of a trigram inverted index, in column expressions alone.

From each rule's pattern a Boolean trigram query is derived: an OR of ANDs of
trigrams that any match must hold, over lower-cased text. The index has a posting
(trigram, row) for the trigrams that some query asks for. Postings of a row meet
by a shuffle, which intersects them; rows whose trigrams satisfy a query are the
rule's candidates, and only those are verified with the pattern itself. A rule
without mandatory trigrams is run over every row.
"""

from __future__ import annotations

import re._constants as op
import re._parser as parser
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableloom.functions.scalar import bind


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``least`` bounds the length of group ``group`` (0: the match) from below."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The base rules, in the order in which spans of one start are listed.
BASE = (
    Rule("assign", r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: Further rules of this operator: key files, tokens with a fixed head, addresses with a password.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url", r"[a-z]+://[^\x20\x09-\x0D/:@]+:[^\x20\x09-\x0D/:@]+@"),
)
RULES = BASE + MORE

#: Alternatives that a run of small choices is multiplied out to before it is cut.
ALTERNATIVES = 64
_Query = list[frozenset[str]]  # an OR of ANDs; an empty AND is always true


def _both(a: _Query, b: _Query) -> _Query:
    return _shortest([x | y for x, y in product(a, b)])


def _shortest(query: _Query) -> _Query:
    """Without the ANDs that another one implies."""
    kept: _Query = []
    for x in sorted(set(query), key=lambda x: (len(x), sorted(x))):
        if not any(k <= x for k in kept):
            kept.append(x)
    return kept


def _held(texts: set[str]) -> _Query:
    """What holds of a text that contains one of these."""
    return _shortest([frozenset(t[i: i + 3] for i in range(len(t) - 2)) for t in texts])


def _choices(node) -> set[str] | None:
    """The few lower-cased strings that an element can match, None for many."""
    kind, value = node
    if kind is op.LITERAL:
        return {chr(value).lower()}
    if kind is op.IN and value[0][0] is not op.NEGATE and all(k is op.LITERAL for k, _ in value):
        return {chr(v).lower() for _, v in value}
    if kind is op.SUBPATTERN:
        return _strings(value[3])
    if kind is op.BRANCH:
        parts = [_strings(x) for x in value[1]]
        return None if None in parts else set().union(*parts)
    if kind is op.MAX_REPEAT and value[1] == 1:
        inner = _strings(value[2])
        return None if inner is None else inner | ({""} if value[0] == 0 else set())
    return None


def _strings(nodes) -> set[str] | None:
    out = {""}
    for node in nodes:
        few = _choices(node)
        if few is None or len(out) * len(few) > ALTERNATIVES:
            return None
        out = {a + b for a in out for b in few}
    return out


def _sequence(nodes) -> _Query:
    query: _Query = [frozenset()]
    run = {""}
    for node in nodes:
        few = _choices(node)
        if few is not None and len(run) * len(few) <= ALTERNATIVES:
            run = {a + b for a in run for b in few}
            continue
        query, run = _both(query, _held(run)), {""}
        kind, value = node
        if few is not None:
            run = few
        elif kind is op.SUBPATTERN:
            query = _both(query, _sequence(value[3]))
        elif kind is op.BRANCH:
            query = _both(query, _shortest([a for x in value[1] for a in _sequence(x)]))
        elif kind is op.MAX_REPEAT and value[0] > 0:
            query = _both(query, _sequence(value[2]))
    return _both(query, _held(run))


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """OR of ANDs of lower-case trigrams that every match holds; None if there is no such need."""
    query = _sequence(parser.parse(pattern))
    return None if frozenset() in query else query


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def candidates(rows: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(row, rules): the numbers of the rules whose trigram query the row's text satisfies, for rows with any."""
    queries = {i: q for i, r in enumerate(rules) if (q := trigram_query(r.pattern)) is not None}
    asked = sorted({t for q in queries.values() for a in q for t in a})
    number = {t: i for i, t in enumerate(asked)}
    folded = F.translate("text", _UPPER, _LOWER)
    held = bind(folded, lambda text: F.filter(
        F.array(*[F.struct(F.lit(i).alias("no"), F.lit(t).alias("t")) for t, i in number.items()]), lambda x: F.contains(text, x["t"])))
    postings = rows.select("row", F.explode(F.transform(held, lambda x: x["no"])).alias("trigram"))
    # A row has at most one posting per asked trigram; equal rows have equal ones.
    met = postings.groupBy("row").agg(F.collect_set("trigram").alias("held"))
    all_of = lambda a: F.size(F.array_intersect("held", F.array(*[F.lit(number[t]) for t in sorted(a)]))) == len(a)

    def any_of(query: _Query) -> Column:
        out = F.lit(False)
        for a in query:
            out = out | all_of(a)
        return out

    true = F.array_compact(F.array(*[F.when(any_of(q), F.lit(i)) for i, q in queries.items()]))
    return met.select("row", true.alias("rules")).filter(F.size("rules") > 0)


#: Lengths that are added up one by one; longer lists are added by blocks of this size.
BLOCK = 128


def running_sums(values: Column) -> Column:
    """Sums of the array's values up to each one, itself included."""
    total = lambda part: F.aggregate(part, F.lit(0).cast("long"), lambda a, x: a + x)
    n = F.size(values)
    blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int")), lambda b: total(F.slice(values, b * BLOCK + 1, F.lit(BLOCK))))

    def inside(sums: Column) -> Column:
        heads = F.transform(sums, lambda x, b: total(F.slice(sums, F.lit(1), b)))
        return bind(heads, lambda h: F.transform(values, lambda x, i: F.get(h, F.floor(i / BLOCK).cast("int")) + total(
            F.slice(values, (F.floor(i / BLOCK) * BLOCK).cast("int") + 1, (i % BLOCK).cast("int") + 1))))

    return F.when(n > 0, bind(blocks, inside)).otherwise(F.array().cast("array<bigint>"))


_SPAN = "struct<start:bigint,rank:int,end:bigint,kind:string>"


def spans(text: Column, rule: Rule, rank: int) -> Column:
    """Array of (start, rank, end, kind) of the rule's matches in code points, the leftmost of overlapping ones."""

    def placed(parts: Column) -> Column:
        lengths = F.zip_with(parts["gaps"], parts["whole"], lambda g, m: (F.length(g) + F.coalesce(F.length(m), F.lit(0))).cast("long"))
        ends = F.slice(bind(lengths, running_sums), F.lit(1), F.size(parts["whole"]))
        found = F.zip_with(ends, F.arrays_zip(parts["whole"], parts["held"]), lambda e, m: F.struct(
            (e - F.length(m["whole"])).alias("start"), F.lit(rank).alias("rank"), e.alias("end"), F.lit(rule.kind).alias("kind"), F.length(m["held"]).alias("size")))
        return F.transform(F.filter(found, lambda s: s["size"] >= rule.least), lambda s: F.struct(
            s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))

    pattern = F.lit(rule.pattern)
    parts = F.struct(F.split(text, rule.pattern, -1).alias("gaps"), F.regexp_extract_all(text, pattern, 0).alias("whole"),
                     F.regexp_extract_all(text, pattern, rule.group).alias("held"))
    none = F.array().cast(f"array<{_SPAN}>")
    return F.when(F.rlike(text, pattern), bind(parts, placed).cast(f"array<{_SPAN}>")).otherwise(none)


def listed(found: Column) -> Column:
    """kind:start:end of spans by start, then rank, comma-joined."""
    return F.concat_ws(",", F.transform(F.array_sort(found), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def scanned(docs: DataFrame, key: str, text: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row: key and one array of spans per rule, named by its kind.

    A null text is an empty one and has none, as has a text that no rule
    matches. Repeated rows have equal spans; a null key is a key like others.
    """
    rows = docs.select(F.col(key).alias(key), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("row", F.xxhash64(key, "text"))
    # A row's hash serves the index only: rows that share one by chance are verified in vain.
    marked = rows.join(candidates(rows, rules), "row", "left")
    out = []
    for i, rule in enumerate(rules):
        found = spans(F.col("text"), rule, i)
        if trigram_query(rule.pattern) is not None:
            found = F.when(F.coalesce(F.array_contains("rules", i), F.lit(False)), found).otherwise(F.array().cast(f"array<{_SPAN}>"))
        out.append(found.alias(rule.kind))
    return marked.select(key, *out)
