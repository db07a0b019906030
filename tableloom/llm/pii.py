"""Personal data: fixed rules, and a character tagger trained on labelled spans.

The tagger (a bidirectional LSTM with CRF transitions) learns from spans that the
rules label in a bounded sample, and from phone numbers as they are written at home
(``HOME_FORMS``), which the rules don't know, planted in that sample's texts beside
dates, ISBNs, amounts and other numbers that are nobody's (``OTHER_NUMBERS``). Its
phone numbers must pass ``phone_like``. A text is read in windows of ``WINDOW`` characters, one
every half window. Every kind of span has a digit or an @, and so a window
without either is all outside by definition and isn't decoded. Spans that touch
an edge inside the text are left to the next window. The windows' spans are
reconciled over the whole text: those overlapping a rule's span give way, and of
others that overlap the longer stays, the left one of equals.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableloom.llm.common import byte_set, pieces, text_bytes
from tableloom.llm.tagger import Tagger

KINDS = ("email", "ip", "card", "phone")
WINDOW, DECODED = 96, 512
#: Bounds of the training sample: texts, bytes of a text, windows; steps of training.
TEXTS, TEXT_BYTES, WINDOWS, STEPS = 800, 1 << 14, 6000, 300
#: Windows with planted numbers, at least and for each rule's span.
PLANTED = 600

#: Fixed forms, d a digit and n one but zero: phone numbers without a plus, and numbers that only look like them.
HOME_FORMS = ("(0dd) ddd dddd", "0dd dddd dddd", "0ddd ddd ddd", "nnd-ddd-dddd", "nnd.ddd.dddd", "(nnd) ddd-dddd", "00nd ddd ddd dddd", "0nd/ddddddd",
              "0n dd dd dd dd", "0nd-ddd dd dd", "0ndd dddddd", "1-nnd-ddd-dddd", "(nnd) ddd dddd", "0ndd/ddd ddd")
OTHER_NUMBERS = ("20dd-0n-1d 1d:dd", "20dd-0n-1d", "1n.0n.20dd", "0n/1n/19dd", "978-n-dd-dddddd-d", "979-dd-ddd-dddd-d", "n,ddd,ddd,ddd", "n.ddd.ddd,dd", "nddddddddd",
                 "nddd nddd", "vn.d.d", "#ndddddd", "ndd", "n.dddd", "nd:dd:dd", "20dd 20dd 20dd", "nd x nd x nd", "n-nd", "nd, nd, nd", "nddd-dd", "nd nd nd nd", "$nd,ddd.dd",
                 "19dd-20dd", "1n.0n.20dd 1d:dd", "0.ddddddddd", "nddddd/20dd")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    """Check digit of a card number."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def valid(kind: str, text: str) -> bool:
    """What a span of a kind must meet beyond its form."""
    if kind == "email":
        name, _, domain = text.partition("@")
        return bool(name) and _LOCAL.issuperset(name) and _DOMAIN.fullmatch(domain) is not None
    if kind == "ip":
        return bool(re.fullmatch(r"[0-9]+(?:\.[0-9]+){3}", text)) and all(
            len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))
    n = _digits(text)
    if kind == "card":
        return 12 <= len(n) <= 19 and luhn(n)
    return 9 <= len(n) <= 15 and not text.isdigit()


#: Fixed forms: groups of digits joined by the signs of a phone number; a date in either order; thousands.
_HOME = re.compile(r"\+?\(?[0-9]{1,7}\)?(?:[ ./-]{1,2}\(?[0-9]{1,8}\)?){1,6}")
_DATE = re.compile(r"(?<![0-9])(?:(?:19|20)[0-9]{2}[-./ ][01]?[0-9][-./ ][0-3]?[0-9]|[0-3]?[0-9][-./ ][0-3]?[0-9][-./ ](?:19|20)[0-9]{2})(?![0-9])")
_THOUSANDS = re.compile(r"[0-9]{1,3}(?:[.][0-9]{3}){2,}|[0-9]{1,3}(?: [0-9]{3}){2,}")
_YEARS = re.compile(r"(?:(?:19|20)[0-9]{2}[ -/]?)+")


def isbn(text: str) -> bool:
    """An ISBN by its form and check digit; of ten digits only where it is written in groups of three or four joined alike."""
    n = _digits(text)
    if len(n) == 13 and n.startswith(("978", "979")):
        return sum(int(c) * (1 + 2 * (i % 2)) for i, c in enumerate(n)) % 10 == 0 or text.count("-") == 4
    return len(n) == 10 and text.count("-") == 3 and sum(int(c) * (10 - i) for i, c in enumerate(n)) % 11 == 0


def phone_like(text: str, start: int, end: int) -> bool:
    """Whether a tagged span may be a phone number: 9 to 15 digits in groups, and no date, ISBN, amount or part of a longer number."""
    span = text[start:end]
    if not valid("phone", span) or not _HOME.fullmatch(span):
        return False
    if _DATE.search(span) or isbn(span) or _YEARS.fullmatch(span) or (_THOUSANDS.fullmatch(span) and span[0] != "0"):
        return False
    near = text[max(0, start - 2): start], text[end: end + 2]
    return not re.search(r"[0-9A-Za-z$€£#@][ ]?$" if near[0][-1:] != " " else r"[0-9$€£#] $", near[0]) and not re.match(r"[A-Za-z@]|[.,:/-]?[0-9]", near[1])


def _emails(text: str) -> list[tuple[int, int]]:
    """Matches of name@domain from left to right, in one pass whatever the length of a name."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((start, found.end()))
            free = found.end()
        else:
            free = at + 1
        at = text.find("@", free)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, rank of the kind, end) of the rules' matches, sorted. The rules' fixed forms: name@domain; four numbers up to
    255 joined by points; 12 to 19 digits in step with their check digit; a plus and 9 to 15 digits."""
    out = [(a, 0, b) for a, b in _emails(text)]
    for rank, form in ((1, _IP), (2, _CARD), (3, _PHONE)):
        if rank != 3 or "+" in text:
            out += [(m.start(), rank, m.end()) for m in form.finditer(text) if valid(KINDS[rank], m.group())]
    return sorted(out)


SYMBOLS = 129
_PAD, _WIDE = 0, 128


def _symbols(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return np.where(points < 127, points + 1, _WIDE).astype(np.int64)


def _window(symbols: np.ndarray, start: int) -> np.ndarray:
    out = np.full(WINDOW, _PAD, np.int64)
    part = symbols[max(start, 0): start + WINDOW]
    out[max(-start, 0): max(-start, 0) + len(part)] = part
    return out


def _number(r: np.random.Generator, form: str) -> str:
    return "".join(str(r.integers(0, 10)) if c == "d" else str(r.integers(1, 10)) if c == "n" else c for c in form)


def _with_planted(r: np.random.Generator, text: str) -> tuple[str, list[tuple[int, int, int]]]:
    """A piece of a text with a number planted at a space, and the spans of its personal data."""
    at = int(r.integers(0, max(1, len(text) - 3 * WINDOW)))
    part = text[at: at + 3 * WINDOW]
    space = part.find(" ", int(r.integers(0, max(1, len(part)))))
    space = len(part) if space < 0 else space + 1
    home = r.random() < 0.6
    number = _number(r, str(r.choice(HOME_FORMS if home else OTHER_NUMBERS)))
    cue = str(r.choice(["Tel. ", "call ", "Phone: ", "fax ", "tel:"])) if r.random() < (0.4 if home else 0.05) else ""
    tail = str(r.choice([" ", ", ", ". ", "; ", ") ", "\n"]))
    whole = part[:space] + cue + number + tail + part[space:]
    start = space + len(cue)
    planted = [(start, 3, start + len(number))] if home else []
    others = [s for s in base_spans(whole) if s[2] <= start or s[0] >= start + len(number)]
    return whole, sorted(planted + others)


def train(texts: list[str], seed: int = 5) -> Tagger | None:
    """A tagger from the rules' spans in these texts and from numbers planted in them; None without texts."""
    r = np.random.default_rng(seed)
    x, y, plain = [], [], []

    def add(text: str, spans: list[tuple[int, int, int]], low: int) -> None:
        tags = np.zeros(WINDOW, np.int64)
        for a, k, b in spans:
            if a < low + WINDOW and b > low:
                tags[max(a, low) - low: b - low] = 2 + 2 * k
                if a >= low:
                    tags[a - low] = 1 + 2 * k
        x.append(_window(_symbols(text[max(low, 0): low + WINDOW]), min(low, 0)))
        y.append(tags)

    for text in texts:
        spans = base_spans(text)
        for start, _, _ in spans:
            add(text, spans, start - int(r.integers(4, WINDOW - 44)))
        for m in re.finditer(r"[0-9@]+", text):
            if all(m.end() <= a or m.start() >= b for a, _, b in spans[:50]):
                low = m.start() - int(r.integers(4, WINDOW - 8))
                if all(low + WINDOW <= a or low >= b for a, _, b in spans):
                    plain.append((text, low))
    if not texts:
        return None
    for i in r.permutation(len(plain))[: max(64, len(x) // 2)]:
        add(plain[i][0], [], plain[i][1])
    for _ in range(max(PLANTED, len(x))):
        whole, spans = _with_planted(r, texts[int(r.integers(0, len(texts)))])
        start = next((a for a, k, _ in spans if k == 3), None)
        start = int(r.integers(0, max(1, len(whole)))) if start is None else start
        add(whole, spans, start - int(r.integers(4, WINDOW - 30)))
    order = r.permutation(len(x))[:WINDOWS]
    tagger = Tagger(SYMBOLS, 1 + 2 * len(KINDS))
    tagger.train(np.stack(x)[order], np.stack(y)[order], STEPS)
    return tagger


def training_sample(docs: DataFrame, key: str, text: str) -> list[str]:
    """About ``TEXTS`` texts with a digit or an @, chosen by hash; longer ones than ``TEXT_BYTES`` aren't used to train."""
    rows = docs.select(F.col(text).alias("t"), F.xxhash64(key, text).alias("h")).filter(
        (F.octet_length("t") <= TEXT_BYTES) & F.rlike("t", F.lit(r"[0-9][ ().-]?[0-9]|@")))
    n = rows.count()
    chosen = rows.filter(F.pmod("h", F.lit(1 << 30)) < (1 << 30) * min(1.0, TEXTS / max(n, 1)))
    return [r["t"] for r in chosen.orderBy("h", "t").select("t").limit(2 * TEXTS).collect()]


_TRIGGER = byte_set((0x30, 0x39), (0x40, 0x40))


def _reconciled(base: list[tuple[int, int, int]], found: set[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of the tagger that overlap neither a rule's span nor a longer one of their own, the left one of equals.

    Both sides are kept as disjoint stretches in order, so each span looks at one neighbour on either side.
    """
    rules: list[list[int]] = []
    for a, _, b in sorted(base):
        if rules and a < rules[-1][1]:
            rules[-1][1] = max(rules[-1][1], b)
        else:
            rules.append([a, b])
    fixed, own, out = [tuple(r) for r in rules], [], []

    def free(taken: list[tuple[int, int]], a: int, b: int) -> bool:
        at = bisect_left(taken, (b,))
        return not at or taken[at - 1][1] <= a

    for a, k, b in sorted(found, key=lambda s: (s[0] - s[2], s)):
        if free(fixed, a, b) and free(own, a, b):
            insort(own, (a, b))
            out.append((a, k, b))
    return sorted(out)


def _finder(tagger: Tagger | None):
    kind = pa.struct([("start", pa.int64()), ("rank", pa.int32()), ("end", pa.int64()), ("kind", pa.string()), ("base", pa.bool_())])

    def find(column: pa.Array) -> pa.Array:
        data, offsets = text_bytes(column)
        spans: list[list[dict]] = [[] for _ in range(len(column))]
        for low, high in pieces(offsets):
            at = np.flatnonzero(_TRIGGER[data[offsets[low]: offsets[high]]]) + offsets[low]
            rows = np.unique(np.searchsorted(offsets, at, "right") - 1)
            windows, owner, start, texts, symbols, base = [], [], [], {}, {}, {}
            for r in rows.tolist():
                text = texts[r] = data[offsets[r]: offsets[r + 1]].tobytes().decode()
                base[r] = base_spans(text)
                if tagger is None:
                    continue
                own = symbols[r] = _symbols(text)
                sign = np.flatnonzero(((own >= 49) & (own <= 58)) | (own == 65))
                half = WINDOW // 2
                for k in np.unique(np.concatenate([sign // half, sign // half - 1])).tolist():
                    if k >= 0 or len(own) < half:
                        windows.append(_window(own, max(k, 0) * half))
                        owner.append(r)
                        start.append(max(k, 0) * half)
            found: dict[int, set] = {r: set() for r in rows.tolist()}
            for k in range(0, len(windows), DECODED):
                tags = tagger.decode(np.stack(windows[k: k + DECODED]))
                for i, j in zip(*np.nonzero(tags % 2 == 1)):
                    tag, end = tags[i, j], j + 1
                    while end < WINDOW and tags[i, end] == tag + 1:
                        end += 1
                    r, a, b = owner[k + i], start[k + i] + int(j), start[k + i] + int(end)
                    inner_left, inner_right = j > 0 or a == 0, end < WINDOW or b >= len(texts[r])
                    name = KINDS[tag // 2]
                    if inner_left and inner_right and (phone_like(texts[r], a, b) if name == "phone" else valid(name, texts[r][a:b])):
                        found[r].add((a, int(tag // 2), b))
            for r in rows.tolist():
                both = [(*s, True) for s in base[r]] + [(*s, False) for s in _reconciled(base[r], found[r])]
                spans[r] = [{"start": a, "rank": k, "end": b, "kind": KINDS[k], "base": own} for a, k, b, own in sorted(both)]
        return pa.array(spans, pa.list_(kind))

    return find


def spans(text: Column, tagger: Tagger | None) -> Column:
    """Array of (start, rank, end, kind, base) of personal data in a text, sorted; code points, end exclusive.

    A null or empty text has none, equal texts have equal spans, an empty table gives no
    rows and other columns stay as they are. Without a tagger (nothing to learn from) only
    the rules' spans are found.
    """
    found = F.arrow_udf(_finder(tagger), "array<struct<start: long, rank: int, end: long, kind: string, base: boolean>>")
    return found(F.coalesce(text, F.lit("")))


def masked(text: Column, found: Column) -> Column:
    """The text with each span replaced by its kind in angle brackets; of overlapping spans the first one's start and the
    last one's end count."""
    step = lambda acc, s: F.when(s["start"] < acc["at"], F.struct(
        acc["out"].alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))).otherwise(F.struct(
            F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit("<"), s["kind"], F.lit(">")).alias("out"),
            s["end"].alias("at")))
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    whole = F.aggregate(found, start, step, lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))
    return F.when(F.size(found) > 0, whole).otherwise(text)
