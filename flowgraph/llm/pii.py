"""Personal data by a semi-Markov conditional random field over whole spans.

Fixed patterns give base spans (email, ip, card, phone) that always stay.  Around digits and at-signs a text has islands,
cut into tokens; every run of up to ``MAX_TOKENS`` tokens is a candidate segment whose features describe the whole span:
digit counts, group sizes, separators, checksum, octets, brackets, what stands before and after.  A dynamic program over
token borders picks the segments and kinds of an island together; tokens outside a segment score 0.  Text between islands
holds nothing that a segment may contain, so deciding each island decides the text.

The weights are learned by maximum likelihood (forward-backward over segments) from at most ``sample_islands`` islands in at
most ``sample_docs`` documents, chosen by a hash of their id; base spans are the truth there, so that strings which fail a
check count against their look.  Segments found beyond the base spans are added where they touch none.

A null or empty text has no spans; texts of any length are searched whole.  Of equally good segmentations the one with fewer
and earlier segments stands, of equally good kinds the first.  Repeated rows are searched each; an empty table gives an empty table and a model that
adds nothing.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgraph.llm.text import map_texts

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS = 20_000
SAMPLE_ISLANDS = 4_000
#: Tokens in the longest candidate segment: written-out addresses and numbers with every digit apart have fewer.
MAX_TOKENS = 40

LOCAL = "A-Za-z0-9._%+-"
EMAIL_TAIL = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_END = re.compile(rf"[{LOCAL}]*\Z")
#: Everything that an ip, card or phone span may consist of, from its first possible character on.
NUMBERS = re.compile(r"[0-9+][0-9+() .-]{6,}")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: An at-sign, or one in words, with what may belong to an address around it.
ADDRESS = re.compile(r"@|[\[({] ?at ?[\])}]", re.IGNORECASE)
TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|.", re.DOTALL)
CUES = re.compile(r"(e-?mail|mail|ip|host|addr|server|card|visa|credit|konto|phone|tel|call|fax|mobile)\W*\Z", re.IGNORECASE)


def luhn(digits: str) -> bool:
    doubled = digits[-2::-2].translate(str.maketrans("0123456789", "0246813579"))
    return (sum(map(int, digits[-1::-2])) + sum(map(int, doubled))) % 10 == 0


def _digits(span: str) -> str:
    return re.sub("[^0-9]", "", span)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the pattern matches that pass their check, by kind, then start."""
    found: list[tuple[int, int, int]] = []
    last, at = 0, text.find("@")
    while at >= 0:
        reach = 64
        while True:  # the whole run of address characters before the sign
            start = LOCAL_END.search(text, max(last, at - reach), at).start()
            if start > max(last, at - reach) or at - reach <= last:
                break
            reach *= 2
        tail = EMAIL_TAIL.match(text, at + 1) if start < at else None
        if tail:
            found.append((0, start, tail.end()))
            last = tail.end()
        at = text.find("@", max(at + 1, last))
    ips, cards, phones = [], [], []
    for run in NUMBERS.finditer(text):
        a, b = run.span()
        for m in IP.finditer(text, a, b):
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 and not p[:-4].strip("0") for p in m.group().split(".")):
                ips.append((1, *m.span()))
        for m in CARD.finditer(text, a, b):
            digits = _digits(m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                cards.append((2, *m.span()))
        for m in PHONE.finditer(text, a, b):
            if 8 <= len(_digits(m.group())) <= 15:
                phones.append((3, *m.span()))
    return found + ips + cards + phones


def _reach(text: str, at: int, step: int, marks: str) -> int:
    """Where the address characters (with one blank first) end that go on from ``at``, or ``MAX_TOKENS`` tokens of them."""
    kind, tokens, first = None, 0, True
    while True:
        c = text[at - 1 : at] if step < 0 else text[at : at + 1]
        if not (c and c.isascii() and (c.isalnum() or c in marks or (c == " " and first))):
            return at
        own = "0" if c.isdigit() else "a" if c.isalpha() else None
        tokens += own is None or own != kind
        if tokens > MAX_TOKENS:
            return at
        kind, first, at = own, False, at + step


def islands(text: str) -> list[tuple[int, int]]:
    """Parts of ``text`` where a segment may lie: number runs, and address characters around an at-sign."""
    parts = [m.span() for m in re.finditer(r"[0-9+(][0-9+() ./-]{5,}[0-9]", text)]
    for m in ADDRESS.finditer(text):
        parts.append((_reach(text, m.start(), -1, "._%+-"), _reach(text, m.end(), 1, "-.[](){}")))
    parts.sort()
    merged: list[tuple[int, int]] = []
    for a, b in parts:
        if merged and a < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


FEATURE_NAMES = (
    ["bias", "luhn", "octets", "octet_form", "plus", "at", "dotted", "brackets", "blank", "hyphen", "slash", "letters", "starts_digit",
     "ends_digit", "ends_letter", "whole_left", "whole_right", "cue", "one_group", "groups_of_four", "groups_of_three", "domain"]
    + [f"digits_{n}" for n in ("0", "1_7", "8_9", "10_11", "12_15", "16_19", "20")]
)
N_FEATURES = len(FEATURE_NAMES)


def span_features(text: str, start: int, end: int) -> np.ndarray:
    """0/1 description of the whole span."""
    span = text[start:end]
    digits = _digits(span)
    groups = re.findall("[0-9]+", span)
    octet_form = bool(re.fullmatch(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}", span))
    left, right = text[start - 1 : start], text[end : end + 1]
    n = len(digits)
    values = [
        True,
        16 <= n <= 19 and luhn(digits),
        octet_form and all(int(g) <= 255 for g in groups),
        octet_form,
        span[0] == "+",
        bool(ADDRESS.search(span, 1, len(span) - 1)),
        "." in span,
        "(" in span,
        " " in span,
        "-" in span,
        "/" in span,
        bool(re.search("[A-Za-z]", span)),
        span[0].isdigit(),
        span[-1].isdigit(),
        span[-1].isalpha(),
        not (left.isalnum() or left in tuple("+.-_%@")),
        not (right.isalnum() or right in tuple("-_@")),
        bool(CUES.search(text[max(0, start - 16) : start])),
        len(groups) == 1,
        len(groups) > 1 and all(len(g) == 4 for g in groups),
        len(groups) > 1 and all(len(g) in (3, 4) for g in groups),
        bool(re.search(r"[@\])}] ?[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+\Z", span)),
        n == 0, 1 <= n <= 7, 8 <= n <= 9, 10 <= n <= 11, 12 <= n <= 15, 16 <= n <= 19, n >= 20,
    ]
    return np.array(values, float)


def segments(text: str, start: int, end: int) -> tuple[list[int], list[tuple[int, int]], np.ndarray]:
    """(token borders, candidate segments by border numbers, their features) of an island."""
    borders = [start, *(m.end() for m in TOKEN.finditer(text, start, end))]
    spans, rows = [], []
    for i in range(len(borders) - 1):
        if text[borders[i]] in " .-)/":
            continue
        for j in range(i + 1, min(len(borders), i + MAX_TOKENS + 1)):
            last = text[borders[j] - 1]
            if last.isalnum() and borders[j] - borders[i] >= 6:
                spans.append((i, j))
                rows.append(span_features(text, borders[i], borders[j]))
    return borders, spans, np.array(rows).reshape(-1, N_FEATURES)


def decode(n: int, spans: list[tuple[int, int]], scores: np.ndarray) -> list[tuple[int, int, int]]:
    """Best segmentation of ``n`` tokens: (kind, first border, last border); ties go to fewer and earlier segments."""
    best, back = [0.0] * (n + 1), [None] * (n + 1)
    by_end: list[list[tuple[int, int]]] = [[] for _ in range(n + 1)]
    for row, (i, j) in enumerate(spans):
        by_end[j].append((i, row))
    for j in range(1, n + 1):
        best[j] = best[j - 1]
        for i, row in by_end[j]:
            kind = int(scores[row].argmax())
            way = best[i] + scores[row, kind]
            if way > best[j]:
                best[j], back[j] = way, (kind, i)
    out, j = [], n
    while j > 0:
        if back[j] is None:
            j -= 1
        else:
            kind, i = back[j]
            out.append((kind, i, j))
            j = i
    return out[::-1]


def _expected(n: int, spans: list[tuple[int, int]], scores: np.ndarray) -> np.ndarray:
    """Probability of each (segment, kind) under the field."""
    weight = np.exp(np.clip(scores, -50, 50))
    total = weight.sum(axis=1)
    ahead, behind = [1.0] + [0.0] * n, [0.0] * n + [1.0]
    by_end: list[list] = [[] for _ in range(n + 1)]
    by_start: list[list] = [[] for _ in range(n + 1)]
    for row, (i, j) in enumerate(spans):
        by_end[j].append((i, row))
        by_start[i].append((j, row))
    for j in range(1, n + 1):
        ahead[j] = ahead[j - 1] + sum(ahead[i] * total[r] for i, r in by_end[j])
    for i in range(n - 1, -1, -1):
        behind[i] = behind[i + 1] + sum(behind[j] * total[r] for j, r in by_start[i])
    outer = np.array([ahead[i] * behind[j] for i, j in spans]) / ahead[n]
    return weight * outer[:, None]


def fit(examples: list[tuple[str, list[tuple[int, int, int]]]], steps: int = 60, rate: float = 0.3, penalty: float = 1e-3) -> np.ndarray:
    """Weights by (feature, kind) from islands with the true (kind, start, end) spans in them."""
    cases = []
    for text, truth in examples:
        a, b = 16, len(text) - 1
        borders, spans, rows = segments(text, a, b)
        place = {x: i for i, x in enumerate(borders)}
        gold = np.zeros((len(spans), len(KINDS)))
        number = {s: i for i, s in enumerate(spans)}
        for kind, i, j in truth:
            row = number.get((place.get(i), place.get(j)))
            if row is not None:
                gold[row, kind] = 1
        if spans:
            cases.append((len(borders) - 1, spans, rows, gold))
    weights = np.zeros((N_FEATURES, len(KINDS)))
    weights[0] = -3.0
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    if not cases:
        return weights
    stacked = np.concatenate([c[2] for c in cases])
    gold = np.concatenate([c[3] for c in cases])
    ends = np.cumsum([0, *(len(c[1]) for c in cases)])
    for step in range(1, steps + 1):
        scores = stacked @ weights
        expected = np.concatenate([_expected(n, spans, scores[a:b]) for (n, spans, _, _), a, b in zip(cases, ends[:-1], ends[1:])])
        grad = stacked.T @ (expected - gold) / len(cases) + penalty * weights
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad * grad
        weights = weights - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return weights


def train(
    docs: DataFrame, id: str = "doc_id", text: str = "text", sample_docs: int = SAMPLE_DOCS, sample_islands: int = SAMPLE_ISLANDS
) -> np.ndarray:
    """Weights learned from a bounded sample of ``docs``."""
    named = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    n = max(1, named.count())
    draw = F.pmod(F.xxhash64("id", F.lit("pii")), F.lit(1 << 30)) / float(1 << 30)

    def make():
        def apply(texts):
            rows, parts, spans = [], [], []
            for row, whole in enumerate(texts.to_pylist()):
                cuts = islands(whole)
                known = base_spans(whole) if cuts else []
                for a, b in cuts:
                    if b - a > 400:
                        continue  # such runs are searched like all others, but teach nothing
                    before = whole[max(0, a - 16) : a].rjust(16)
                    rows.append(row)
                    parts.append(before + whole[a:b] + (whole[b : b + 1] or " "))
                    inside, taken = [], a
                    for kind, i, j in sorted((s for s in known if a <= s[1] and s[2] <= b), key=lambda s: (s[1], s[0])):
                        if i >= taken:
                            inside += [kind, i - a + 16, j - a + 16]
                            taken = j
                    spans.append(inside)
            return {None: np.array(rows, np.int64), "part": pa.array(parts, pa.string()), "spans": pa.array(spans, pa.list_(pa.int64()))}

        return apply

    fields = [T.StructField("part", T.StringType()), T.StructField("spans", T.ArrayType(T.LongType()))]
    found = map_texts(named.where(draw < sample_docs / n), "text", [], fields, make).distinct()
    found = found.orderBy(F.xxhash64("part"), "part").limit(sample_islands).collect()
    examples = [(r["part"], [tuple(r["spans"][i : i + 3]) for i in range(0, len(r["spans"]), 3)]) for r in found]
    return fit(examples)


def find_spans(text: str, weights: np.ndarray) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, all spans), each by kind, then start."""
    cuts = islands(text)
    base = base_spans(text)
    added = []
    for a, b in cuts:
        if any(i <= a and b <= j for _, i, j in base):
            continue
        borders, spans, rows = segments(text, a, b)
        if not spans:
            continue
        for kind, i, j in decode(len(borders) - 1, spans, rows @ weights):
            i, j = borders[i], borders[j]
            if all(j <= x or y <= i for _, x, y in base):
                added.append((kind, i, j))
    return base, sorted(base + added)


SPAN_TYPE = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def detect(docs: DataFrame, weights: np.ndarray, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, base, spans) of every row: arrays of (kind, start, end) in code points, by kind, then start."""

    def make():
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

        def column(lists):
            return pa.array([[{"kind": KINDS[k], "start": a, "end": b} for k, a, b in x] for x in lists], pa.list_(kind))

        def apply(texts):
            both = [find_spans(t, weights) for t in texts.to_pylist()]
            return {"base": column([b for b, _ in both]), "spans": column([s for _, s in both])}

        return apply

    return map_texts(docs, text, [id], [T.StructField("base", SPAN_TYPE), T.StructField("spans", SPAN_TYPE)], make)


def masked(text: str, weights: np.ndarray) -> str:
    """``text`` with every span replaced by its kind in angle brackets; of overlapping spans the first kind names all."""
    _, spans = find_spans(text, weights)
    merged: list[list] = []
    for kind, a, b in sorted(spans, key=lambda s: (s[1], s[0])):
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(b, merged[-1][2])
        else:
            merged.append([kind, a, b])
    out, last = [], 0
    for kind, a, b in merged:
        out += [text[last:a], f"<{KINDS[kind]}>"]
        last = b
    return "".join([*out, text[last:]])


def mask(docs: DataFrame, weights: np.ndarray, text: str = "text") -> DataFrame:
    """``docs``, all columns, with masked texts; a null text stays null."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(f"`{text}`").cast("string").alias("text"))

    def make():
        return lambda texts: {"masked": pa.array([masked(t, weights) for t in texts.to_pylist()], pa.string())}

    out = map_texts(rows, "text", ["row"], [T.StructField("masked", T.StringType())], make)
    columns = [
        F.when(F.col(f"row.`{c}`").isNotNull(), F.col("masked")).alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns
    ]
    return out.select(*columns)
