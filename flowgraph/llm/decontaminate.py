"""Documents that hold a benchmark item, up to a budget of edits: pigeonhole pieces and Myers' bit-parallel distance.

Both sides are lower-cased (A-Z) with runs of white space as one blank.  An item of n characters may differ by
k = floor(``rate`` * n) edits; cut into k + 1 pieces, one of them must occur unchanged.  An Aho-Corasick automaton finds the
pieces of all items in one pass over a text, and each window around hits is verified by bit-parallel distance.

Items are sent to the tasks in shards of about ``SHARD_BYTES``; more items make more passes, not larger ones.

Null or empty items and texts match nothing.  Equal items are reported each, repeated rows too.  Of several occurrences the
one with the fewest edits counts, then the leftmost end.  An empty table on either side gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgraph.llm.text import map_texts

#: Edits allowed for each character of an item.
RATE = 0.08
#: Benchmark text in one automaton.
SHARD_BYTES = 1 << 20

HIT_FIELDS = [
    T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()),
    T.StructField("distance", T.LongType()),
    T.StructField("budget", T.LongType()),
]


def normal_form(texts: pa.Array) -> pa.Array:
    words = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(texts)))
    return pc.binary_join(words, " ")


def occurrence(pattern: str, text: str) -> tuple[int, int]:
    """(fewest edits between ``pattern`` and a part of ``text``, end of the first such part)."""
    size = len(pattern)
    full, top = (1 << size) - 1, 1 << (size - 1)
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    plus, minus, score, best, end = full, 0, size, size, 0
    for j, c in enumerate(text):
        equal = masks.get(c, 0)
        vertical = equal | minus
        horizontal = (((equal & plus) + plus) ^ plus) | equal
        up, down = minus | (full & ~(horizontal | plus)), plus & horizontal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
            if score < best:
                best, end = score, j + 1
        up, down = up << 1 & full, down << 1 & full
        plus, minus = down | (full & ~(vertical | up)), up & vertical
    return best, end


def _part_start(pattern: str, text: str, edits: int) -> int:
    """Start of the longest-matched part that ends with ``text`` and lies within ``edits`` of ``pattern``."""
    distance = list(range(len(pattern) + 1))
    back, best = pattern[::-1], (len(pattern), 0)
    for j, c in enumerate(text[::-1][: len(pattern) + edits], 1):
        before, distance[0] = distance[0], j
        for i, p in enumerate(back, 1):
            before, distance[i] = distance[i], min(distance[i] + 1, distance[i - 1] + 1, before + (p != c))
        best = min(best, (distance[-1], j))
    return len(text) - best[1]


class PieceIndex:
    """Items of one shard with the automaton over their pieces."""

    def __init__(self, items: list[tuple[object, str]], rate: float):
        self.items = [(key, text, int(len(text) * rate)) for key, text in items if text]
        at: dict[str, list[tuple[int, int]]] = {}
        for i, (_, text, edits) in enumerate(self.items):
            cuts = np.linspace(0, len(text), min(edits + 1, len(text)) + 1).astype(int)
            for a, b in zip(cuts[:-1], cuts[1:]):
                at.setdefault(text[a:b], []).append((i, int(b)))
        self.pieces = ahocorasick.Automaton()
        for piece, where in at.items():
            self.pieces.add_word(piece, where)
        if at:
            self.pieces.make_automaton()
        self.empty = not at

    def find(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """(item, start, end, distance) in ``text`` for each item within its budget."""
        if self.empty:
            return
        starts: dict[int, set[int]] = {}
        for last, where in self.pieces.iter(text):
            for item, offset in where:
                starts.setdefault(item, set()).add(last + 1 - offset)
        for item in sorted(starts):
            _, pattern, edits = self.items[item]
            at = text.find(pattern)
            if at >= 0:
                yield item, at, at + len(pattern), 0
                continue
            best = None
            low = high = None
            for start in [*sorted(starts[item]), None]:
                if low is not None and (start is None or start - high > 2 * edits + len(pattern)):
                    a, b = max(0, low - edits), min(len(text), high + len(pattern) + edits)
                    distance, end = occurrence(pattern, text[a:b])
                    if distance <= edits and (best is None or distance < best[0]):
                        best = (distance, a + end)
                    low = None
                if start is not None:
                    low, high = (start, start) if low is None else (low, start)
            if best is not None:
                distance, end = best
                a = max(0, end - len(pattern) - edits)
                yield item, a + _part_start(pattern, text[a:end], edits), end, distance


def _original_places(text: str) -> np.ndarray:
    """Place in ``text`` of each character of its normal form, and of its end."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    blank = (codes == 32) | ((codes >= 9) & (codes <= 13))
    words = np.flatnonzero(~blank)
    if not len(words):
        return np.zeros(1, np.int64)
    inside = np.zeros(len(codes), bool)
    inside[words[0] : words[-1] + 1] = True
    first_blank = blank & inside & ~np.concatenate([[False], blank[:-1]])
    places = np.flatnonzero((~blank & inside) | first_blank)
    return np.append(places, places[-1] + 1)


def shards(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", shard_bytes: int = SHARD_BYTES) -> Iterator[list]:
    """(item, normal text) lists of about ``shard_bytes`` each, which together are all items."""
    named = benchmark.select(F.col(f"`{item_id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text")).where("text is not null")
    total = named.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    n = max(1, -(-total // shard_bytes))
    for shard in range(n):
        rows = named.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == shard).collect()
        texts = normal_form(pa.array([r["text"] for r in rows], pa.string())).to_pylist()
        yield sorted(zip((r["id"] for r in rows), texts), key=lambda x: (x[1], str(x[0])))


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id", rate: float = RATE
) -> DataFrame:
    """(id, item id, start, end, distance, budget) of every document row and item it holds; places in code points."""
    out = None
    item_field = T.StructField(item_id if item_id != id else "item", benchmark.schema[item_id].dataType)
    for items in shards(benchmark, item_id):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def make(shared=shared):
            index = PieceIndex(shared.value, rate)

            def apply(texts):
                rows, found = [], []
                for row, normal in enumerate(normal_form(texts).to_pylist()):
                    places = None
                    for item, a, b, distance in index.find(normal):
                        if places is None:
                            places = _original_places(texts[row].as_py())
                        key, _, edits = index.items[item]
                        rows.append(row)
                        found.append((key, int(places[a]), int(places[b - 1]) + 1, distance, edits))
                columns = list(zip(*found)) if found else [()] * 5
                out = {f.name: pa.array(c, pa.int64()) for f, c in zip(HIT_FIELDS, columns[1:])}
                return {None: np.array(rows, np.int64), item_field.name: pa.array(columns[0], _arrow(item_field)), **out}

            return apply

        part = map_texts(docs, text, [id], [item_field, *HIT_FIELDS], make)
        out = part if out is None else out.union(part)
    return out


def _arrow(field: T.StructField) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(field.dataType)


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", rate: float = RATE) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item."""
    names = docs.columns
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), F.col(f"`{text}`").alias("text"))
    for items in shards(benchmark, item_id):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def make(shared=shared):
            index = PieceIndex(shared.value, rate)

            def apply(texts):
                return {"leaks": np.array([next(index.find(t), None) is not None for t in normal_form(texts).to_pylist()], bool)}

            return apply

        rows = map_texts(rows, "text", ["row", "text"], [T.StructField("leaks", T.BooleanType())], make).where(~F.col("leaks")).drop("leaks")
    return rows.select("row.*")
