"""Packing token sequences into fixed windows by minimum bin slack.

Texts are tokenized and cut into full windows and one remainder each.  Only the counts of remainders by length (at most
``window`` - 1 numbers, however large the corpus) reach the driver, which plans there: the longest remaining length opens a
window, a bitset subset-sum over the multiset of remaining lengths finds the fullest sum that fits, the counts of that sum
are traced back, and the window is used as often as the counts allow before the next is planned.  Pieces then find their
place by their rank among equal lengths, which comes from one small aggregation.

A null text counts as empty and is the end token alone.  Repeated rows are packed each.  Ties go to the longer length.
An empty table gives an empty table.  Every sequence is gapless from 0; what a window lacks is padding at its end.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgraph.llm.text import map_texts
from flowgraph.session import materialize

#: Distinct parts whose ids a worker remembers before it starts afresh, and the longest of them (a cache, no limit on what
#: is tokenized).
CACHE = 150_000
CACHED_LENGTH = 64

PIECE_FIELDS = [
    T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("doc_tokens", T.LongType()),
    T.StructField("task", T.LongType()),
    T.StructField("rank", T.LongType()),
]

#: What a piece carries of its ids: a column and the function that makes it of (ids of all pieces, ends of each).
IDS = T.StructField("ids", T.ArrayType(T.IntegerType(), False))

_STATE: dict[str, object] = {}


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level tokenizers write for each byte."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in plain]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(other)}}


class _Encoder:
    """ids of white-space separated parts, which this kind of tokenizer handles one by one.

    Most parts are Latin letters with a few marks behind; their letters and their marks are tokenized apart, as the
    tokenizer's own splitting would, and letters go straight to its merges.
    """

    TAIL = ".,;:!?"

    def __init__(self, text: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(text)
        self.merges = self.tokenizer.model
        self.letters = _byte_letters()
        self.known: dict[str, bytes] = {}

    def _word(self, core: str) -> bytes:
        spelled = core if core.isascii() else core.encode().decode("latin-1").translate(self.letters)
        return np.array([t.id for t in self.merges.tokenize(spelled)], np.int32).tobytes()

    def _whole(self, part: str) -> bytes:
        return np.array(self.tokenizer.encode(part, add_special_tokens=False).ids, np.int32).tobytes()

    def ids(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all parts after each other, number of ids of each)."""
        known = self.known
        if len(known) > CACHE:
            known.clear()
        raw = []
        for part in parts:
            low = part.lower()
            core = low.rstrip(self.TAIL)
            if core.isalpha() and (core.isascii() or max(core) < "\u0250"):
                found = known.get(core)
                if found is None:
                    found = self._word(core)
                    if len(core) <= CACHED_LENGTH:
                        known[core] = found
                if len(core) < len(low):
                    tail = low[len(core) :]
                    end = known.get(tail)
                    if end is None:
                        end = self._whole(tail)
                        if len(tail) <= CACHED_LENGTH:
                            known[tail] = end
                    found = found + end
            else:
                found = known.get(part)
                if found is None:
                    found = self._whole(part)
                    if len(part) <= CACHED_LENGTH:
                        known[part] = found
            raw.append(found)
        sizes = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        return np.frombuffer(b"".join(raw), np.int32), sizes


def ids_list(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))


def ids_packed(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The ids of each piece compressed, first bytes of all numbers together, then the second ones, and so on."""
    planes = ids.astype("<i4").view(np.uint8).reshape(-1, 4)
    packed = [pa.compress(planes[a:b].T.tobytes(), "zstd", asbytes=True) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
    return pa.array(packed, pa.binary())


def ids_unpacked(packed: pa.Array, length: np.ndarray) -> pa.Array:
    """What ``ids_packed`` was made of, as lists; ``length`` holds their numbers of ids."""
    parts = []
    for data, n in zip(packed, length.tolist()):
        planes = np.frombuffer(pa.decompress(data.as_py(), 4 * n, "zstd", asbytes=True), np.uint8)
        parts.append(np.ascontiguousarray(planes.reshape(4, -1).T).view("<i4").ravel())
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    return ids_list(flat.astype(np.int32), np.concatenate([[0], np.cumsum(length)]))


def ids_crc32(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """crc32 of each piece's ids as unsigned little-endian 32-bit numbers."""
    raw = memoryview(ids.astype("<u4").tobytes())
    return pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())], pa.int64())


def cut(
    docs: DataFrame, tokenizer: str, end_id: int, window: int, id: str = "doc_id", text: str = "text",
    carry: T.StructField = IDS, carried: Callable[[np.ndarray, np.ndarray], pa.Array] = ids_list,
) -> DataFrame:
    """Pieces of every document: (id, start, length, doc_tokens, task, rank, ids).

    ``tokenizer`` is the tokenizer's JSON.  ``rank`` counts the task's earlier pieces of the same length.  In place of the
    ids a piece may carry whatever ``carried`` makes of them.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def make():
        from pyspark import TaskContext

        key = str(hash(shared.value))
        if key not in _STATE:
            _STATE.clear()
            _STATE[key] = _Encoder(shared.value)
        encoder: _Encoder = _STATE[key]
        task = TaskContext.get().partitionId()
        seen = np.zeros(window + 1, np.int64)

        def apply(texts):
            split = pc.ascii_split_whitespace(texts)
            ends = split.offsets.to_numpy().astype(np.int64)
            coded = split.values.slice(ends[0], ends[-1] - ends[0]).dictionary_encode()
            ends -= ends[0]
            codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            flat, sizes = encoder.ids(coded.dictionary.to_pylist())
            firsts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
            # The ids of all parts in text order, with one place after each document for its end.
            each = sizes[codes]
            where = np.concatenate([[0], np.cumsum(each)])
            doc = where[ends[1:]] - where[ends[:-1]] + 1
            begins = np.concatenate([[0], np.cumsum(doc)])
            out = np.full(begins[-1], end_id, np.int32)
            of_doc = np.repeat(np.arange(len(doc)), np.diff(ends))
            places = np.arange(where[-1]) + np.repeat(of_doc, each)
            out[places] = flat[np.arange(where[-1]) + np.repeat(firsts[codes] - where[:-1], each)]
            n = -(-doc // window)
            rows = np.repeat(np.arange(len(doc)), n)
            start = (np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)) * window
            length = np.minimum(doc[rows] - start, window)
            rank = np.empty(len(rows), np.int64)
            order = np.argsort(length, kind="stable")
            values, first, count = np.unique(length[order], return_index=True, return_counts=True)
            rank[order] = np.arange(len(rows)) - np.repeat(first, count) + np.repeat(seen[values], count)
            seen[values] += count
            piece_ends = np.concatenate([[0], np.cumsum(length)])
            return {
                None: rows,
                "start": start,
                "length": length,
                "doc_tokens": doc[rows],
                "task": np.full(len(rows), task, np.int64),
                "rank": rank,
                carry.name: carried(out, piece_ends),
            }

        return apply

    return map_texts(docs, text, [id], [*PIECE_FIELDS, carry], make)


def fullest(counts: dict[int, int], first: int, window: int) -> dict[int, int]:
    """Counts by length, ``first`` among them, whose sum is the greatest that fits ``window``.

    A bit s of ``reached`` says that some multiset of the lengths so far sums to s.  A length with count c is added in
    doubling steps; the bits before every step are kept, so the chosen counts can be traced back.
    """
    room = window - first
    mask = (1 << (room + 1)) - 1
    reached, steps = 1, []
    for length in sorted((v for v in counts if v <= room), reverse=True):
        left = min(counts[length] - (length == first), room // length)
        times = 1
        while left > 0:
            take = min(times, left)
            steps.append((length, take, reached))
            reached |= (reached << (length * take)) & mask
            left -= take
            times *= 2
        if reached >> room & 1:
            break
    total = reached.bit_length() - 1
    chosen = {first: 1}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            total -= length * take
            chosen[length] = chosen.get(length, 0) + take
    return chosen


def plan(counts: dict[int, int], window: int) -> list[tuple[int, dict[int, int]]]:
    """(number of equal sequences, counts by length in each), using up ``counts``.

    Every step leaves at most half of the count of one length, so the steps are far fewer than the pieces and grow with
    the logarithm of the counts.
    """
    left, out = dict(counts), []
    while left:
        chosen = fullest(left, max(left), window)
        times = min(left[v] // n for v, n in chosen.items())
        out.append((times, chosen))
        for v, n in chosen.items():
            left[v] -= n * times
            if not left[v]:
                del left[v]
    return out


def _table(plans: list[tuple[int, dict[int, int]]], window: int) -> dict[str, np.ndarray]:
    """Rows (length, first rank, copies in a sequence, first sequence, offset in it), sorted by length and rank."""
    rows, used, sequence = [], {}, 0
    for times, chosen in plans:
        offset = 0
        for length in sorted(chosen, reverse=True):
            n = chosen[length]
            rows.append((length, used.get(length, 0), n, sequence, offset))
            used[length] = used.get(length, 0) + n * times
            offset += n * length
        sequence += times
    rows.sort()
    cols = np.array(rows, np.int64).reshape(-1, 5).T
    return dict(zip(("length", "rank", "copies", "sequence", "offset"), cols))


def place(pieces: DataFrame, window: int, packed: bool = False) -> DataFrame:
    """``pieces`` (with length, task and rank) with sequence_id and offset in place of task and rank.

    Ids that are ``packed`` are moved as they are and unpacked at the end.
    """
    per_task = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = _table(plan(counts, window), window)
    shared = pieces.sparkSession.sparkContext.broadcast(table)
    schema = T.StructType([IDS if packed and f.name == IDS.name else f for f in pieces.schema if f.name not in ("task", "rank")])
    schema = schema.add("sequence_id", "long").add("offset", "long")
    ranked = pieces.join(bases, ["length", "task"]).select(
        *(f.name for f in schema.fields[:-2]), (F.col("rank") + F.col("base")).alias("rank")
    )

    def run(batches):
        t = shared.value
        # Ranks of one length stay below 2^50, so length and rank make one sorted key.
        keys = (t["length"] << 50) + t["rank"]
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            row = np.searchsorted(keys, (length << 50) + rank, side="right") - 1
            copy = rank - t["rank"][row]
            sequence = t["sequence"][row] + copy // t["copies"][row]
            offset = t["offset"][row] + copy % t["copies"][row] * length
            columns = [batch.column(f.name) for f in schema.fields[:-2]]
            if packed:
                columns = [ids_unpacked(c, length) if f.name == IDS.name else c for f, c in zip(schema.fields, columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], schema.names)

    return ranked.mapInArrow(run, schema)


def pack(
    docs: DataFrame, tokenizer: str, end_id: int, window: int = 4096, id: str = "doc_id", text: str = "text",
    carry: T.StructField = IDS, carried: Callable[[np.ndarray, np.ndarray], pa.Array] = ids_list,
) -> DataFrame:
    """Pieces and their places: (id, start, length, doc_tokens, ids, sequence_id, offset).

    The pieces are written once, with what they carry, before their lengths are counted; ids are compressed meanwhile.
    """
    packed = carry == IDS
    if packed:
        carry, carried = T.StructField(IDS.name, T.BinaryType()), ids_packed
    return place(materialize(cut(docs, tokenizer, end_id, window, id, text, carry, carried), "pieces"), window, packed)
