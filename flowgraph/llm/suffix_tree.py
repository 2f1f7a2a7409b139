"""Language model scores by a probabilistic suffix tree over words.

A text is its words (A-Z lower-cased) and one end.  The root gives every token log10((count + 1) / (N + V + 1)), all unknown
tokens being one symbol.  A context is the last 1 to ``DEPTH`` tokens (a text's start included), if it occurs ``LEAST`` times;
it is retained if its next-token distribution diverges from that of its suffix by more than its description costs.  A context
names the next tokens that follow it ``LEAST`` times, and leaves the rest of its mass to its suffix, in proportion.  A token is
scored by the longest retained context before it.  ``LEAST`` is the same for every corpus, so the tree grows with the corpus;
it is held in the table of replies, never on the driver.

Texts become blocks, written once in buckets.  In each turn a block asks for the counts of its sequences of 1, then 2, up to
``DEPTH`` + 1 tokens, if their context and suffix occur ``LEAST`` times, as those of any sequence that does.  From the third turn on
it also asks what its contexts of 1, then 2, up to ``DEPTH`` tokens leave to their suffixes; for that, one of the blocks that hold
a pair of context and next token hands on the pair's count and its probability after the suffix, which the turns before have
settled.  What is asked is dealt into buckets by hash, shuffled as one row of packed arrays for each block and bucket, and
answered in one task a bucket.  The replies are added to a table in the same buckets of blocks, so that neither is moved or
written again.  Words and sequences are named by 64-bit hashes.

A null or empty text is the end alone.  Without training texts every probability of the root is 1.  Repeated rows are
counted and scored each; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgraph.llm.text import slices, small_batches, split_words
from flowgraph.session import Scratch

DEPTH = 3
#: Times that a context, and a next token together with it, must occur in the training texts.
LEAST = 2
#: Weight, in counts, of the suffix's distribution in a context's.
SMOOTHING = 1.0
#: Text in one block, and text for each bucket of what is asked: every block asks every bucket, so both are as large as a task can hold.
BLOCK_BYTES = 6 << 20
BUCKET_BYTES = 16 << 20
#: Names of a text's end and start; 0 names nothing.
END, START = np.uint64(0xD1B54A32D192ED03), np.uint64(0x8CB92BA72F3D8DD7)


def _squeezed(x: np.ndarray) -> bytes:
    """The array compressed, first bytes of all numbers together, then the second ones, and so on; without the last bytes that are 0 in all."""
    if not len(x):
        return b""
    width = x.dtype.itemsize if x.dtype.kind == "f" else max(1, -(-int(x.max()).bit_length() // 8))
    rows = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1)
    planes = np.empty((width, len(x)), np.uint8)
    for at in range(width):
        planes[at] = rows[:, at]
    return planes.size.to_bytes(8, "little") + bytes([width]) + pa.compress(planes, "zstd", asbytes=True)


def _unsqueezed(data: bytes, kind) -> np.ndarray:
    kind = np.dtype(kind)
    if not data:
        return np.zeros(0, kind)
    size, width = int.from_bytes(data[:8], "little"), data[8]
    planes = np.frombuffer(pa.decompress(memoryview(data)[9:], size, "zstd"), np.uint8).reshape(width, -1)
    rows = np.zeros((planes.shape[1], kind.itemsize), np.uint8)
    for at in range(width):
        rows[:, at] = planes[at]
    return rows.view(kind).ravel()


def _read(column, row: int, kind) -> np.ndarray:
    return _unsqueezed(column[row].as_py(), kind)


def _read_names(column, row: int) -> np.ndarray:
    """Ascending names; their steps are written, which are smaller."""
    return np.cumsum(_read(column, row, np.uint64), dtype=np.uint64)


#: What a block asks of a bucket: ascending names of sequences with their counts in it; ascending names of contexts with their
#: counts, the number of pairs it hands on of each, and those pairs' counts and probabilities after the context's suffix.
ASKED = ["names", "n", "contexts", "totals", "entries", "pair_n", "pair_p"]
PACK = T.StructType().add("bucket", "long")
for _column in ASKED:
    PACK = PACK.add(_column, "binary")
REPLY = "block long, turn int, bucket long, data binary, left binary, distinct long"


def _packed(names, n, contexts, totals, entries, pair_n, pair_p, buckets: int) -> pa.Array:
    """What each bucket is asked, as a list of a single row; names ascend, and so do their buckets."""
    of = [(x >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32) for x in (names, contexts)]
    found = np.unique(np.concatenate(of))
    ranges = [[np.searchsorted(x, found, side) for side in ("left", "right")] for x in of]
    pairs = np.concatenate([[0], np.cumsum(entries)])
    steps = []
    for x, (first, stop) in zip((names, contexts), ranges):
        step, first = np.diff(x, prepend=np.uint64(0)), first[first < stop]
        step[first] = x[first]
        steps.append(step)
    columns = [[] for _ in ASKED]
    for a, b, c, d in zip(*(x.tolist() for r in ranges for x in r)):
        paired = slice(int(pairs[c]), int(pairs[d]))
        for column, x in zip(columns, (steps[0][a:b], n[a:b], steps[1][c:d], totals[c:d], entries[c:d], pair_n[paired], pair_p[paired])):
            column.append(_squeezed(x))
    arrays = [pa.array(found.astype(np.int64)), *(pa.array(x, pa.binary()) for x in columns)]
    structs = pa.StructArray.from_arrays(arrays, PACK.names)
    return pa.ListArray.from_arrays(pa.array([0, len(found)], pa.int32()), structs)


def _joined(replies: pa.Table, turn: int, column: str, kind) -> np.ndarray:
    """Replies of all buckets to what one block asked in a turn, in the order of the names it asked for."""
    rows = np.flatnonzero(replies.column("turn").to_numpy() == turn)
    rows = rows[np.argsort(replies.column("bucket").to_numpy()[rows])]
    return np.concatenate([np.zeros(0, kind), *(_read(replies.column(column), int(row), kind) for row in rows)])


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Names of sequences: of ``a`` followed by the token ``b``."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def _sorted(numbers: np.ndarray, spread: int) -> tuple[np.ndarray, np.ndarray]:
    """(the numbers, which are less than 2 ** ``spread``, ascending, their places), mostly by one plain sort of number and place."""
    bits = max(1, len(numbers).bit_length())
    places = np.uint64((1 << bits) - 1)
    keys = numbers.astype(np.uint64) << np.uint64(64 - spread) & ~places | np.arange(len(numbers), dtype=np.uint64)
    keys.sort()
    order = (keys & places).view(np.int64)
    found = numbers[order]
    if spread + bits > 64 and (found[1:] < found[:-1]).any():
        # Numbers that differ in the bits that gave way to places are next to each other.
        order = order[np.argsort(found, kind="stable")]
        found = numbers[order]
    return found, order


def _distinct(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``np.unique`` with the inverse."""
    if not len(names):
        return names, np.zeros(0, np.int64)
    least = names.min()
    found, order = _sorted(names - least, max(1, int(names.max() - least).bit_length()))
    new = np.ones(len(found), bool)
    np.not_equal(found[1:], found[:-1], out=new[1:])
    where = np.empty(len(found), np.int64)
    where[order] = np.cumsum(new) - 1
    return found[new] + least, where


@dataclass
class _Asked:
    """Sequences of one length that were asked for: the tokens that end one, their names, the tokens' places among them, the replies.

    ``of`` are the tokens' places among those that come after the context.
    """

    at: np.ndarray
    of: np.ndarray | None
    names: np.ndarray
    where: np.ndarray
    counts: np.ndarray | None = None
    own: np.ndarray | None = None


@dataclass
class _Contexts:
    """Sequences that occur often enough: the tokens that end one, the tokens after one in a text, the latter's places among ``names``.

    ``names`` and ``totals`` are those of all sequences asked for and, for single tokens, of the start behind them.
    """

    ended: np.ndarray
    at: np.ndarray
    where: np.ndarray
    names: np.ndarray
    totals: np.ndarray

    def chosen(self) -> np.ndarray:
        """Places of those that occur often enough, by ascending names."""
        often = np.flatnonzero(self.totals >= LEAST)
        if len(often) > 1 and self.names[often[-1]] < self.names[often[-2]]:
            often = np.insert(often[:-1], np.searchsorted(self.names[often[:-1]], self.names[often[-1]]), often[-1])
        return often


class _Known:
    """What a block knows before a turn: counts of its sequences of up to ``turn`` tokens, and what contexts of ``turn`` - 2 leave.

    Its tokens are places in ``words``; a text's tokens end before its ``out``, the last being its end.  Of longer sequences only
    those are kept that may occur often enough, by the token that ends them.
    """

    def __init__(self, block: pa.Table, replies: pa.Table | None, turn: int, unit: float, texts: int):
        ends, codes = _read(block.column("ends"), 0, np.int64), _read(block.column("codes"), 0, np.int32)
        self.words, self.texts = _read_names(block.column("words"), 0), texts
        self.out = np.concatenate([[0], np.cumsum(np.diff(ends) + 1)])
        self.tokens = np.full(self.out[-1], np.searchsorted(self.words, END))
        self.inner = np.ones(self.out[-1], bool)
        self.inner[self.out[1:] - 1] = False
        self.tokens[self.inner] = codes
        self.asked, self.contexts = [], []
        for size in range(min(turn, DEPTH + 1)):
            asked = self.asks(size)
            data = _joined(replies, size, "data", np.int64)
            asked.counts, asked.own = data >> 1, data & 1 == 1
            self.asked.append(asked)
            self.contexts.append(self.follows(size))
        # The probability of each token, by the contexts known so far.
        self.p = ((self.asked[0].counts + 1) / unit)[self.tokens] if turn else None
        for level in range(turn - 2):
            context, asked = self.contexts[level], self.asked[level + 1]
            left = np.ones(len(context.names))
            left[context.chosen()] = _joined(replies, level + 2, "left", np.float64)
            n = np.zeros(len(context.at))
            n[asked.of] = asked.counts[asked.where]
            # A retained context leaves less than 1.
            leaves = left[context.where]
            kept = np.flatnonzero(leaves < 1)
            at, n = context.at[kept], n[kept]
            self.p[at] = self.p[at] * leaves[kept] + np.where(n >= LEAST, n / (context.totals + SMOOTHING)[context.where[kept]], 0.0)

    def follows(self, size: int) -> _Contexts:
        asked = self.asked[size]
        names, totals = asked.names, asked.counts
        often = np.flatnonzero((totals >= LEAST)[asked.where])
        ended, where = asked.at[often] if size else often, asked.where[often]
        inner = np.flatnonzero(self.inner[ended])
        at, where = ended[inner] + 1, where[inner]
        if size == 0:
            starts = self.out[:-1]
            at, where = np.concatenate([starts, at]), np.concatenate([np.full(len(starts), len(names)), where])
            names, totals = np.append(names, START), np.append(totals, self.texts)
        return _Contexts(ended, at, where, names, totals)

    def asks(self, size: int) -> _Asked:
        """The sequences of ``size`` + 1 tokens that may occur often enough, as their context and suffix do; all single tokens."""
        if size == 0:
            return _Asked(np.arange(len(self.tokens)), None, self.words, self.tokens)
        context = self.contexts[size - 1]
        often = np.zeros(len(self.tokens), bool)
        often[context.ended] = True
        some = np.flatnonzero(often[context.at])
        at = context.at[some]
        return _Asked(at, some, *_distinct(_mixed(context.names[context.where[some]], self.words[self.tokens[at]])))

    def pairs(self, level: int):
        """(contexts' names, their counts, the number of pairs the block hands on of each, those pairs' counts and probabilities)."""
        context, asked = self.contexts[level], self.asked[level + 1]
        chosen = context.chosen()
        place = np.full(len(context.names), -1)
        place[chosen] = np.arange(len(chosen))
        # One of the places where a sequence ends serves for all: what is read there depends on the sequence alone.
        of = np.zeros(len(asked.names), np.int64)
        of[asked.where] = asked.of
        of = of[asked.own]
        before, order = _sorted(place[context.where[of]], max(1, len(chosen).bit_length()))
        entries = np.bincount(before, minlength=len(chosen)).astype(np.uint32)
        n, p = asked.counts[asked.own][order].astype(np.uint64), self.p[context.at[of][order]]
        return context.names[chosen], context.totals[chosen].astype(np.uint64), entries, n, p


def _by_block(blocks: DataFrame, replies: DataFrame, run, schema) -> DataFrame:
    """``run(block, its replies)`` for every block; both tables lie in buckets of the block and stay where they are."""
    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(run, schema)


def _named(words: pa.Array) -> np.ndarray:
    """Names of words: the sum over their bytes of a hash of each byte and its place, hashed with their length."""
    words = words.cast(pa.large_binary())
    ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    if not len(words):
        return np.zeros(0, np.uint64)
    text = np.frombuffer(words.buffers()[2], np.uint8)[ends[0] : ends[-1]]
    place = np.arange(len(text)) - np.repeat(ends[:-1] - ends[0], np.diff(ends))
    hashed = _mixed(place.astype(np.uint64), text.astype(np.uint64) + np.uint64(1))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashed, dtype=np.uint64)])[ends - ends[0]]
    return _mixed(np.diff(sums), np.diff(ends).astype(np.uint64))


def _blocks(docs: DataFrame) -> DataFrame:
    """One row for each stretch of texts: block, ids, trained, ends (int64), codes (int32), words (names), tokens."""
    id_type = docs.schema["id"].dataType
    schema = T.StructType().add("block", "long").add("ids", T.ArrayType(id_type)).add("trained", "binary").add("ends", "binary")
    schema = schema.add("codes", "binary").add("words", "binary").add("tokens", "long")

    def run(batches):
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            for start, stop in slices(texts, BLOCK_BYTES):
                ends, codes, distinct = split_words(texts.slice(start, stop - start))
                trained = batch.column(2).slice(start, stop - start).to_numpy(zero_copy_only=False).astype(bool)
                # With the name of an end, ascending.
                words, place = _distinct(np.append(_named(distinct), END))
                codes = place[codes]
                ids = batch.column(0).slice(start, stop - start)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block]), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                        *(pa.array([_squeezed(x)], pa.binary()) for x in (trained, ends, codes.astype(np.int32), np.diff(words, prepend=np.uint64(0)))),
                        pa.array([int((np.diff(ends) + 1)[trained].sum())]),
                    ],
                    schema.names,
                )
                block += 1
                pa.default_memory_pool().release_unused()

    small_batches(docs.sparkSession)
    return docs.select("id", "text", "trained").mapInArrow(run, schema)


def _asked(blocks: DataFrame, replies: DataFrame | None, turn: int, buckets: int, unit: float, texts: int) -> DataFrame:
    """(block, bucket, ...): what a block asks in a turn, its sequences of ``turn`` + 1 tokens and its contexts of ``turn`` - 1."""
    schema = T.StructType().add("block", "long").add("packs", T.ArrayType(PACK))

    def ask(block: pa.Table, replies: pa.Table | None) -> pa.Table:
        known = _Known(block, replies, turn, unit, texts)
        names, n = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        if turn <= DEPTH:
            asked = known.asks(turn)
            use = np.repeat(_read(block.column("trained"), 0, bool), np.diff(known.out))
            names, n = asked.names, np.bincount(asked.where[use[asked.at]], minlength=len(asked.names)).astype(np.uint32)
        pairs = known.pairs(turn - 2) if turn >= 2 else (np.zeros(0, k) for k in (np.uint64, np.uint64, np.uint32, np.uint64, np.float64))
        return pa.table([block.column("block"), _packed(names, n, *pairs, buckets)], schema.names)

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                yield from ask(pa.Table.from_batches([batch.slice(row, 1)]), None).to_batches()

    kept = blocks.drop("ids", "tokens")
    packs = kept.mapInArrow(run, schema) if replies is None else _by_block(kept, replies, ask, schema)
    return packs.select("block", F.explode("packs").alias("p")).select("block", "p.*")


def _counted(table: pa.Table):
    """(for each block twice the counts of the sequences it asked of a bucket, the number of distinct trained sequences).

    One is added in the reply to one of the blocks that train on a sequence, if it occurs ``LEAST`` times.
    """
    parts = [_read_names(table.column("names"), row) for row in range(table.num_rows)]
    names, where = _distinct(np.concatenate(parts))
    n = np.concatenate([_read(table.column("n"), row, np.uint32) for row in range(table.num_rows)])
    c = np.bincount(where, n, len(names)).astype(np.int64)
    asked = np.flatnonzero(n)[::-1]
    first = np.full(len(names), -1)
    first[where[asked]] = asked  # the last one set, which is the first of them
    replies = 2 * c[where]
    replies[first[c >= LEAST]] += 1
    return np.split(replies, np.cumsum([len(p) for p in parts])[:-1]), int((c > 0).sum())


def _left(table: pa.Table) -> list[np.ndarray]:
    """For each block what the contexts it named to a bucket leave to their suffixes, 1 for those not retained."""
    parts = [_read_names(table.column("contexts"), row) for row in range(table.num_rows)]
    totals, entries, n, p = (
        np.concatenate([_read(table.column(c), row, kind) for row in range(table.num_rows)])
        for c, kind in (("totals", np.uint64), ("entries", np.uint32), ("pair_n", np.uint64), ("pair_p", np.float64))
    )
    names, where = _distinct(np.concatenate(parts))
    total, context = np.zeros(len(names)), np.repeat(where, entries)
    total[where] = totals
    named, entries = np.bincount(context, n, len(names)), np.bincount(context, minlength=len(names))
    left = (total - named + SMOOTHING) / (total + SMOOTHING)
    adds = n / (total[context] + SMOOTHING)
    gain = np.bincount(context, n * np.log((adds + left[context] * p) / p), len(names)) + (total - named) * np.log(left)
    keep = gain > 0.5 * entries * np.log(np.maximum(total, 2))
    return np.split(np.where(keep, left, 1.0)[where], np.cumsum([len(p) for p in parts])[:-1])


def _answered(asked: DataFrame, turn: int) -> DataFrame:
    """(block, turn, bucket, data, left, distinct): the replies of one bucket; ``distinct`` is on one row of a bucket."""

    def run(table: pa.Table) -> pa.Table:
        counts, distinct = _counted(table)
        data, left = (pa.array([_squeezed(x) for x in replies], pa.binary()) for replies in (counts, _left(table)))
        of, distinct = pa.array(np.full(len(data), turn, np.int32)), pa.array([distinct, *[None] * (len(data) - 1)], pa.int64())
        return pa.table([table.column("block"), of, table.column("bucket"), data, left, distinct], ["block", "turn", "bucket", "data", "left", "distinct"])

    return asked.groupBy("bucket").applyInArrow(run, REPLY)


def score(docs: DataFrame, training: Column, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, trained, n_tokens, n_known, train_tokens, base_score, score) of every row; ``training`` says which to learn from.

    n_tokens counts words and one end; base_score is the root's log10 probability of the text, score the tree's.
    """
    spark = docs.sparkSession
    named = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"), F.coalesce(training, F.lit(False)).alias("trained"))
    size = named.agg(F.sum(F.octet_length("text")).alias("bytes"), F.sum(F.col("trained").cast("long")).alias("trained")).first()
    buckets = max(1, -(-(size["bytes"] or 0) // BUCKET_BYTES))
    trained = size["trained"] or 0
    scratch = Scratch(spark)
    files = min(max(1, -(-(size["bytes"] or 0) // BLOCK_BYTES)), int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))
    blocks = scratch.bucketed(_blocks(named), "block", files, "blocks")
    tokens = blocks.agg(F.sum("tokens").alias("n")).first()["n"] or 0
    replies, unit = None, 0.0
    for turn in range(DEPTH + 2):
        # Written first, so that what was asked is dropped before the replies are moved to their blocks.
        answers = scratch.write(_answered(_asked(blocks, replies, turn, buckets, unit, trained), turn), "answers")
        replies = scratch.bucketed(answers, "block", files, "replies", onto=replies)
        scratch.drop(answers)
        if turn == 0:
            unit = float(tokens + (replies.agg(F.sum("distinct").alias("v")).first()["v"] or 0) + 1)
    result = T.StructType([T.StructField("id", named.schema["id"].dataType), T.StructField("trained", T.BooleanType())])
    for column, kind in (("n_tokens", "long"), ("n_known", "long"), ("base_score", "double"), ("score", "double")):
        result.add(column, kind)

    def scored(block: pa.Table, replies: pa.Table) -> pa.Table:
        known = _Known(block, replies, DEPTH + 2, unit, trained)
        counts, out = known.asked[0].counts, known.out
        hits = np.concatenate([[0], np.cumsum((counts > 0)[known.tokens])])
        sums = [np.concatenate([[0.0], np.cumsum(x)]) for x in (np.log10((counts + 1) / unit)[known.tokens], np.log10(known.p))]
        columns = [pa.array(block.column("ids")[0].values), pa.array(_read(block.column("trained"), 0, bool)), pa.array(np.diff(out))]
        columns += [pa.array(hits[out[1:]] - hits[out[:-1]]), *(pa.array(s[out[1:]] - s[out[:-1]]) for s in sums)]
        return pa.Table.from_arrays(columns, names=result.names)

    rows = scratch.write(_by_block(blocks, replies, scored, result), "scored")
    scratch.drop_all(but=rows)
    return rows.select(F.col("id").alias(id), "trained", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")
