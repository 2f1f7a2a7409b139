"""Ranked lexical search by bit-sliced Bloom signatures, exact.

The index holds blocks of documents of about equal numbers of distinct terms.  A block is a bit matrix: one column for each
document, one row (a slice) for each position that a term may be hashed to.  A term sets ``HASHES`` bits of its document, once
for each step of ``STEPS`` that its occurrences reach.  The intersection of a term's slices is a bitmap of the documents that
may hold it so often; it may show too many, never too few.  The weighted sum of these bitmaps, each taken at the most
occurrences it allows, is an upper bound of every document's score.  A block's terms are listed with their numbers of
documents beside the slices.

A search reads the slices twice.  The first pass keeps the k greatest bounds of each task; their documents are scored
exactly, and the k-th best score and id stand as proof against others.  The second pass gives every document whose bound is
not below that, or ties it with no greater id, and all of these are scored exactly from their whole texts.  Items go out in
shards of about ``SHARD_BYTES``; each shard is a search of its own, so more items make more passes, not larger ones.

Terms are runs of letters, digits and characters beyond ASCII, A-Z lower-cased.  Scores are whole numbers, see ``gain`` and
``weight``.  A null text, or one without terms, is found by nothing and counts nowhere.  Rows of one id are ranked each; a
null id ranks behind all others of its score.  Repeated items are answered each.  An empty side gives an empty table.  Terms
are named by 64-bit hashes in the index; exact scores compare the terms themselves.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgraph.llm.text import slices, small_batches, split_words
from flowgraph.session import materialize

#: Occurrences that have a bit pattern of their own: at least so many.
STEPS = (1, 2, 3, 5, 9)
HASHES = 4
#: Slices of a block for each entry (term and step) of its fullest document.
SLICES_AN_ENTRY = 12
#: Bits in a block, and a document's entries by which the fullest of a block may exceed the emptiest.
BLOCK_BITS = 1 << 23
SPREAD, SLACK = 1.25, 16
#: (document, term) pairs that a task gathers before it cuts blocks.
GATHERED = 2_000_000
SHARD_BYTES = 1 << 20
#: Items whose bounds are computed together.
ITEMS_A_TIME = 64
#: Documents to be scored exactly that are broadcast by id; more of them are joined by a shuffle.
BROADCAST_ROWS = 200_000

LETTER = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
INDEX = "ids array<bigint>, lengths array<bigint>, most array<bigint>, width int, slices binary, names binary, counts binary"


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Terms of texts without nulls, as (offsets per text, code per term, distinct terms)."""
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    body = texts.buffers()[2].slice(int(ends[0]), int(ends[-1] - ends[0])).to_pybytes() if ends[-1] > ends[0] else b""
    spaced = pa.StringArray.from_buffers(len(texts), pa.py_buffer((ends - ends[0]).astype(np.int32).tobytes()), pa.py_buffer(body.translate(LETTER)))
    return split_words(spaced, lower=False)


def name_of(words: pa.Array) -> np.ndarray:
    return pd.util.hash_array(words.to_numpy(zero_copy_only=False).astype(object)) if len(words) else np.zeros(0, np.uint64)


def places(names: np.ndarray, step: int, width: int) -> np.ndarray:
    """Slices (one column for each hash) that terms set for a step."""
    out = []
    for half in range(HASHES // 2):
        x = (names ^ np.uint64(0x9E3779B97F4A7C15 * (HASHES * step + half + 1) % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        out += [(x & np.uint64(0xFFFFFFFF)) % np.uint64(width), (x >> np.uint64(32)) % np.uint64(width)]
    return np.stack(out, axis=1).astype(np.int64)


def gain(tf, m):
    """What ``tf`` occurrences are worth in a document of length factor ``m``; arrays or numbers, rounding down."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_factor(n, n_docs: int, all_terms: int):
    return 100 - 90 + (90 * n * n_docs) // all_terms


class Gathered:
    """(document, term) pairs of a task on their way into blocks."""

    def __init__(self):
        self.ids: list = []
        self.lengths: list = []
        self.pairs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, ids: list, texts: pa.Array) -> None:
        ends, codes, words = terms(texts)
        n = ends[1:] - ends[:-1]
        some = np.flatnonzero(n > 0)
        if not len(some):
            return
        place = np.cumsum(n > 0) - 1 + len(self.ids)
        pair, tf = np.unique(np.repeat(place, n) * len(words) + codes, return_counts=True)
        self.pairs.append((pair // len(words), name_of(words)[pair % len(words)], tf))
        self.ids += [ids[i] for i in some]
        self.lengths.append(n[some])
        self.size += len(pair)

    def blocks(self) -> Iterator[pa.RecordBatch]:
        doc, name, tf = (np.concatenate(p) for p in zip(*self.pairs))
        n = len(self.ids)
        lengths, most = np.concatenate(self.lengths), np.zeros(n, np.int64)
        np.maximum.at(most, doc, tf)
        entries = sum(np.bincount(doc[tf >= step], minlength=n) for step in STEPS)
        by_size = np.argsort(entries, kind="stable")
        block, first = np.zeros(n, np.int64), 0
        bounds = []
        for i, e in enumerate(entries[by_size].tolist() + [0]):
            start = entries[by_size[first]]
            if i == n or e > SPREAD * start + SLACK or (i - first + 1) * SLICES_AN_ENTRY * e > BLOCK_BITS:
                block[by_size[first:i]] = len(bounds)
                bounds.append((first, i))
                first = i
        column = np.zeros(n, np.int64)
        for a, b in bounds:
            column[by_size[a:b]] = np.arange(b - a)
        order = np.argsort(block[doc], kind="stable")
        doc, name, tf = doc[order], name[order], tf[order]
        starts = np.searchsorted(block[doc], np.arange(len(bounds) + 1))
        for k, (a, b) in enumerate(bounds):
            mine = slice(starts[k], starts[k + 1])
            members = by_size[a:b]
            width = int(SLICES_AN_ENTRY * entries[members].max())
            bits = np.zeros((width, -(-(b - a) // 8) * 8), bool)
            for s, step in enumerate(STEPS):
                often = tf[mine] >= step
                at = places(name[mine][often], s, width)
                bits[at, column[doc[mine][often]][:, None]] = True
            names, counts = np.unique(name[mine], return_counts=True)
            values = [
                [[self.ids[i] for i in members]], [lengths[members]], [most[members]], [width], [np.packbits(bits, axis=1).tobytes()],
                [names.tobytes()], [counts.astype(np.int64).tobytes()],
            ]
            kinds = [pa.list_(pa.int64())] * 3 + [pa.int32()] + [pa.binary()] * 3
            columns = [pa.array(v, t) for v, t in zip(values, kinds)]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in INDEX.split(", ")])


def build(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The written index of every row of ``docs`` that has a term."""
    small_batches(docs.sparkSession)

    def run(batches):
        held = Gathered()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = batch.column(1).cast(pa.string())
            for start, stop in slices(texts):
                held.add(ids[start:stop], texts.slice(start, stop - start))
                if held.size >= GATHERED:
                    yield from held.blocks()
                    held = Gathered()
        if held.ids:
            yield from held.blocks()

    narrow = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    return materialize(narrow.mapInArrow(run, INDEX), "signatures")


class Items:
    """Items of a shard: distinct terms with their weights, and the terms of each item."""

    def __init__(self, texts: list[str]):
        ends, codes, words = terms(pa.array(texts, pa.string()))
        self.words = words.to_pylist()
        self.names = name_of(words)
        self.of = [np.unique(codes[a:b]) for a, b in zip(ends[:-1], ends[1:])]
        self.weights = np.zeros(len(words), np.int64)

    def weigh(self, df: dict[int, int], n_docs: int, all_terms: int) -> None:
        self.n_docs, self.all_terms = n_docs, all_terms
        self.weights = np.array([weight(df.get(int(name), 0), n_docs) for name in self.names.view(np.int64)], np.int64)

    def bounds(self, row: dict, first: int) -> np.ndarray:
        """Upper bound of the score of every document of an index row, for the items from ``first`` on."""
        n, width = len(row["ids"]), row["width"]
        matrix = np.frombuffer(row["slices"], np.uint8).reshape(width, -1)
        some = self.of[first : first + ITEMS_A_TIME]
        asked = np.unique(np.concatenate(some)) if some else np.zeros(0, np.int64)
        shown, level = None, np.zeros((len(asked), n), np.uint8)
        for s in range(len(STEPS)):
            bitmap = np.bitwise_and.reduce(matrix[places(self.names[asked], s, width)], axis=1)
            shown = bitmap if shown is None else shown & bitmap
            if not shown.any():
                break
            level += np.unpackbits(shown, axis=1, count=n)
        m = length_factor(np.array(row["lengths"], np.int64), self.n_docs, self.all_terms)
        most = np.array(row["most"], np.int64)
        allowed = [np.zeros(n, np.int64), *(np.minimum(step - 1, most) for step in STEPS[1:]), most]
        worth = np.stack([gain(tf, m) for tf in allowed]).astype(float)
        best = worth[level, np.arange(n)]
        # Whole numbers far below 2 ** 53, so the sums are exact.
        weights = self.weights.astype(float)
        return np.stack([weights[item] @ best[np.searchsorted(asked, item)] for item in some]).astype(np.int64)


def shards(items: DataFrame, item_id: str, text: str, shard_bytes: int = SHARD_BYTES) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) of about ``shard_bytes`` each, which together are all items with a text."""
    named = items.select(F.col(f"`{item_id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text")).where("text is not null")
    total = named.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    n = max(1, -(-total // shard_bytes))
    for shard in range(n):
        rows = named.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == shard).collect()
        if rows:
            yield [r["id"] for r in rows], [r["text"] for r in rows]


def _document_counts(index: DataFrame, names: np.ndarray) -> dict[int, int]:
    """Documents that hold each of the named terms; one row for each of them at most."""
    wanted = index.sparkSession.sparkContext.broadcast(np.sort(names))

    def run(batches):
        sums = np.zeros(len(wanted.value), np.int64)
        for batch in batches:
            for known, counts in zip(*(batch.column(c).to_pylist() for c in ("names", "counts"))):
                known, counts = np.frombuffer(known, np.uint64), np.frombuffer(counts, np.int64)
                at = np.minimum(np.searchsorted(known, wanted.value), len(known) - 1)
                sums += np.where(known[at] == wanted.value, counts[at], 0)
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(wanted.value[some].view(np.int64)), pa.array(sums[some])], ["name", "df"])

    counted = index.select("names", "counts").mapInArrow(run, "name long, df long").groupBy("name").agg(F.sum("df").alias("df"))
    return {r["name"]: r["df"] for r in counted.collect()}


LAST = np.iinfo(np.int64).max


def _bounded(index: DataFrame, items, pick: Callable) -> DataFrame:
    """(item, id, bound) of the documents that ``pick()(item, bounds, ids)`` selects from each block, then from its rest."""

    def run(batches):
        choose = pick()
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in ("ids", "lengths", "most", "width", "slices")}
                ids = np.array([LAST if i is None else i for i in row["ids"]], np.int64)
                for first in range(0, len(items.value.of), ITEMS_A_TIME):
                    for j, bounds in enumerate(items.value.bounds(row, first)):
                        yield from choose(first + j, bounds, ids)
        yield from choose(None, None, None)

    return index.select("ids", "lengths", "most", "width", "slices").mapInArrow(run, "item int, id long, bound long, nameless boolean")


def _found(item: int, ids: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch:
    nameless = ids == LAST
    columns = [pa.array(np.full(len(ids), item, np.int32)), pa.array(ids, mask=nameless), pa.array(bounds), pa.array(nameless)]
    return pa.RecordBatch.from_arrays(columns, ["item", "id", "bound", "nameless"])


def _greatest(k: int) -> Callable:
    """The k greatest bounds of each item in a task."""

    def pick():
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def choose(item, bounds, ids):
            if item is None:
                return [_found(i, x, b) for i, (b, x) in held.items()]
            least = held[item][0][-1] if item in held and len(held[item][0]) == k else 1
            some = np.flatnonzero(bounds >= least)
            if len(some):
                b, x = bounds[some], ids[some]
                if item in held:
                    b, x = np.concatenate([held[item][0], b]), np.concatenate([held[item][1], x])
                best = np.lexsort((x, -b))[:k]
                held[item] = (b[best], x[best])
            return ()

        return choose

    return pick


def _not_excluded(proof: dict[int, tuple[int, int]]) -> Callable:
    """Every document that the proof (score, id) of an item does not exclude; without one, whatever may score at all."""

    def pick():
        def choose(item, bounds, ids):
            if item is None:
                return ()
            score, last = proof.get(item, (1, LAST))
            some = np.flatnonzero((bounds > score) | ((bounds == score) & (ids <= last)))
            return [_found(item, ids[some], bounds[some])] if len(some) else ()

        return choose

    return pick


def _scored(docs: DataFrame, chosen: DataFrame, items, id: str, text: str) -> DataFrame:
    """(item, id, score) of the rows of ``docs`` for the items that chose their id, scored from their whole texts."""
    chosen = materialize(chosen.groupBy("id").agg(F.collect_set("item").alias("items")), "chosen")
    asked = chosen.withColumnRenamed("id", "asked")
    asked = F.broadcast(asked) if chosen.count() <= BROADCAST_ROWS else asked
    narrow = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text")).where("text is not null")
    rows = narrow.join(asked, F.col("id").eqNullSafe(F.col("asked"))).select("id", "items", "text")

    def run(batches):
        given = items.value
        for batch in batches:
            texts = batch.column("text").cast(pa.string())
            out: tuple[list, list, list] = ([], [], [])
            for start, stop in slices(texts):
                ends, codes, words = terms(texts.slice(start, stop - start))
                code_of = pc.index_in(pa.array(given.words, pa.string()), words).to_pylist() if given.words else []
                for k in range(stop - start):
                    tf = Counter(codes[ends[k] : ends[k + 1]].tolist())
                    if not tf:
                        continue
                    m = length_factor(int(ends[k + 1] - ends[k]), given.n_docs, given.all_terms)
                    for item in batch.column("items")[start + k].as_py():
                        score = sum(int(given.weights[t]) * gain(tf[code_of[t]], m) for t in given.of[item].tolist() if code_of[t] in tf)
                        if score > 0:
                            for column, value in zip(out, (item, batch.column("id")[start + k].as_py(), score)):
                                column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64())], ["item", "id", "score"])

    return rows.mapInArrow(run, "item int, id long, score long")


def _ranked(scored: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def search(
    docs: DataFrame, items: DataFrame, k: int, index: DataFrame | None = None, id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """(item id, rank, id, score) of the k best rows of ``docs`` for every row of ``items``; ``index`` is ``build(docs)``."""
    spark = docs.sparkSession
    index = build(docs, id, text) if index is None else index
    sums = index.agg(F.sum(F.size("ids")).alias("docs"), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("terms")).first()
    kind = items.schema[item_id].dataType
    name = item_id if item_id not in (id, "rank", "score") else "item"
    schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("given", kind)])
    out = None
    for ids, texts in shards(items, item_id, item_text, shard_bytes) if sums["docs"] else ():
        asked = Items(texts)
        asked.weigh(_document_counts(index, asked.names), sums["docs"], sums["terms"])
        shared = spark.sparkContext.broadcast(asked)
        likely = _bounded(index, shared, _greatest(k))
        first = Window.partitionBy("item").orderBy(F.desc("bound"), "nameless", "id")
        likely = likely.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k).select("item", "id")
        kth = _ranked(_scored(docs, likely, shared, id, text), k).where(F.col("rank") == k).collect()
        proof = {r["item"]: (r["score"], LAST if r["id"] is None else r["id"]) for r in kth}
        chosen = _bounded(index, shared, _not_excluded(proof)).select("item", "id")
        ranked = _ranked(_scored(docs, chosen, shared, id, text), k)
        names = F.broadcast(spark.createDataFrame(list(enumerate(ids)), schema))
        part = ranked.join(names, "item").select(F.col("given").alias(name), "rank", F.col("id").alias(id), "score")
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = spark.createDataFrame([], T.StructType([T.StructField(name, kind)])).select(
            name, F.lit(0).alias("rank"), F.lit(0).cast("long").alias(id), F.lit(0).cast("long").alias("score")
        )
    return out


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def duckdb_sql(k: int) -> str:
    """The same over the views ``documents`` and ``benchmark``."""
    found = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}')"
    return f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {found} AS t FROM documents),
s AS (SELECT count(*) AS docs, CAST(sum(len(t)) AS BIGINT) AS terms FROM d WHERE len(t) > 0),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY 1, 2),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM tf, s GROUP BY term, docs),
m AS (SELECT r, doc_id, 10 + (90 * len(t) * docs) // terms AS m FROM d, s),
i AS (SELECT DISTINCT q, item_id, unnest(t) AS term FROM (SELECT row_number() OVER () AS q, item_id, {found} AS t FROM benchmark)),
scored AS (SELECT q, item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM i JOIN w USING (term) JOIN tf USING (term) JOIN m USING (r) GROUP BY ALL),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {k}"""
