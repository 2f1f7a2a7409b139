"""Document quality by a linear-chain conditional random field that labels every line good or bad.

A line is described by its own measures (length, shares of symbols, capitals, digits and repeated words, and the like), each
cut into fixed bins, and by the binned measures of the lines before and after it.  Forward-backward gives each line its
probability of being good; a document's score is their mean, weighted by line length.

Trained on at most ``sample_docs`` labelled documents, chosen by a hash of their id, with at most ``sample_lines`` lines in a
row of each, where every line bears its document's label.  Everything scored is scored whole.

A null or empty text is one empty line.  Without any label in training every score is 0.5.  Repeated rows are scored each;
several labels of one id train it once with each label; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgraph.llm import chain
from flowgraph.llm.text import map_texts, split_words

SAMPLE_DOCS = 4000
SAMPLE_LINES = 200
#: A document is kept with this score.
KEEP = 0.3

#: Edges of the bins of each measure of a line.
EDGES = {
    "bytes": [1, 20, 60, 150, 400, 1000],
    "words": [1, 3, 6, 15, 50, 150],
    "word_bytes": [2.5, 4.0, 5.0, 6.0, 7.5, 10.0],
    "symbols": [0.005, 0.03, 0.06, 0.1, 0.2, 0.4],
    "stops": [0.005, 0.01, 0.02, 0.04, 0.08, 0.15],
    "capitals": [0.005, 0.02, 0.05, 0.1, 0.3, 0.6],
    "digits": [0.005, 0.02, 0.05, 0.1, 0.3, 0.6],
    "others": [0.005, 0.02, 0.05, 0.1, 0.2, 0.5],
    "distinct": [0.1, 0.3, 0.5, 0.7, 0.85, 0.95],
    "doubled": [0.005, 0.02, 0.05, 0.1, 0.3, 0.6],
    "repeated": [0.5],
}
BINS = 7
WIDTH = BINS * len(EDGES)
#: Own, previous and next line, a mark for a missing neighbour on either side, and one feature that every line has.
FEATURES = 3 * WIDTH + 3

_CLASS = np.zeros((256, 5), np.int64)
_CLASS[list(b"#$%&*+/<=>@[\\]^_`{|}~!"), 0] = 1
_CLASS[list(b".,;:?'\"()-"), 1] = 1
_CLASS[65:91, 2] = 1
_CLASS[48:58, 3] = 1
_CLASS[128:, 4] = 1


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a / np.maximum(b, 1)


def line_bins(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lines of each text as ends, bytes of each line, bin of each line and measure)."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    breaks = np.flatnonzero(data == 10)
    # A line starts at a text's start and after each break; it ends before a break or at the text's end.
    begin = np.concatenate([offsets[:-1], breaks + 1])
    owner = np.concatenate([np.arange(len(texts)), np.searchsorted(offsets, breaks, side="right") - 1])
    order = np.lexsort((begin, owner))
    begin, owner = begin[order], owner[order]
    ends = np.searchsorted(owner, np.arange(len(texts) + 1))
    stop = np.empty_like(begin)
    stop[:-1] = begin[1:] - 1
    last = ends[1:] - 1
    stop[last] = offsets[1:]
    size = stop - begin
    counts = {}
    for k, name in enumerate(("symbols", "stops", "capitals", "digits", "others")):
        sums = np.concatenate([[0], np.cumsum(_CLASS[data, k])])
        counts[name] = sums[stop] - sums[begin]
    # Words never cross a line, so they fall to the lines in order.
    raw = pa.LargeStringArray.from_buffers(
        len(begin), pa.py_buffer(np.append(begin, len(data)).astype(np.int64)), pa.py_buffer(data.tobytes())
    ) if len(begin) else pa.array([], pa.large_string())
    word_ends, codes, words = split_words(raw.cast(pa.string()), lower=False)
    n_words = np.diff(word_ends)
    line = np.repeat(np.arange(len(begin)), n_words)
    key = np.unique(line * max(1, len(words)) + codes)
    distinct = np.bincount(key // max(1, len(words)), minlength=len(begin)) if len(key) else np.zeros(len(begin))
    same = np.zeros(len(codes), bool)
    same[1:] = (codes[1:] == codes[:-1]) & (line[1:] == line[:-1])
    doubled = np.bincount(line[same], minlength=len(begin))
    # A line that repeats the line before it, by its length and a sum of its bytes.
    weights = np.concatenate([[0], np.cumsum(data, dtype=np.int64)])
    total = weights[stop] - weights[begin]
    again = np.zeros(len(begin))
    again[1:] = (size[1:] == size[:-1]) & (total[1:] == total[:-1]) & (owner[1:] == owner[:-1]) & (size[1:] > 0)
    measures = {
        "bytes": size,
        "words": n_words,
        "word_bytes": _ratio(size, n_words),
        **{name: _ratio(n, size) for name, n in counts.items()},
        "distinct": _ratio(distinct, n_words),
        "doubled": _ratio(doubled, n_words),
        "repeated": again,
    }
    bins = np.stack([np.searchsorted(EDGES[name], measures[name], side="right") for name in EDGES], axis=1)
    return ends, size, bins.astype(np.int8)


def line_features(bins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Feature numbers of each line, by row: own, previous, next and the constant."""
    own = bins.astype(np.int64) + np.arange(bins.shape[1]) * BINS
    out = np.full((len(bins), 3 * own.shape[1] + 1), 3 * WIDTH + 2, np.int64)
    k = own.shape[1]
    out[:, :k] = own
    out[1:, k : 2 * k] = own[:-1] + WIDTH
    out[:-1, 2 * k : 3 * k] = own[1:] + 2 * WIDTH
    full = np.diff(ends) > 0
    out[ends[:-1][full], k : 2 * k] = 3 * WIDTH
    out[ends[1:][full] - 1, 2 * k : 3 * k] = 3 * WIDTH + 1
    return out


def train(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality",
    sample_docs: int = SAMPLE_DOCS, sample_lines: int = SAMPLE_LINES,
) -> chain.Chain:
    """A model from ``labels`` (id, label 0 or 1) and the texts that ``docs`` has for them."""
    named = labels.select(F.col(f"`{id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("label")).where("id is not null and label in (0, 1)")
    untrained = chain.Chain(np.zeros((FEATURES, 2)), np.zeros((2, 2)), np.zeros(2))
    n = named.count()
    if not n:
        return untrained
    draw = F.pmod(F.xxhash64("id", F.lit("quality")), F.lit(1 << 30)) / float(1 << 30)
    named = named.where(draw < sample_docs / n).distinct().limit(2 * sample_docs)
    chosen = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text")).join(F.broadcast(named), "id").limit(2 * sample_docs)

    def make():
        def apply(texts):
            ends, _, bins = line_bins(texts)
            rows = []
            for a, b in zip(ends[:-1], ends[1:]):
                at = a + max(0, int(b - a) - sample_lines) // 2
                rows.append(bins[at : min(b, at + sample_lines)].tobytes())
            return {"bins": pa.array(rows, pa.binary())}

        return apply

    found = map_texts(chosen, "text", ["id", "label"], [T.StructField("bins", T.BinaryType())], make).collect()
    if not found:
        return untrained
    found = sorted(found, key=lambda r: (r["id"], r["label"], bytes(r["bins"])))
    each = [np.frombuffer(bytes(r["bins"]), np.int8).reshape(-1, len(EDGES)) for r in found]
    ends = np.concatenate([[0], np.cumsum([len(e) for e in each])]).astype(np.int64)
    features = line_features(np.concatenate(each), ends)
    truth = np.repeat([r["label"] for r in found], np.diff(ends)).astype(np.int64)
    flat_ends = np.arange(len(features) + 1) * features.shape[1]
    return chain.fit(features.ravel(), flat_ends, np.arange(len(features)), ends, truth, FEATURES, 2, steps=100, rate=0.1, penalty=1e-4)


def score_lines(texts: pa.Array, model: chain.Chain) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lines of each text as ends, bytes of each line, probability that each line is good)."""
    ends, size, bins = line_bins(texts)
    features = line_features(bins, ends)
    emit = model.weights[features].sum(axis=1)
    prob, _ = chain.marginals(emit, ends, model)
    return ends, size, prob[:, 1]


def score(docs: DataFrame, model: chain.Chain, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """Columns ``keep`` (doc_id by default), score and n_lines of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def apply(texts):
            ends, size, good = score_lines(texts, shared.value)
            weight = size + 1.0  # so that an empty text has a weight
            sums = np.concatenate([[0.0], np.cumsum(good * weight)])
            mass = np.concatenate([[0.0], np.cumsum(weight)])
            mean = (sums[ends[1:]] - sums[ends[:-1]]) / (mass[ends[1:]] - mass[ends[:-1]])
            return {"score": np.clip(mean, 0.0, 1.0), "n_lines": np.diff(ends)}

        return apply

    fields = [T.StructField("score", T.DoubleType()), T.StructField("n_lines", T.LongType())]
    return map_texts(docs, text, keep or ["doc_id"], fields, make)


def keep_good(docs: DataFrame, model: chain.Chain, text: str = "text", least: float = KEEP) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is ``least`` or more."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(f"`{text}`").alias("text"))
    return score(rows, model, keep=["row"], text="text").where(F.col("score") >= least).select("row.*")
