"""Language of code-switched text by a linear-chain conditional random field over words.

A word has features by its affixes (1 to 3 bytes at either end), its inner byte n-grams (2 to 4) and itself (the lexicon),
hashed into buckets.  Forward-backward gives each word a probability for every language; a text's probabilities are the mean
over its words, weighted by their length.

Trained on at most ``sample_docs`` labelled documents, chosen by a hash of their id with equal shares for the languages, and
at most ``sample_words`` words in a row of each.  Runs of different documents are joined into one sequence, so that
transitions between languages are learned.  Everything scored is scored whole.

A null text, or one without a letter, is ``und`` with score 0.  Without any labelled document all others are ``und`` too.
Ties go to the language that sorts first.  Repeated rows are scored each; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgraph.llm import chain
from flowgraph.llm.text import map_texts, split_words

BUCKETS = 1 << 16
SAMPLE_DOCS = 1200
SAMPLE_WORDS = 120
UNDETERMINED = "und"


@dataclass
class LanguageModel:
    languages: list[str]
    chain: chain.Chain


def _mixed(values: np.ndarray, seed: int) -> np.ndarray:
    values = (values ^ np.uint64(seed * 0x9E3779B9)) * np.uint64(0x9E3779B97F4A7C15)
    values ^= values >> np.uint64(29)
    return ((values * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(48)).astype(np.int64)


def word_features(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Feature buckets of each word: (flat, ends)."""
    words = words.cast(pa.large_string())
    offsets = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1, words.offset * 8)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]].astype(np.uint64)
    begin, size = offsets[:-1] - offsets[0], np.diff(offsets)
    owner = np.repeat(np.arange(len(words)), size)
    left = size[owner] - (np.arange(len(data)) - begin[owner])  # bytes from here to the end of the word
    found, owners = [], []
    gram = np.zeros(len(data), np.uint64)
    for n in range(1, 5):
        shifted = np.zeros(len(data), np.uint64)
        if len(data) >= n:
            shifted[: len(data) - n + 1] = data[n - 1 :]
        gram = (gram << np.uint64(8)) | shifted
        inside = left >= n
        if n > 1:
            found.append(_mixed(gram[inside], n))
            owners.append(owner[inside])
        if n < 4:
            long = np.flatnonzero(size >= n)
            found += [_mixed(gram[begin[long]], 10 + n), _mixed(gram[begin[long] + size[long] - n], 20 + n)]
            owners += [long, long]
    power = np.cumprod(np.full(len(data), 0x100000001B3, np.uint64)) if len(data) else data
    # One number for each word: its bytes times powers that depend on the place in the word.
    place = power[np.arange(len(data)) - begin[owner]] if len(data) else power
    whole = np.concatenate([[np.uint64(0)], np.cumsum((data + np.uint64(1)) * place, dtype=np.uint64)])
    found.append(_mixed(whole[begin + size] - whole[begin], 31))
    owners.append(np.arange(len(words)))
    flat, owners = np.concatenate(found), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return flat[order], np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=len(words)))]).astype(np.int64)


def _sample(docs: DataFrame, lang: str, id: str, text: str, sample_docs: int, sample_words: int) -> list[tuple[str, list[str]]]:
    """(language, words in a row) of at most about ``sample_docs`` documents, the same for the same rows."""
    named = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"))
    named = named.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in named.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return []
    share = sample_docs // len(counts) + 1
    draw = F.pmod(F.xxhash64("id", F.lit("language")), F.lit(1 << 30)) / float(1 << 30)
    below = F.create_map(*(x for k, n in sorted(counts.items()) for x in (F.lit(k), F.lit(share / n))))
    chosen = named.where(draw < F.element_at(below, F.col("lang")))

    def make():
        def apply(texts):
            ends, codes, words = split_words(texts)
            words = words.to_pylist()
            out = []
            for i, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
                at = a + max(0, int(b - a) - sample_words) // 2
                out.append([words[c] for c in codes[at : min(b, at + sample_words)]])
            return {"words": pa.array(out, pa.list_(pa.string()))}

        return apply

    rows = map_texts(chosen, "text", ["lang", "id"], [T.StructField("words", T.ArrayType(T.StringType()))], make)
    return [(r["lang"], r["words"]) for r in sorted(rows.limit(2 * sample_docs).collect(), key=lambda r: (str(r["id"]), r["words"]))]


def train(
    docs: DataFrame, lang: str = "lang", id: str = "doc_id", text: str = "text",
    sample_docs: int = SAMPLE_DOCS, sample_words: int = SAMPLE_WORDS,
) -> LanguageModel:
    """A model of the non-null languages of ``docs``."""
    sample = [(k, w) for k, w in _sample(docs, lang, id, text, sample_docs, sample_words) if w]
    languages = sorted({k for k, _ in sample})
    if not languages:
        return LanguageModel([], chain.Chain(np.zeros((BUCKETS, 0)), np.zeros((0, 0)), np.zeros(0)))
    # Every second document stands alone, the others in sequences of four.
    order = np.random.default_rng(7).permutation(len(sample))
    alone, joined = order[: len(order) // 2], order[len(order) // 2 :]
    groups = [[i] for i in alone] + [list(joined[i : i + 4]) for i in range(0, len(joined), 4)]
    words, labels, ends = [], [], [0]
    for group in groups:
        for i in group:
            name, run = sample[i]
            words += run
            labels += [languages.index(name)] * len(run)
        ends.append(len(words))
    coded = pa.array(words, pa.string()).dictionary_encode()
    flat, flat_ends = word_features(coded.dictionary)
    units = coded.indices.to_numpy().astype(np.int64)
    fitted = chain.fit(flat, flat_ends, units, np.array(ends), np.array(labels), BUCKETS, len(languages), steps=40)
    fitted.weights = fitted.weights.astype(np.float32)
    return LanguageModel(languages, fitted)


def label_words(texts: pa.Array, model: LanguageModel) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """(ends, codes, words, probabilities by word of the texts and language)."""
    ends, codes, words = split_words(texts)
    flat, flat_ends = word_features(words)
    emit = chain.emissions(model.chain.weights, flat, flat_ends)
    prob, _ = chain.marginals(emit[codes], ends, model.chain)
    return ends, codes, words, prob


def identify(docs: DataFrame, model: LanguageModel, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, lang_pred, score, n_words) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = shared.value
        names = np.array([*model.languages, UNDETERMINED])

        def apply(texts):
            lettered = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
            if not model.languages:
                n = len(texts)
                return {"lang_pred": pa.array([UNDETERMINED] * n), "score": np.zeros(n), "n_words": np.zeros(n, np.int64)}
            ends, codes, words, prob = label_words(texts, model)
            weight = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(float)[codes]
            weight *= pc.match_substring_regex(words, r"\p{L}").to_numpy(zero_copy_only=False)[codes]
            sums = np.concatenate([np.zeros((1, prob.shape[1])), np.cumsum(prob * weight[:, None], axis=0)])
            mass = np.concatenate([[0.0], np.cumsum(weight)])
            mean = (sums[ends[1:]] - sums[ends[:-1]]) / np.maximum(mass[ends[1:]] - mass[ends[:-1]], 1e-300)[:, None]
            best = np.where(lettered, mean.argmax(axis=1), len(model.languages))
            score = np.where(lettered, np.clip(mean.max(axis=1), 0.0, 1.0), 0.0)
            return {"lang_pred": pa.array(names[best]), "score": score, "n_words": np.diff(ends)}

        return apply

    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("n_words", T.LongType())]
    return map_texts(docs, text, [id], fields, make)
