"""Token counts of a unigram tokenizer without building its tokens.

A text is cut before every word mark, and each distinct part is counted once: an Aho-Corasick automaton lists every
vocabulary piece in it, and one pass over the ends carries (best score, piece count).  Ties follow the tokenizer: pieces
that reach an end are tried from the earliest start, and only a strictly better score replaces what is there.  A character
that no single piece covers is an unknown of score min - 10, counted by its UTF-8 bytes when the vocabulary has byte
pieces, else one per run of unknowns.

Null and empty texts have 0 tokens; equal rows are counted each on their own; an empty table gives an empty table.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from flowgraph.llm.text import map_texts

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Distinct parts whose counts a task remembers before it starts afresh, and the longest of them (a cache, no limit on what
#: is counted).
CACHE = 1_000_000
CACHED_LENGTH = 64


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) in id order from a sentencepiece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class UnigramCounter:
    def __init__(self, vocabulary: list[tuple[str, float]], unknown: int = 0):
        self.unknown_piece = vocabulary[unknown][0]
        self.unknown_score = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        self.byte_fallback = all(f"<0x{b:02X}>" in {p for p, _ in vocabulary} for b in (0, 255))
        self.pieces = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.pieces.add_word(piece, (len(piece), score))
        self.pieces.make_automaton()

    def count(self, part: str) -> int:
        """Tokens of one part, which no piece may cross."""
        if self.unknown_piece in part:
            return self._count_backwards(part)
        n = len(part)
        score, count, unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        filled = 0  # every end up to here has its best way
        for last, (size, value) in self.pieces.iter(part):
            while filled < last:  # ends that no piece reaches
                filled += 1
                self._unknown(part, filled, score, count, unknown)
            end = last + 1
            start = end - size
            way = score[start] + value
            if filled < end:
                filled, best = end, None
                if size > 1 and not self._single(part[last]):
                    other = score[last] + self.unknown_score
                    if other > way:  # the shortest way comes last, so it must be strictly better
                        self._unknown(part, end, score, count, unknown)
                        best = other
                if best is None:
                    score[end], count[end], unknown[end] = way, count[start] + 1, False
            elif way > score[end]:
                score[end], count[end], unknown[end] = way, count[start] + 1, False
        while filled < n:
            filled += 1
            self._unknown(part, filled, score, count, unknown)
        return count[n]

    def _single(self, char: str) -> bool:
        return char in self.pieces

    def _unknown(self, part, end, score, count, unknown):
        score[end] = score[end - 1] + self.unknown_score
        if self.byte_fallback:
            count[end] = count[end - 1] + len(part[end - 1].encode())
        else:
            count[end] = count[end - 1] + (0 if unknown[end - 1] else 1)
        unknown[end] = True

    def _count_backwards(self, part: str) -> int:
        """The same, for a part that spells the unknown piece: it joins the unknown characters beside it."""
        n = len(part)
        score: list = [None] * (n + 1)
        back: list = [None] * (n + 1)
        score[0] = 0.0
        ways: list[list] = [[] for _ in range(n + 1)]
        for last, (size, value) in self.pieces.iter(part):
            ways[last + 1].append((last + 1 - size, value, part[last + 1 - size : last + 1] == self.unknown_piece))
        for end in range(1, n + 1):
            if not self._single(part[end - 1]):
                ways[end].append((end - 1, self.unknown_score, True))
            for start, value, unknown in ways[end]:
                if score[end] is None or score[start] + value > score[end]:
                    score[end], back[end] = score[start] + value, (start, unknown)
        total, end = 0, n
        while end:
            start, unknown = back[end]
            while unknown and start and back[start][1]:
                start = back[start][0]
            run = part[start:end]
            total += len(run.encode()) if unknown and self.byte_fallback and run != self.unknown_piece else 1
            end = start
        return total


def _parts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Texts cut at word marks (blanks): offsets per text, code per part, distinct parts without their mark."""
    split = pc.split_pattern(pc.replace_substring(texts, MARK, " "), " ")
    ends = split.offsets.to_numpy().astype(np.int64)
    coded = split.values.slice(ends[0], ends[-1] - ends[0]).dictionary_encode()
    ends = ends - ends[0]
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    # A text that begins with a mark has an empty part before it, which is none; so has an empty text.
    empty = pc.index(coded.dictionary, pa.scalar("", coded.dictionary.type)).as_py()
    if empty >= 0:
        first = np.zeros(len(codes), bool)
        first[ends[:-1]] = True
        full = ~(first & (codes == empty))
        ends, codes = np.concatenate([[0], np.cumsum(full)])[ends], codes[full]
    return ends, codes, coded.dictionary


def count_tokens(docs: DataFrame, vocabulary: list[tuple[str, float]], id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_tokens, n_parts) of every row: tokens as the unigram tokenizer with this vocabulary would give."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def make():
        counter = _worker_counter(shared)
        known: dict[str, int] = counter.known

        def apply(texts):
            ends, codes, parts = _parts(texts)
            if len(known) > CACHE:
                known.clear()
            sizes = np.zeros(len(parts), np.int64)
            for i, part in enumerate(parts.to_pylist()):
                n = known.get(part)
                if n is None:
                    n = counter.count(MARK + part)
                    if len(part) <= CACHED_LENGTH:
                        known[part] = n
                sizes[i] = n
            sums = np.concatenate([[0], np.cumsum(sizes[codes])])
            return {"n_tokens": sums[ends[1:]] - sums[ends[:-1]], "n_parts": ends[1:] - ends[:-1]}

        return apply

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("n_parts", T.LongType())]
    return map_texts(docs, text, [id], fields, make)


_COUNTERS: dict[tuple, UnigramCounter] = {}


def _worker_counter(shared) -> UnigramCounter:
    """One automaton and one cache for each Python worker, which serves many tasks; another vocabulary has its own."""
    key = tuple(shared.value)
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = UnigramCounter(shared.value)
        _COUNTERS[key].known = {}
    return _COUNTERS[key]
