"""Token counts and packing."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from flowgraph.llm import packing, queries, token_count


@pytest.fixture(scope="module")
def vocabulary():
    return token_count.read_vocabulary(f"{queries.TOKENIZERS}/piece_bpe_32k.model")


def _tokenizer(vocabulary, byte_fallback=True):
    tokenizer = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=byte_fallback))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return tokenizer


def _counts(counter, texts):
    ends, codes, parts = token_count._parts(pa.array(texts))
    n = [counter.count("▁" + p) for p in parts.to_pylist()]
    return [sum(n[k] for k in codes[a:b]) for a, b in zip(ends[:-1], ends[1:])]


def test_counts_of_random_texts(vocabulary):
    counter, tokenizer = token_count.UnigramCounter(vocabulary), _tokenizer(vocabulary)
    rnd = random.Random(1)
    letters = "abcdeth  \n\t▁éß漢𝒳🙂<unk>0x19Thing.,"
    texts = ["", " ", "  a", " a ", "▁", "▁ a", "<unk>", "x<unk>y 漢<unk>漢", "<0x0A>", "🙂🙂 a🙂"]
    texts += ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(1000)]
    assert _counts(counter, texts) == [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


@pytest.mark.parametrize("seed", range(4))
def test_ties_and_unknowns_of_small_vocabularies(seed):
    """Whole-number scores make many equal ways; without byte pieces unknown characters form runs."""
    rnd = random.Random(seed)
    pieces = {"".join(rnd.choice("ab▁") for _ in range(rnd.randint(1, 4))) for _ in range(12)}
    vocabulary = [("<unk>", 0.0), *((p, float(-rnd.randint(1, 3))) for p in sorted(pieces))]
    counter, tokenizer = token_count.UnigramCounter(vocabulary), _tokenizer(vocabulary, False)
    texts = ["".join(rnd.choice("abc ") for _ in range(rnd.randint(1, 12))) for _ in range(500)]
    assert _counts(counter, texts) == [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


def test_counts_of_documents(spark, documents, sf_dir, vocabulary):
    tokenizer = _tokenizer(vocabulary)
    texts = {r["doc_id"]: r["text"] or "" for r in documents.collect()}
    for r in queries.op10_token_counts(spark, sf_dir).collect():
        assert r["n_tokens"] == len(tokenizer.encode(texts[r["doc_id"]], add_special_tokens=False).ids)


def test_count_edges(spark, awkward, nothing, vocabulary):
    rows = token_count.count_tokens(awkward, vocabulary).collect()
    assert len(rows) == 12 and {r["doc_id"]: r["n_tokens"] for r in rows}[1] == 0
    assert token_count.count_tokens(nothing, vocabulary).count() == 0


def test_fullest_window_is_that_of_all_sums():
    rnd = random.Random(3)
    for _ in range(300):
        window, counts = rnd.randint(5, 40), {}
        for _ in range(rnd.randint(1, 6)):
            counts[rnd.randint(1, window)] = rnd.randint(1, 4)
        first = max(counts)
        chosen = packing.fullest(counts, first, window)
        assert chosen[first] >= 1 and all(n <= counts[v] for v, n in chosen.items())
        sums = {first}
        for v, n in counts.items():
            sums = {s + v * k for s in sums for k in range(n - (v == first) + 1) if s + v * k <= window}
        assert sum(v * n for v, n in chosen.items()) == max(sums)


def test_plan_uses_every_length_once():
    counts = {7: 5, 3: 100, 4095: 2, 1: 3, 2048: 9}
    used: dict = {}
    for times, chosen in packing.plan(counts, 4096):
        assert sum(v * n for v, n in chosen.items()) <= 4096
        for v, n in chosen.items():
            used[v] = used.get(v, 0) + n * times
    assert used == counts


def test_encoder_is_the_tokenizer():
    encoder = packing._Encoder(queries.tokenizer_json())
    rnd = random.Random(5)
    letters = "aZé̈Åßİı'sS.,!?<|>startofx12½ΣσςǅẞÆ中️-"
    parts = ["<|startoftext|>", "<|STARTOFTEXT|>", "it's", "IT'S", "Straße.", "...", "a...", "ΑΣ.", "x<|endoftext|>y"]
    parts += ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 9))) for _ in range(5000)]
    flat, sizes = encoder.ids(parts)
    for part, ids in zip(parts, np.split(flat, np.cumsum(sizes)[:-1])):
        assert ids.tolist() == encoder.tokenizer.encode(part, add_special_tokens=False).ids


def _check_packing(found, texts, ids_of):
    by_doc: dict = {}
    for r in found:
        by_doc.setdefault(r["doc_id"], []).append(r)
    assert set(by_doc) == set(texts)
    for key, pieces in by_doc.items():
        ids, at = ids_of(texts[key]), 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"] : at], "<u4").tobytes())
        assert at == len(ids)
    sequences: dict = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096
    return len(sequences)


def test_packing_of_documents(spark, documents, sf_dir):
    tokenizer = Tokenizer.from_str(queries.tokenizer_json())
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    found = queries.op3_packing(spark, sf_dir).collect()
    n = _check_packing(found, texts, lambda t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2])
    assert n <= sum(r["length"] for r in found) / 4096 * 1.02 + 1


def test_packed_ids_and_edges(spark, awkward, nothing):
    assert packing.pack(nothing, queries.tokenizer_json(), 2).count() == 0
    found = packing.pack(awkward, queries.tokenizer_json(), 2).collect()
    assert all(len(r["ids"]) == r["length"] for r in found)
    assert [r["ids"] for r in found if r["doc_id"] == 1] == [[2]]
    assert len([r for r in found if r["doc_id"] == 5]) == 2


def test_each_vocabulary_has_its_own_counter(spark):
    """Two vocabularies that differ in one score, one after the other on the same workers."""
    docs = spark.createDataFrame([(1, "ab")], "doc_id long, text string")
    for score, tokens in ((-1.0, 1), (-50.0, 3)):
        vocabulary = [("<unk>", 0.0), ("▁ab", score), ("▁", -2.0), ("a", -2.0), ("b", -2.0)]
        assert token_count.count_tokens(docs, vocabulary).first()["n_tokens"] == tokens


def test_long_parts_are_not_kept():
    encoder = packing._Encoder(queries.tokenizer_json())
    ids, sizes = encoder.ids(["x" * 500, "x" * 500 + "!", "short", "1" * 300])
    assert set(encoder.known) == {"short", "!"} and len(sizes) == 4


def test_packed_ids_come_back():
    ids, ends = np.arange(0, 200_000, 777, dtype=np.int32), np.array([0, 0, 3, 200, 258])
    assert packing.ids_unpacked(packing.ids_packed(ids, ends), np.diff(ends)).to_pylist() == packing.ids_list(ids, ends).to_pylist()
