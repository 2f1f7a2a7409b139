"""Text to unit vectors at scale, and reuse of vectors that are already stored."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgraph.functions.vector import WORD_GAP
from flowgraph.operators.joins import missing_from
from flowgraph.session import materialize

DIMENSION = 384
#: Rows that are encoded in memory at a time.
ROWS_AT_ONCE = 512


def _pieces(batches):
    """The Arrow batches in pieces, so that what encoding takes does not depend on the size of a batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def _slots_of(words, dim: int):
    """(row, slot) of every word of a column of words, in order; a word is hashed once a piece: the first 32 bits of its md5, modulo ``dim``."""
    from hashlib import md5

    import numpy as np

    flat = words.flatten().dictionary_encode()
    slot_of = np.array([int(md5(w.encode()).hexdigest()[:8], 16) % dim if w else -1 for w in flat.dictionary.to_pylist()], np.int64)
    row = np.repeat(np.arange(len(words)), words.value_lengths().to_numpy(zero_copy_only=False))
    slot = slot_of[flat.indices.to_numpy(zero_copy_only=False)] if len(flat) else np.zeros(0, np.int64)
    return row[slot >= 0], slot[slot >= 0]


class HashedTextEncoder:
    """Default encoder: hashed word counts weighted by inverse document frequency, unit length.

    Words are split by built-in functions over the whole text and hashed in the task, once for each
    distinct word of a few texts; the document frequencies are one aggregation with at most ``dim``
    result rows; counting into dense rows is one numpy call for as many texts.  Fit it on the corpus
    once and use the same encoder for queries.
    """

    def __init__(self, dim: int = DIMENSION):
        self.dim = dim
        self._idf = None

    def _split(self, df: DataFrame, text: str) -> DataFrame:
        return df.withColumn("__words", F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), WORD_GAP))

    def _hashed(self, df: DataFrame, text: str) -> DataFrame:
        """``df`` with ``__slots``, those of the words of its texts in order."""
        dim, columns = self.dim, [f.name for f in df.schema.fields if f.name != "__slots"]
        schema = T.StructType([*(df.schema[c] for c in columns), T.StructField("__slots", T.ArrayType(T.LongType()))])

        def hash_words(batches):
            import numpy as np
            import pyarrow as pa

            for batch in _pieces(batches):
                row, slot = _slots_of(batch.column("__words"), dim)
                ends = np.searchsorted(row, np.arange(batch.num_rows + 1))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(slot))
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], lists], names=[*columns, "__slots"])

        return self._split(df.select(*(F.col(f"`{c}`") for c in columns)), text).mapInArrow(hash_words, schema)

    def _fit(self, hashed: DataFrame) -> None:
        seen = hashed.select(F.explode(F.array_distinct("__slots")).alias("slot")).groupBy("slot").count().collect()
        found = dict.fromkeys(range(self.dim), 0) | {r["slot"]: r["count"] for r in seen}
        n = hashed.count()
        self._idf = [math.log((n + 1) / (found[i] + 1)) for i in range(self.dim)]

    def fit(self, df: DataFrame, text: str = "text") -> "HashedTextEncoder":
        self._fit(materialize(self._hashed(df.select(F.col(text).alias("text")), "text").select("__slots"), "words"))
        return self

    def fit_encode(self, df: DataFrame, text: str = "text", name: str = "values") -> DataFrame:
        """Fit on ``df`` and encode it, splitting every text once."""
        hashed = materialize(self._hashed(df, text), "words")
        self._fit(hashed)
        return self._dense(hashed, name)

    def __call__(self, df: DataFrame, text: str = "text", name: str = "values") -> DataFrame:
        if self._idf is None:
            raise ValueError("fit the encoder first")
        return self._dense(self._split(df, text), name)

    def _dense(self, texts: DataFrame, name: str) -> DataFrame:
        """Vectors of texts that have ``__slots`` or ``__words``."""
        dim, idf, split = self.dim, self._idf, "__words" in texts.columns
        kept = [f for f in texts.schema.fields if f.name not in ("__slots", "__words", name)]
        schema = T.StructType([*kept, T.StructField(name, T.ArrayType(T.FloatType()))])
        columns = [f.name for f in kept]

        def count(batches):
            import numpy as np
            import pyarrow as pa

            weight = np.array(idf)
            for batch in _pieces(batches):
                n = batch.num_rows
                if split:
                    row, slot = _slots_of(batch.column("__words"), dim)
                else:
                    slots = batch.column("__slots")
                    row, slot = np.repeat(np.arange(n), slots.value_lengths().to_numpy(zero_copy_only=False)), slots.flatten().to_numpy()
                counts = np.bincount(row * dim + slot, minlength=n * dim)
                vectors = counts.reshape(n, dim) * weight
                length = np.linalg.norm(vectors, axis=1, keepdims=True)
                vectors = (vectors / np.where(length == 0, 1, length)).astype("float32")
                rows = pa.ListArray.from_arrays(
                    pa.array(range(0, n * dim + 1, dim), pa.int32()), pa.array(vectors.ravel(), pa.float32())
                )
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], rows], names=[*columns, name])

        return texts.mapInArrow(count, schema)


def embed(
    df: DataFrame, text: str, encoder: Callable[[], Callable], dim: int = DIMENSION, name: str = "values"
) -> DataFrame:
    """Vectors from a plugged-in model: ``encoder()`` returns a function list[str] → rows of ``dim`` numbers.

    The model is built once per task and fed pieces of Arrow batches; vectors are brought to unit length.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.ArrayType(T.FloatType()))])

    def encode(batches):
        import numpy as np
        import pyarrow as pa

        model = encoder()
        for batch in _pieces(batches):
            texts = ["" if t is None else t for t in batch.column(text).to_pylist()]
            if not texts:
                continue
            vectors = np.asarray(model(texts), dtype="float32")
            if vectors.shape != (len(texts), dim):
                raise ValueError(f"encoder returned {vectors.shape}, expected {(len(texts), dim)}")
            length = np.linalg.norm(vectors, axis=1, keepdims=True)
            vectors = vectors / np.where(length == 0, 1, length)
            flat = pa.ListArray.from_arrays(
                pa.array(range(0, len(texts) * dim + 1, dim), pa.int32()), pa.array(vectors.ravel(), pa.float32())
            )
            yield pa.RecordBatch.from_arrays([*batch.columns, flat], names=[*batch.schema.names, name])

    return df.mapInArrow(encode, schema)


def text_hash(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def embed_missing(
    records: DataFrame, stored: DataFrame, key: str, encode: Callable[[DataFrame], DataFrame], text: str | None = None
) -> DataFrame:
    """Stored vectors of the records, plus freshly encoded ones for keys without a vector.

    With ``text``, ``stored`` has the ``text_hash`` of what each vector was made from, and a record whose text has
    changed since is encoded again.
    """
    if text is None:
        kept = stored.join(records.select(key).distinct(), key, "left_semi").select(key, "values")
        return kept.unionByName(encode(missing_from(records, stored, key)).select(key, "values"))
    same = records.withColumn("text_hash", text_hash(F.col(text)))
    kept = stored.join(same.select(key, "text_hash").distinct(), [key, "text_hash"], "left_semi").select(key, "values")
    new = same.join(stored.select(key, "text_hash"), [key, "text_hash"], "left_anti").drop("text_hash")
    return kept.unionByName(encode(new).select(key, "values"))
