"""Whole-text helpers shared by the operators: Arrow batches, words, and per-row results.

Every operator sees a text column through :func:`map_texts`.  A null text counts as empty, and only the columns named
in ``keep`` are carried, so further columns of the input (whatever their names) neither clash nor cost anything.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that one step inside a task handles at a time; one longer text is a step of its own.
SLICE_BYTES = 2 << 20
#: Rows that Spark hands to a task at a time; whole texts are large rows.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Lower the rows of an Arrow batch from Spark's default, which counts rows whatever their size."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges (start, stop) of at most ``limit`` bytes, whole texts only."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    start, total = 0, 0
    for row, size in enumerate(sizes):
        if total and total + size > limit:
            yield start, row
            start, total = row, 0
        total += int(size)
    if start < len(sizes):
        yield start, len(sizes)


def map_texts(
    docs: DataFrame,
    text: str,
    keep: Sequence[str],
    fields: Sequence[T.StructField],
    make: Callable[[], Callable],
) -> DataFrame:
    """Columns ``keep`` of ``docs`` followed by ``fields``, which ``make()(texts)`` returns.

    ``make`` runs once a task and gives a function from a string array without nulls to a dict of columns; a key
    ``None`` holds the row number of each result row where a text has any number of them.
    """
    small_batches(docs.sparkSession)
    kept = [docs.schema[name] for name in keep]
    schema = T.StructType([*(T.StructField(f"k{i}", f.dataType) for i, f in enumerate(kept)), *fields])
    names = [f.name for f in fields]

    def run(batches):
        apply = make()
        for batch in batches:
            texts = pc.fill_null(batch.column(batch.num_columns - 1).cast(pa.string()), "")
            for start, stop in slices(texts):
                found = apply(texts.slice(start, stop - start))
                rows = found.pop(None, None)
                columns = [batch.column(i).slice(start, stop - start) for i in range(len(kept))]
                if rows is not None:
                    take = pa.array(rows)
                    columns = [c.take(take) for c in columns]
                columns += [found[n] if isinstance(found[n], pa.Array) else pa.array(found[n]) for n in names]
                yield pa.RecordBatch.from_arrays(columns, schema.names)
                pa.default_memory_pool().release_unused()

    narrow = docs.select(
        *(F.col(f"`{f.name}`").alias(f"k{i}") for i, f in enumerate(kept)), F.col(f"`{text}`").cast("string").alias("t")
    )
    out = narrow.mapInArrow(run, schema)
    return out.select(*(F.col(f"k{i}").alias(f.name) for i, f in enumerate(kept)), *names)


def split_words(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as (offsets per text, code per word, distinct words), A-Z lower-cased if asked."""
    if lower:
        texts = pc.ascii_lower(texts)
    parts = pc.ascii_split_whitespace(texts)
    ends = parts.offsets.to_numpy().astype(np.int64)
    coded = parts.values.slice(ends[0], ends[-1] - ends[0]).dictionary_encode()
    codes, words = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
    ends = ends - ends[0]
    empty = pc.index(words, pa.scalar("", words.type)).as_py()
    if empty >= 0:  # before the first and after the last word
        full = codes != empty
        ends = np.concatenate([[0], np.cumsum(full)])[ends]
        codes = codes[full]
    return ends, codes.astype(np.int64), words


def crc32_mod(column: str, mod: int) -> Column:
    """crc32 of the id written as text, modulo ``mod``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(mod))
