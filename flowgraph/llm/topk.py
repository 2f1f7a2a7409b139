"""Exact top-k by inner product with an impact-ordered, score-at-a-time index.

Vectors are quantised to integers.  In a block of candidates, every dimension keeps its rows ordered by value; rows of one
value are a posting segment, and a query gives a segment the impact value * query component.  The segments of all dimensions
are processed by descending impact.  A dimension in which a row has not been seen adds at most the next impact to it, so its
score has an upper bound.  Rows whose bound reaches the k-th best exact score so far are the possible members.  A query stops
when scoring them exactly is cheaper than going on (a quarter of the block), and then scores every one of them; without that
proof it scores the whole block.

Queries and candidates are dealt in blocks of bounded size; a task holds one block of each.  Equal vectors in a block form
one posting row that carries its ids, of which no more than k can matter to any query.

Vectors that are null, empty, or hold null or non-finite components take no part, as queries or candidates.  Queries and
candidates of different lengths never meet.  Ties go to the smaller id.  A query row is no candidate for itself; further
rows with its id are none either.  An empty side gives an empty table.  Scores must fit 64-bit whole numbers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CANDIDATES_A_BLOCK = 1 << 16
QUERIES_A_BLOCK = 512
#: Shares of all postings after which the bounds are looked at.
LEVELS = (0.25, 0.5, 0.75)


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component as double precision; null unless every component is a finite number."""
    values = F.transform(vector, lambda x: x.cast("double"))
    fine = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & (F.size(values) > 0)
    return F.when(fine, F.transform(values, lambda x: F.floor(x * float(scale)).cast("long")))


class ImpactIndex:
    """Posting segments of distinct integer vectors (rows of ``vectors``)."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors.astype(float)
        n, self.dim = vectors.shape
        self.order = np.ascontiguousarray(np.argsort(vectors, axis=0, kind="stable").T)
        segments = []
        for d in range(self.dim):
            column = vectors[self.order[d], d]
            first = np.concatenate([[0], np.flatnonzero(np.diff(column)) + 1])
            segments.append(np.stack([np.full(len(first), d), column[first], first, np.append(first[1:], n)]))
        self.dims, self.values, self.begins, self.ends = np.concatenate(segments, axis=1).astype(np.int64)
        self.sizes = self.ends - self.begins

    def search(self, query: np.ndarray, k: int, enough: int) -> np.ndarray:
        """Rows that may be among the k best vectors; every one that is, is there."""
        n = len(self.vectors)
        if n <= enough:
            return np.arange(n)
        impact = query[self.dims] * self.values
        by_impact = np.argsort(-impact, kind="stable")
        done = np.cumsum(self.sizes[by_impact])
        # One sum holds both a row's impacts and how many dimensions it has been seen in: both are whole numbers.
        unit = float(1 << int(2 * self.dim * max(1, np.abs(impact).max())).bit_length())
        if unit * self.dim >= 1 << 53:
            return np.arange(n)
        both, at = np.zeros(n), 0
        for share in LEVELS:
            stop = int(np.searchsorted(done, share * n * self.dim)) + 1
            batch = by_impact[at:stop]
            if len(batch):
                rows = np.concatenate([self.order[d, b:e] for d, b, e in zip(*(x[batch].tolist() for x in (self.dims, self.begins, self.ends)))])
                both += np.bincount(rows, np.repeat(impact[batch] + unit, self.sizes[batch]), n)
            at = max(at, stop)
            if at >= len(by_impact):
                break
            seen = np.rint(both / unit)
            # No segment that is left has a greater impact than the next one.
            bound = (both - seen * unit) + (self.dim - seen) * impact[by_impact[at]]
            some = max(k, min(n - 1, 16 * k))
            top = np.argpartition(-bound, some)[:some]
            exact = self.vectors[top] @ query
            least = np.partition(exact, len(exact) - k)[len(exact) - k]
            possible = np.flatnonzero(bound >= least)
            if len(possible) <= enough:
                return possible
        return np.arange(n)


def block_topk(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> tuple:
    """(query ids, candidate ids, scores) of the k best candidates of each query, ties to the smaller id."""
    order = np.argsort(ids, kind="stable")
    vectors, ids = vectors[order], ids[order]
    distinct, group = np.unique(vectors, axis=0, return_inverse=True)
    group = group.ravel()
    by_group = np.argsort(group, kind="stable")  # ids stay in order within a group
    starts = np.searchsorted(group[by_group], np.arange(len(distinct) + 1))
    index = ImpactIndex(distinct)
    enough = max(256, 8 * (k + 1), len(distinct) // 4)
    small = index.dim * float(np.abs(distinct).max()) * float(np.abs(queries).max()) < 1 << 53  # else floats lose digits
    found: tuple[list, list, list] = ([], [], [])
    for query, own in zip(queries.astype(float), query_ids):
        # One more than k, since one of the best may be the query's own vector.
        rows = index.search(query, k + 1, enough)
        score = np.rint(index.vectors[rows] @ query).astype(np.int64) if small else distinct[rows] @ query.astype(np.int64)
        if len(rows) > k + 1:
            least = np.partition(score, len(score) - k - 1)[len(score) - k - 1]
            keep = score >= least
            rows, score = rows[keep], score[keep]
        members, scores = [], []
        for row, s in zip(rows, score):
            some = ids[by_group[starts[row] : min(starts[row + 1], starts[row] + k + 1)]]
            members.append(some)
            scores.append(np.full(len(some), s))
        member, score = np.concatenate(members), np.concatenate(scores)
        other = member != own
        member, score = member[other], score[other]
        best = np.lexsort((member, -score))[:k]
        found[0].append(np.full(len(best), own))
        found[1].append(member[best])
        found[2].append(score[best])
    return tuple(np.concatenate(x).astype(np.int64) for x in found)


def search(
    vectors: DataFrame, queries: DataFrame, k: int, scale: int = 64, id: str = "vec_id", vector: str = "embedding",
    candidates_a_block: int = CANDIDATES_A_BLOCK, queries_a_block: int = QUERIES_A_BLOCK,
) -> DataFrame:
    """(query_id, rank, id, score) of the k best rows of ``vectors`` for every row of ``queries``."""

    def ready(df: DataFrame) -> DataFrame:
        return df.select(F.col(f"`{id}`").cast("long").alias("id"), quantised(F.col(f"`{vector}`"), scale).alias("v")).where("id is not null and v is not null")

    candidates, asked = ready(vectors), ready(queries)
    blocks = max(1, -(-candidates.count() // candidates_a_block))
    query_blocks = max(1, -(-asked.count() // queries_a_block))
    salt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks))
    asked = asked.withColumn("q", F.pmod(F.xxhash64("id"), F.lit(query_blocks)))
    asked = asked.withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>"))).withColumn("asks", F.lit(True))
    candidates = candidates.withColumn("c", salt)
    candidates = candidates.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)).cast("array<bigint>"))).withColumn("asks", F.lit(False))
    columns = ["q", "c", "asks", "id", "v"]
    schema = "query_id long, vec_id long, score long"

    def run(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy()
        ids = table.column("id").to_numpy()
        flat = table.column("v").combine_chunks()
        sizes = np.diff(flat.offsets.to_numpy())
        values, starts = flat.values.to_numpy(), flat.offsets.to_numpy()[:-1]
        out: tuple[list, list, list] = ([], [], [])
        for size in np.unique(sizes):
            matrix = values[starts[sizes == size][:, None] + np.arange(size)]
            mine, own = asks[sizes == size], ids[sizes == size]
            if mine.any() and not mine.all():
                for column, part in zip(out, block_topk(matrix[mine], own[mine], matrix[~mine], own[~mine], k)):
                    column.append(part)
        return pa.table({n: np.concatenate(c) if c else np.zeros(0, np.int64) for n, c in zip(("query_id", "vec_id", "score"), out)})

    pairs = asked.select(columns).unionByName(candidates.select(columns)).groupBy("q", "c").applyInArrow(run, schema)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = pairs.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("vec_id").alias(id if id != "query_id" else "vec_id"), "score")
