"""Exact top-k cosine join of a table of query vectors with a table of vectors.

Three ways, chosen by measured size, all with the same result:

* the corpus fits ``BROADCAST_BYTES``: it is broadcast, every query is answered inside its task;
* the queries fit: they are broadcast, every task keeps its k best per query, a window merges them;
* neither fits: vectors are grouped around pivots into rings, and a query block meets only the
  corpus blocks that the triangle inequality cannot rule out for its k best.  Where that rules out
  so little that queries would be copied more often than a rotation reads vectors, the queries are
  broadcast a batch at a time instead, and meet the corpus where it lies.

Before a broadcast of queries the k-th best hit in a sample of a large corpus (or, in a rotation, in the
nearest ring) is a lower bound for each query, so a task sends on only what may be among the k best of all.

Spark moves the rows; inside a task the comparison is one matrix product per Arrow batch.
Similarities are compared at 12 decimals, so equal vectors tie and the smaller id wins.
A zero vector has similarity 0 to everything.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgraph.operators.joins import top_k_per_group
from flowgraph.session import delete_path, materialize, new_path

BROADCAST_BYTES = 32 * 1024 * 1024
BLOCK_ROWS = 8192
#: Blocks grow with the corpus to a 16th of it, so that a row is not copied ever more often, until their vectors reach so many bytes.
BLOCK_SHARE = 16
BLOCK_BYTES = 16 * 1024 * 1024
PIVOTS = 256
#: Angles that a cell is counted by, from 0 to pi.
RING_BINS = 2048
#: Tasks of a scan from which on a sample bounds the broadcast queries first.
SAMPLED_FROM = 64
#: Bytes that a task keeps for each of the k best of a query, twice while it merges.
HELD_BYTES = 48


def _tools(k: int, floor: float | None):
    """Small numpy helpers; nested so that they travel to the workers with the task."""
    import numpy as np
    import pyarrow as pa

    def matrix(column):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        flat = np.asarray(column.flatten(), dtype="float64").reshape(len(column), -1)
        norm = np.sqrt((flat * flat).sum(axis=1, keepdims=True))
        return flat / np.where(norm == 0, 1.0, norm)

    def ids(column):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        return column.to_numpy(zero_copy_only=False)

    def first_k(q, names, sims):
        """Positions of the k best (highest similarity, then smallest id) of every query."""
        codes = np.unique(names, return_inverse=True)[1]
        order = np.lexsort((codes, -sims, q))
        sorted_q = q[order]
        starts = np.r_[0, np.flatnonzero(np.diff(sorted_q)) + 1] if len(q) else np.zeros(0, int)
        run = np.repeat(starts, np.diff(np.r_[starts, len(q)])) if len(q) else starts
        return order[np.arange(len(q)) - run < k]

    def groups(vectors):
        """Number of every row's group of equal vectors, and the number of groups."""
        rows = np.ascontiguousarray(vectors)
        if len(np.unique(rows[:, 0])) == len(rows):
            return np.arange(len(rows)), len(rows)
        raw = rows.view(np.dtype((np.void, rows.dtype.itemsize * rows.shape[1]))).ravel()
        distinct, group = np.unique(raw, return_inverse=True)
        return group, len(distinct)

    def thin(vectors, names):
        """At most k copies of a vector, those with the smallest ids: no query can ever keep more."""
        if len(vectors) == 0:
            return vectors, names
        group, n = groups(vectors)
        if n == len(vectors):
            return vectors, names
        keep = first_k(group, names, np.zeros(len(names)))
        return vectors[keep], names[keep]

    def best(queries, vectors, names, least=None):
        """(query position, id, similarity) of the k best per query; ``least`` raises the bar per query.

        Equal queries are answered once.
        """
        if len(queries) == 0:
            return np.zeros(0, int), names[:0], np.zeros(0)
        group, n = groups(queries)
        if n == len(queries):
            return answer(queries, vectors, names, least)
        one = np.zeros(n, int)
        one[group] = np.arange(len(queries))
        q, name, sims = answer(queries[one], vectors, names, None if least is None else least[one])
        size = np.bincount(q, minlength=n)
        start = (np.cumsum(size) - size)[group]
        size = size[group]
        pick = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return np.repeat(np.arange(len(queries)), size), name[pick], sims[pick]

    def answer(queries, vectors, names, least):
        """Single precision picks candidates with a wide margin; only those are computed exactly."""
        margin = 1e-4
        bar = np.full(len(queries), -np.inf if floor is None else floor)
        bar = (bar if least is None else np.maximum(bar, least)) - margin
        rough_q, rough_v = queries.astype("float32"), np.ascontiguousarray(vectors.T.astype("float32"))
        found = []
        step = max(1, 4_000_000 // max(1, len(vectors)))
        for a in range(0, len(queries), step):
            rough = rough_q[a : a + step] @ rough_v
            keep = rough >= bar[a : a + step, None]
            crowded = keep.sum(axis=1) > k
            if crowded.any():
                part = rough[crowded]
                keep[crowded] &= part >= np.partition(part, -k, axis=1)[:, -k, None] - margin
            q, c = np.nonzero(keep)
            sims = np.empty(len(q))
            for i in range(0, len(q), 32768):
                piece = slice(i, i + 32768)
                sims[piece] = np.einsum("ij,ij->i", queries[a + q[piece]], vectors[c[piece]])
            sims = np.round(sims, 12)
            if floor is not None:
                q, c, sims = (part[sims >= floor] for part in (q, c, sims))
            pick = first_k(q, names[c], sims)
            found.append((q[pick] + a, names[c[pick]], sims[pick]))
        if not found:
            return np.zeros(0, int), names[:0], np.zeros(0)
        return tuple(np.concatenate(part) for part in zip(*found))

    return matrix, ids, first_k, thin, best


def _if_small(df: DataFrame, id: str, vector: str, limit_rows: int | None):
    """The whole table as Arrow when its vectors and ids fit the broadcast limit, else None.

    The limit holds for the longest vector in every row; a vector takes 8 bytes a number once it is broadcast.
    """
    size = df.agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.size(vector)).alias("numbers"), F.sum(F.octet_length(F.col(id).cast("string"))).alias("ids")
    ).first()
    if limit_rows is None:
        fits = size["rows"] * 8 * max(1, size["numbers"] or 0) + (size["ids"] or 0) <= BROADCAST_BYTES
    else:
        fits = size["rows"] <= limit_rows
    return df.toArrow() if fits else None


def knn(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    min_similarity: float | None = None,
    broadcast_rows: int | None = None,
    block_rows: int = BLOCK_ROWS,
    pivots: int = PIVOTS,
    rotate: bool | None = None,
    sampled_from: int = SAMPLED_FROM,
    plain_scans: bool = False,
) -> DataFrame:
    """``queries(query_id, query_vec)`` × ``corpus(id, values)`` → (query_id, id, similarity, rank).

    ``broadcast_rows`` replaces the byte limit of the broadcast ways, also for the queries of one turn of a rotation, of
    which one scan serves as many as fit the byte limit; blocks have ``block_rows`` rows, or more in a large corpus;
    ``rotate`` decides between rotation and blocks where both sides are large, which is else decided by their cost.
    Both inputs are written once before they are read several times, unless ``plain_scans`` says that they are mere scans.
    """
    queries = queries.select("query_id", "query_vec").filter(F.col("query_vec").isNotNull())
    corpus = corpus.select("id", "values").filter(F.col("values").isNotNull())
    if not plain_scans:  # the search reads both several times
        queries, corpus = materialize(queries, "queries"), materialize(corpus, "vectors")
    schema = T.StructType(
        [
            T.StructField("query_id", queries.schema["query_id"].dataType),
            T.StructField("id", corpus.schema["id"].dataType),
            T.StructField("similarity", T.DoubleType()),
        ]
    )
    small = _if_small(corpus, "id", "values", broadcast_rows)
    if small is not None:
        hits = _stream_queries(queries, small, k, min_similarity, schema)
    else:
        small = _if_small(queries, "query_id", "query_vec", broadcast_rows)
        if small is not None:
            least = _sample_bounds(small, corpus, k, min_similarity, schema, sampled_from)
            hits = _stream_corpus(small, corpus, k, min_similarity, schema, least)
        else:
            hits = _blocks(queries, corpus, k, min_similarity, schema, block_rows, pivots, broadcast_rows, rotate)
    return top_k_per_group(hits, "query_id", [F.desc("similarity"), F.asc("id")], k)


def _stream_queries(queries, corpus_rows, k, floor, schema):
    matrix, ids, _, thin, best = _tools(k, floor)
    held = queries.sparkSession.sparkContext.broadcast(
        thin(matrix(corpus_rows["values"]), ids(corpus_rows["id"])) if corpus_rows.num_rows else None
    )
    id_type = corpus_rows["id"].type

    def answer(batches):
        import pyarrow as pa

        for batch in batches:
            if held.value is None or batch.num_rows == 0:
                continue
            vectors, names = held.value
            q, name, sims = best(matrix(batch.column(1)), vectors, names)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(q)), pa.array(name, id_type), pa.array(sims)],
                names=["query_id", "id", "similarity"],
            )

    return queries.mapInArrow(answer, schema)


def _sample_bounds(query_rows, corpus, k, floor, schema, sampled_from):
    """The k-th best similarity of every query row in a hashed sample of the corpus, or None for a scan of few tasks.

    At least k vectors are as near, so nothing below is among the k best.  A scan of n tasks without bounds sends on n times
    the k best; a sample of one row in sqrt(n), read by sqrt(n) tasks, and then the bounded scan send about sqrt(n) times each.
    """
    import numpy as np

    tasks = corpus.rdd.getNumPartitions()
    if tasks < sampled_from or query_rows.num_rows == 0:
        return None
    share = math.isqrt(tasks)
    sample = corpus.filter(F.pmod(F.xxhash64("id", F.lit(2)), F.lit(share)) == 0).coalesce(-(-tasks // share))
    numbered = query_rows.set_column(query_rows.schema.get_field_index("query_id"), "query_id", [np.arange(query_rows.num_rows)])
    numbers = T.StructType([T.StructField("query_id", T.LongType()), *schema.fields[1:]])
    hits = top_k_per_group(_stream_corpus(numbered, sample, k, floor, numbers), "query_id", [F.desc("similarity"), F.asc("id")], k)
    found = hits.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("similarity").alias("least")).where(F.col("n") >= k).toArrow()
    least = np.full(query_rows.num_rows, -np.inf)
    least[found["query_id"].to_numpy()] = found["least"].to_numpy()
    return least


def _stream_corpus(query_rows, corpus, k, floor, schema, bounds=None):
    """Hits of broadcast queries; nothing below a query's bound is among them."""
    matrix, ids, first_k, thin, best = _tools(k, floor)
    held = corpus.sparkSession.sparkContext.broadcast(
        (ids(query_rows["query_id"]), matrix(query_rows["query_vec"]), bounds) if query_rows.num_rows else None
    )
    query_type = query_rows["query_id"].type

    def scan(batches):
        import numpy as np
        import pyarrow as pa

        if held.value is None:
            return
        query_ids, vectors, bounds = held.value
        state, id_type = None, None
        known = np.full(len(vectors), -np.inf) if bounds is None else bounds
        least = known
        for batch in batches:
            if batch.num_rows == 0:
                continue
            id_type = batch.column(0).type
            new = best(vectors, *thin(matrix(batch.column(1)), ids(batch.column(0))), least)
            if state is not None:
                new = tuple(np.concatenate(pair) for pair in zip(state, new))
            pick = first_k(*new)
            state = tuple(part[pick] for part in new)
            full = np.bincount(state[0], minlength=len(vectors)) >= k
            lowest = np.full(len(vectors), np.inf)
            np.minimum.at(lowest, state[0], state[2])
            least = np.where(full, np.maximum(lowest, known), known)
        if state is not None:
            above = state[2] >= known[state[0]]
            state = tuple(part[above] for part in state)
            yield pa.RecordBatch.from_arrays(
                [pa.array(query_ids[state[0]], query_type), pa.array(state[1], id_type), pa.array(state[2])],
                names=["query_id", "id", "similarity"],
            )

    return corpus.mapInArrow(scan, schema)


def _turns(queries, k, batch_rows) -> int:
    """Batches of queries whose vectors, and what a task holds of their hits, fit the broadcast limit."""
    size = queries.agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.size("query_vec")).alias("numbers"), F.sum(F.octet_length(F.col("query_id").cast("string"))).alias("ids")
    ).first()
    if batch_rows is not None:
        return max(1, math.ceil(size["rows"] / batch_rows))
    held = size["rows"] * (8 * max(1, size["numbers"] or 0) + HELD_BYTES * k) + (size["ids"] or 0)
    return max(1, math.ceil(held / BROADCAST_BYTES))


def _rotation(bounded, corpus, k, floor, schema, turns):
    """Both sides large and little to rule out: ``bounded(query_id, query_vec, least)`` in ``turns`` batches over the corpus.

    No vector is shuffled: the corpus is read by tasks that each keep the k best of the queries they are given.  Turns that fit
    the byte limit together are one turn, however small each of them is, so scans are as few as memory allows.
    Rows are dealt to turns by their place in the table, whatever their ids.
    """
    import numpy as np

    spark = corpus.sparkSession
    asked, found = new_path(spark, "turns"), new_path(spark, "turn-hits")
    scans = min(turns, _turns(bounded, k, None))
    dealt = bounded.select("query_id", "query_vec", "least", F.pmod(F.monotonically_increasing_id(), F.lit(scans)).cast("int").alias("turn"))
    dealt.write.partitionBy("turn").parquet(asked)
    for turn in range(scans):
        rows = spark.read.schema(dealt.schema).parquet(asked).where(F.col("turn") == turn).drop("turn").toArrow()
        least = np.nan_to_num(rows["least"].to_numpy().astype("float64"), nan=-np.inf)
        hits = _stream_corpus(rows, corpus, k, floor, schema, least)
        top_k_per_group(hits, "query_id", [F.desc("similarity"), F.asc("id")], k).drop("rank").write.mode("append").parquet(found)
    delete_path(spark, asked)
    return spark.read.schema(schema).parquet(found)


def _blocks(queries, corpus, k, floor, schema, block_rows, n_pivots, batch_rows=None, rotate=None):
    """Both sides large: block against block, without the pairs of blocks that cannot hold a hit.

    A vector belongs to its nearest pivot's cell, and cells are cut into rings by the angle to their pivot, with angles as
    distances.  A query at angle d from a pivot has no hit within ``reach`` in a ring outside [d - reach, d + reach].  The
    reach of a query comes from ``min_similarity`` or, where that is less, from its k-th best hit in the one ring around
    itself, which is searched first.  Rings and the queries around a pivot are cut by id hash into blocks of about
    ``block_rows``, so no task gets a whole hot ring.  A query is copied once for every block it meets and a block once for every
    piece of queries, so in a large corpus blocks are as large as a task can hold.
    """
    import numpy as np

    spark = corpus.sparkSession
    sc = spark.sparkContext
    matrix, ids, _, thin, best = _tools(k, floor)
    farthest = math.acos(min(1.0, max(-1.0, floor))) + 1e-9 if floor is not None and floor > 0 else math.pi + 1

    if floor is not None and floor > 0:
        # Zero vectors reach nothing above 0 and have no direction to sort by.
        def nonzero(c):
            return F.exists(c, lambda v: v != 0)

        queries, corpus = queries.filter(nonzero("query_vec")), corpus.filter(nonzero("values"))

    # Any vectors do as pivots; a hash keeps about four times as many candidates as needed, so
    # that only those are sorted.  A vector that is not a pivot is still compared in full.
    rows = corpus.count()
    share = max(1, rows // (4 * n_pivots))
    drawn = corpus.filter(F.pmod(F.xxhash64("id"), F.lit(share)) == 0)
    points = matrix(drawn.orderBy(F.xxhash64("id", F.lit(1)), "id").limit(n_pivots).toArrow()["values"])
    if len(points) == 0:
        points = matrix(corpus.limit(1).toArrow()["values"])
    held = sc.broadcast(points)
    if len(points):
        block_rows = max(block_rows, min(rows // BLOCK_SHARE, BLOCK_BYTES // (8 * max(1, points.shape[1]))))
    bins = RING_BINS

    def angles_of(column):
        import numpy as np

        return np.arccos(np.clip(matrix(column) @ held.value.T, -1, 1))

    def near(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows == 0:
                continue
            angles = angles_of(batch.column(1))
            cell, angle = angles.argmin(axis=1), angles.min(axis=1)
            slot = cell * bins + np.minimum((angle * (bins / np.pi)).astype(int), bins - 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(slot, pa.int32())], names=["id", "values", "slot"]
            )

    placed_schema = T.StructType([corpus.schema["id"], corpus.schema["values"], T.StructField("slot", T.IntegerType())])
    placed = materialize(corpus.mapInArrow(near, placed_schema), "placed")
    # At most pivots x bins rows: vectors by cell and angle.  Neighbouring bins of a cell make a ring.
    counted = placed.groupBy("slot").agg(F.count(F.lit(1)).alias("n")).toArrow()
    slots, sizes = counted["slot"].to_numpy(), counted["n"].to_numpy()
    order = np.argsort(slots)
    ring_of = np.full(len(points) * bins, -1, np.int32)
    rings: list[list] = []  # cell, least angle, greatest angle, vectors
    for slot, n in zip(slots[order].tolist(), sizes[order].tolist()):
        cell, at = divmod(slot, bins)
        if not rings or rings[-1][0] != cell or rings[-1][3] + n > block_rows:
            rings.append([cell, at * math.pi / bins, 0.0, 0])
        rings[-1][2] = (at + 1) * math.pi / bins
        rings[-1][3] += n
        ring_of[slot] = len(rings) - 1
    if not rings:
        return spark.createDataFrame([], schema)
    cells = np.array([r[0] for r in rings])
    low, high = (np.array([r[i] for r in rings]) for i in (1, 2))
    pieces = np.array([math.ceil(r[3] / block_rows) for r in rings])
    layout = sc.broadcast((ring_of, cells, low - 1e-9, high + 1e-9, pieces, np.cumsum(pieces) - pieces))

    def block_of(batches):
        import pyarrow as pa

        ring_of, _, _, _, pieces, first = layout.value
        for batch in batches:
            ring = ring_of[batch.column(2).to_numpy()]
            block = first[ring] + batch.column(3).to_numpy() % pieces[ring]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(block)], names=["id", "values", "block"])

    blocked_schema = T.StructType([corpus.schema["id"], corpus.schema["values"], T.StructField("block", T.LongType())])
    hashed = placed.withColumn("h", F.xxhash64("id").bitwiseAND((1 << 62) - 1)).select("id", "values", "slot", "h")
    blocked = hashed.mapInArrow(block_of, blocked_schema)

    def router(own: bool):
        def route(batches):
            import numpy as np
            import pyarrow as pa

            ring_of, cells, low, high, pieces, first = layout.value
            for batch in batches:
                if batch.num_rows == 0:
                    continue
                angles = angles_of(batch.column(1))
                reach = batch.column(2).to_numpy(zero_copy_only=False)
                query, ring = [], []
                step = max(1, 4_000_000 // len(cells))
                for a in range(0, len(angles), step):
                    d = angles[a : a + step][:, cells]
                    if own:  # the ring that is nearest in the cell of the nearest pivot, or anywhere if that is empty
                        away = np.maximum(np.maximum(low - d, d - high), 0)
                        away += 10 * (cells != angles[a : a + step].argmin(axis=1)[:, None])
                        q, r = np.arange(len(d)), away.argmin(axis=1)
                    else:
                        far = reach[a : a + step, None]
                        q, r = np.nonzero((d + far >= low) & (d - far <= high))
                    query.append(q + a)
                    ring.append(r)
                query, ring = np.concatenate(query), np.concatenate(ring)
                n = np.ones(len(ring), int) if own else pieces[ring]
                block = np.repeat(first[ring], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                hits = np.bincount(np.repeat(query, n), minlength=len(angles))
                offsets = pa.array(np.concatenate([[0], np.cumsum(hits)]), pa.int32())
                blocks = pa.ListArray.from_arrays(offsets, pa.array(block.astype(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(angles.argmin(axis=1), pa.int32()), blocks],
                    names=["query_id", "query_vec", "home", "blocks"],
                )

        return route

    route_schema = T.StructType(
        [
            queries.schema["query_id"],
            queries.schema["query_vec"],
            T.StructField("home", T.IntegerType()),
            T.StructField("blocks", T.ArrayType(T.LongType())),
        ]
    )
    key = ["home", "piece", "block"]

    def compare(query_block, corpus_block):
        import pyarrow as pa

        if query_block.num_rows == 0 or corpus_block.num_rows == 0:
            return pa.table({"query_id": query_block["query_id"][:0], "id": corpus_block["id"][:0], "similarity": pa.array([], pa.float64())})
        q, name, sims = best(
            matrix(query_block["query_vec"]), *thin(matrix(corpus_block["values"]), ids(corpus_block["id"]))
        )
        return pa.table(
            {
                "query_id": query_block["query_id"].combine_chunks().take(pa.array(q)),
                "id": pa.array(name, corpus_block["id"].type),
                "similarity": pa.array(sims),
            }
        )

    def routes(asked, own: bool):
        return materialize(asked.select("query_id", "query_vec", "reach").mapInArrow(router(own), route_schema), "routed")

    def searched(routed):
        # Queries of one home are cut, so that a block meets a bounded number of them at a time.
        homes = routed.groupBy("home").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(block_rows))).alias("pieces"))
        left = routed.join(F.broadcast(homes), "home").select(
            "home", F.pmod(F.xxhash64("query_id"), F.col("pieces")).alias("piece"), F.explode("blocks").alias("block"), "query_id", "query_vec"
        )
        met = left.select(*(F.col(c).alias(f"to_{c}") for c in key)).distinct()
        right = blocked.join(met, F.col("block") == F.col("to_block")).select(*(f"to_{c}" for c in key), "id", "values")
        return left.groupBy(*key).cogroup(right.groupBy(*(f"to_{c}" for c in key))).applyInArrow(compare, schema)

    everywhere = queries.withColumn("reach", F.lit(float(farthest)))
    nearby = searched(routes(everywhere, True)).groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("similarity").alias("least"))
    nearby = materialize(nearby.where(F.col("n") >= k), "bounds").select("query_id", "least")
    bounded = queries.join(nearby, "query_id", "left").select(
        "query_id", "query_vec", F.least(F.lit(float(farthest)), F.coalesce(F.acos(F.col("least")) + 1e-6, F.lit(float(farthest)))).alias("reach"), "least"
    )
    routed = routes(bounded, False) if not rotate else None
    turns = _turns(queries, k, batch_rows) if rotate is not False else None
    if rotate is None:
        copies = routed.agg(F.sum(F.size("blocks")).alias("n")).first()["n"] or 0
        rotate = copies > turns * sum(r[3] for r in rings)
    return _rotation(bounded, corpus, k, floor, schema, turns) if rotate else searched(routed)
