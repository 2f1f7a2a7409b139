"""Near-equal vectors of one label by cosine: a pigeonhole join over blocks of rotated dimensions.

Unit vectors of cosine c lie 2 - 2c apart, squared.  They are rotated at random, so that this distance is spread over the
dimensions, and cut into blocks of ``BLOCK_DIMS``; of two linked vectors some block holds no more than its share of the
squared distance, in proportion to its dimensions.  Each block is range-joined by itself: its dimensions are cut at dyadic
quantiles into cells of about ``CELL_ROWS`` vectors, a vector is at home in one cell and visits every cell that its share
can reach, and what meets in a cell within the share is verified by the cosine in double precision.  A pair belongs to the
first block whose share holds it and to the home of its smaller number, so every link is counted once.

Rotated coordinates are rounded to 16 bits and the shares widened by the rounding, so distances are exact whole numbers and
alike in every task.  Quantiles come from ``SAMPLE_ROWS`` vectors; they balance cells and decide nothing else.  A cell with
more rows is cut into chunks which meet two by two.  Equal vectors are one class with a count.  A task returns the links of
each vector as a number, and a spanning forest, never its pairs.

Vectors that are null, empty or zero, hold null or non-finite components, or have no label link with nothing; so do vectors
of different lengths.  Rows of one id are linked each; a null id is nobody's smallest.  An empty table gives an empty table;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgraph.llm.components import components
from flowgraph.session import materialize

LEAST = 0.98
BLOCK_DIMS = 8
CELL_ROWS = 4096
SAMPLE_ROWS = 8192
#: Whole numbers that a coordinate of a unit vector is rounded to, on each side of 0.
UNIT = 32767
#: A dimension has up to 2 ** MOST_BITS intervals; quantiles are known at this step.
MOST_BITS = 6
#: Rows in one Arrow batch of cell members, and vectors compared at a time with all others of a group.
BATCH, TILE = 8192, 512
#: Hot cells (rows of 40 bytes) that are broadcast; more of them are joined by a shuffle.
HOT_CELLS = 100_000

KEYS = ["label", "d", "block", "cell"]


def rotation(d: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(d).standard_normal((d, d)))[0]


def units(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision, whatever their size."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def blocks_of(d: int) -> list[slice]:
    return [slice(a, min(a + BLOCK_DIMS, d)) for a in range(0, d, BLOCK_DIMS)]


def share(size: int, d: int, least: float) -> int:
    """Squared distance, in rounded coordinates, that ``size`` of ``d`` dimensions may hold of the whole."""
    return int((np.sqrt((2 - 2 * least) * size / d) * UNIT + 1.001 * np.sqrt(size) + 0.001) ** 2) + 1


def bits_of(depth: int, size: int) -> list[int]:
    """Bits of a cell's name that each dimension of a block gives."""
    return [min(MOST_BITS, depth // size + (i < depth % size)) for i in range(size)]


def cells(rotated: np.ndarray, cuts: np.ndarray, depth: int, budget: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, cell, at home) of every cell that lies within ``budget`` of a row of ``rotated`` (one block's dimensions)."""
    row, far = np.arange(len(rotated)), np.zeros(len(rotated))
    cell, home = np.zeros(len(rotated), np.int64), np.ones(len(rotated), bool)
    for dim, bits in enumerate(bits_of(depth, rotated.shape[1])):
        if not bits:
            continue
        step = 1 << (MOST_BITS - bits)
        edges = cuts[dim, step - 1 :: step][: (1 << bits) - 1]
        x = rotated[row, dim].astype(float)
        own = np.searchsorted(edges, x, side="right")
        parts = []
        for j in range(1 << bits):
            away = np.zeros(len(x))
            if j:
                away = np.maximum(away, edges[j - 1] - x)
            if j < len(edges):
                away = np.maximum(away, x - edges[j])
            near = np.flatnonzero(far + away * away <= budget)
            parts.append((row[near], (far + away * away)[near], cell[near] << bits | j, home[near] & (own[near] == j)))
        row, far, cell, home = (np.concatenate(p) for p in zip(*parts))
    return row, cell, home


def _matrix(lists: pa.ListArray) -> np.ndarray:
    """Lists of one length as a matrix."""
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1)


def _lists(matrix: np.ndarray) -> pa.ListArray:
    ends = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(matrix).ravel()))


def quantiles(vectors: list[np.ndarray]) -> dict[int, np.ndarray]:
    """For each length of sampled vectors: dyadic quantiles of each rotated, rounded dimension."""
    found = {}
    for d in {len(v) for v in vectors}:
        x = np.rint(units(np.array([v for v in vectors if len(v) == d], float)) @ rotation(d) * UNIT)
        found[d] = np.quantile(x, np.arange(1, 1 << MOST_BITS) / (1 << MOST_BITS), axis=0).T
    return found


def _members(cuts: dict[int, np.ndarray], least: float, carry: bool):
    """Arrow batches of classes to batches of their places in cells, with vectors and rounded coordinates if asked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            d, depth = batch.column("d").to_numpy(), batch.column("depth").to_numpy()
            for size, deep in {*zip(d.tolist(), depth.tolist())}:
                rows = pa.array(np.flatnonzero((d == size) & (depth == deep)))
                vectors = batch.column("vector").take(rows)
                if size not in turns:
                    turns = {size: rotation(size)}
                rotated = np.rint(units(_matrix(vectors).astype(float)) @ turns[size] * UNIT).astype(np.int16)
                label, node, n = (batch.column(c).take(rows) for c in ("label", "node", "n"))
                known = size in cuts  # a length that the sample lacks has one cell
                for block, part in enumerate(blocks_of(size)):
                    budget = share(part.stop - part.start, size, least)
                    row, cell, home = cells(rotated[:, part], cuts[size][part] if known else None, deep if known else 0, budget)
                    for a in range(0, len(row), BATCH):
                        some = pa.array(row[a : a + BATCH])
                        m = len(some)
                        columns = {
                            "label": label.take(some), "d": pa.array(np.full(m, size, np.int32)), "block": pa.array(np.full(m, block, np.int32)),
                            "cell": pa.array(cell[a : a + BATCH]), "node": node.take(some),
                        }
                        if carry:
                            columns |= {"home": pa.array(home[a : a + BATCH]), "n": n.take(some), "vector": vectors.take(some), "q": _lists(rotated[some.to_numpy()])}
                        yield pa.RecordBatch.from_arrays([*columns.values()], [*columns])

    return run


def joined(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``parent`` (roots of a forest, each the smallest of its tree) after linking ``a`` with ``b``."""
    while True:
        apart = parent[a] != parent[b]
        if not apart.any():
            return parent
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(parent[a], parent[b]), np.minimum(parent[a], parent[b]))
        while (parent[parent] != parent).any():
            parent = parent[parent]


class Group:
    """Members of a cell, or of two of its chunks, sorted by their numbers."""

    def __init__(self, node, home, n, vectors, q, block: int, least: float):
        self.node, self.home, self.n, self.block, self.least = node, home, n.astype(float), block, least
        self.unit, self.q = units(vectors.astype(float)), q.astype(float)
        d = q.shape[1]
        self.parts = blocks_of(d)[: block + 1]
        self.budgets = [share(p.stop - p.start, d, least) for p in self.parts]
        self.links = np.zeros(len(node))
        self.parent = np.arange(len(node))

    def within(self, b: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether the distance in block ``b`` of each of ``x`` and each of ``y`` is in its share; whole numbers, exact."""
        u, v = self.q[x, self.parts[b]], self.q[y, self.parts[b]]
        return (u * u).sum(1)[:, None] + (v * v).sum(1)[None, :] - 2 * (u @ v.T) <= self.budgets[b]

    def meet(self, x: np.ndarray, y: np.ndarray) -> None:
        """Link each of ``x`` at home with each of ``y`` of a greater number."""
        x = x[self.home[x]]
        for a in range(0, len(x), TILE):
            some = x[a : a + TILE]
            near = self.within(self.block, some, y) & (self.node[y][None, :] > self.node[some][:, None])
            if near.mean() > 0.02:  # many: whole tiles are cheaper than pairs
                for b in range(self.block):
                    near &= ~self.within(b, some, y)
                i, j = np.nonzero(near & (self.unit[some] @ self.unit[y].T >= self.least))
                i, j = some[i], y[j]
            else:
                i, j = np.nonzero(near)
                i, j = some[i], y[j]
                for part, budget in zip(self.parts[:-1], self.budgets):
                    away = self.q[i, part] - self.q[j, part]
                    later = (away * away).sum(1) > budget
                    i, j = i[later], j[later]
                alike = np.einsum("ij,ij->i", self.unit[i], self.unit[j]) >= self.least
                i, j = i[alike], j[alike]
            self.links += np.bincount(i, self.n[j], len(self.node)) + np.bincount(j, self.n[i], len(self.node))
            self.parent = joined(self.parent, i, j)


def _compare(least: float):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("node").combine_chunks()
        one = {c: table.column(c).combine_chunks() for c in ("node", "home", "n", "vector", "q", "mine")}
        node, home, n, mine = (one[c].to_numpy(zero_copy_only=False) for c in ("node", "home", "n", "mine"))
        first, second = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        group = Group(node, home, n, _matrix(one["vector"]), _matrix(one["q"]), table.column("block")[0].as_py(), least)
        x, y = np.flatnonzero(mine == first), np.flatnonzero(mine == second)
        group.meet(x, y)
        if first != second:
            group.meet(y, x)
        some = np.flatnonzero(group.links > 0)
        return pa.table({"node": node[some], "links": group.links[some].astype(np.int64), "root": node[group.parent[some]]})

    return run


def _usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & (F.size(vector) > 0) & F.exists(vector, lambda x: x != 0), F.lit(False))


def link(
    vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", least: float = LEAST, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """(id, n_links, component_id, kept) of every row of ``vectors``."""
    rows = vectors.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").alias("vector"))
    classes = rows.where(F.col("label").isNotNull() & _usable(F.col("vector"))).groupBy("label", "vector")
    classes = classes.agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least"))
    classes = materialize(classes.select("*", F.monotonically_increasing_id().alias("node"), F.size("vector").alias("d")), "vector-classes")

    sample = classes.orderBy(F.xxhash64("node", "d")).limit(SAMPLE_ROWS).select("vector").toArrow().column("vector")
    cuts = quantiles([np.array(v) for v in sample.to_pylist()])
    depth = F.ceil(F.log2(F.count(F.lit(1)) / cell_rows))
    depths = classes.groupBy("label", "d").agg(F.greatest(depth, F.lit(0)).cast("int").alias("depth"))
    placed = classes.join(depths, ["label", "d"]).select("label", "d", "depth", "node", "n", "vector")

    key = f"label {rows.schema['label'].dataType.simpleString()}, d int, block int, cell long, node long"
    kind = rows.schema["vector"].dataType.simpleString()
    members = placed.mapInArrow(_members(cuts, least, True), f"{key}, home boolean, n long, vector {kind}, q array<smallint>")
    sizes = placed.mapInArrow(_members(cuts, least, False), key).groupBy(KEYS).agg(F.count(F.lit(1)).alias("m"))
    hot = materialize(sizes.where(F.col("m") > cell_rows).select(*KEYS, F.ceil(F.col("m") / cell_rows).alias("chunks")), "hot-cells")
    n_hot = hot.count()
    if n_hot:
        members = members.join(F.broadcast(hot) if n_hot <= HOT_CELLS else hot, KEYS, "left")
        members = members.withColumn("chunks", F.coalesce("chunks", F.lit(1).cast("long")))
    else:
        members = members.withColumn("chunks", F.lit(1).cast("long"))
    members = members.withColumn("mine", F.pmod(F.xxhash64("node"), "chunks")).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    members = members.withColumns({"i": F.least("mine", "other"), "j": F.greatest("mine", "other")}).drop("chunks", "other")
    links = materialize(members.groupBy(*KEYS, "i", "j").applyInArrow(_compare(least), "node long, links long, root long"), "vector-links")

    totals = links.groupBy("node").agg(F.sum("links").alias("links"))
    trees = components(links.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = classes.join(totals, "node", "left").join(trees, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = known.groupBy("component").agg(F.min("least").alias("component_id"))
    n_links = (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    known = known.join(smallest, "component").select(F.col("label").alias("l"), F.col("vector").alias("v"), n_links, "component_id", F.lit(True).alias("linked"))
    out = rows.join(known, (F.col("label") == F.col("l")) & (F.col("vector") == F.col("v")), "left")
    component = F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(id), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )


DUCKDB_SQL = f"""
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
  AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= {LEAST}),
reach AS (SELECT vec_id, vec_id AS other FROM embeddings UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.other),
least AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least USING (vec_id) LEFT JOIN counts ON a = e.vec_id
"""
