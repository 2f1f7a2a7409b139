"""Graph attention scoring on node and edge tables (attention as in Velickovic et al., 2018).

Weights are bounded by the model, not by the data: they are plain arrays sent to the tasks.
Products with them run as Arrow-batched matrix products; everything keyed by node or edge is
a Spark join or aggregation.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgraph.functions.vector import batch_norm, elu, relu
from flowgraph.operators.graph import require_vectors
from flowgraph.operators.joins import HOT_ROWS, hot_keys, salted_join
from flowgraph.session import materialize

SLOPE = 0.2
HUB_SALTS = 64


@dataclass
class AttentionWeights:
    """One layer: ``project`` is [inputs, heads*units]; the attention vectors are [heads, units]."""

    project: np.ndarray
    att_src: np.ndarray
    att_dst: np.ndarray
    project_edge: np.ndarray | None = None
    att_edge: np.ndarray | None = None
    bias: np.ndarray | None = None

    @property
    def heads(self) -> int:
        return self.att_src.shape[0]

    @property
    def units(self) -> int:
        return self.att_src.shape[1]


def weights_table(spark, layers: dict[str, dict[str, np.ndarray]]) -> DataFrame:
    """Model weights as rows (layer, name, row, values)."""
    rows = [
        (layer, name, i, [float(v) for v in np.atleast_1d(line)])
        for layer, parts in layers.items()
        for name, array in parts.items()
        for i, line in enumerate(np.atleast_2d(array))
    ]
    return spark.createDataFrame(rows, "layer string, name string, row int, values array<double>")


def load_weights(table: DataFrame, max_rows: int = 1_000_000) -> dict[str, dict[str, np.ndarray]]:
    """Back to arrays; refuses a table larger than any such model."""
    rows = table.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError("weights table is too large")
    out: dict[str, dict[str, list]] = {}
    for r in sorted(rows, key=lambda r: (r["layer"], r["name"], r["row"])):
        out.setdefault(r["layer"], {}).setdefault(r["name"], []).append(r["values"])
    return {layer: {n: np.array(v) for n, v in parts.items()} for layer, parts in out.items()}


def network_table(spark, layers: list[dict], classifier: dict) -> DataFrame:
    """The arguments of :func:`score_graph` as a table that :func:`load_network` reads."""
    parts = {}
    for at, layer in enumerate(layers):
        weights = {k: v for k, v in vars(layer["attention"]).items() if v is not None}
        norm = {f"norm_{k}": v for k, v in layer["norm"].items()}
        parts[f"layer{at:03d}"] = weights | norm | {"concat": np.array([float(layer.get("concat", True))])}
    return weights_table(spark, parts | {"classifier": {k: np.asarray(v, dtype="float64") for k, v in classifier.items()}})


def load_network(table: DataFrame) -> tuple[list[dict], dict]:
    """(layers, classifier) for :func:`score_graph`; layers are in the order of their names, ``classifier`` is none of them."""
    parts = load_weights(table)
    if "classifier" not in parts:
        raise ValueError("the weights have no classifier")
    vectors = {"bias", "concat", "b1", "b2"}
    parts = {layer: {n: v[0] if n in vectors or n.startswith("norm_") else v for n, v in named.items()} for layer, named in parts.items()}
    classifier, layers = parts.pop("classifier"), []
    for name in sorted(parts):
        named = parts[name]
        norm = {n.removeprefix("norm_"): v for n, v in named.items() if n.startswith("norm_")}
        weights = {n: v for n, v in named.items() if not n.startswith("norm_") and n != "concat"}
        layers.append({"attention": AttentionWeights(**weights), "norm": norm, "concat": bool(named["concat"][0])})
    return layers, classifier


def times(vector: Column, weights: np.ndarray, spark) -> Column:
    """vector · weights for an ARRAY<DOUBLE> column, one matrix product per Arrow batch."""
    held = spark.sparkContext.broadcast(np.asarray(weights, dtype="float64"))

    @F.pandas_udf("array<double>")
    def product(rows: pd.Series) -> pd.Series:
        if len(rows) == 0:
            return pd.Series([], dtype=object)
        return pd.Series(list(np.stack(rows.to_numpy()).astype("float64") @ held.value))

    return product(vector)


def edge_softmax(edges: DataFrame, logit: str = "logit", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Attention weight of every edge: softmax of ``logit`` over the edges with the same ``dst``; NULL where it is NULL.

    Greatest logit and scaled sum of a destination come from one pass, and edges join them once.
    """
    least = F.lit(-1e308)  # of no weight beside any logit
    parts = _messages(edges.select("dst", F.array(F.coalesce(F.col(logit).cast("double"), least)).alias("l")), 1, 0)
    total = _merged(parts, 1, 0).select("dst", F.col("values")[0].alias("__peak"), F.col("values")[1].alias("__total"))
    joined = salted_join(edges, total, "dst", "edge_idx", hot_rows)
    return joined.withColumn("alpha", F.exp(F.col(logit) - F.col("__peak")) / F.col("__total")).drop("__peak", "__total")


def _with_self_loops(edges: DataFrame, nodes: DataFrame, edge_dim: int) -> DataFrame:
    """Replace self edges by one loop per node whose vector is the mean of the node's incoming vectors."""
    others = edges.filter(F.col("src") != F.col("dst"))
    mean = others.groupBy("dst").agg(F.array(*[F.avg(F.col("attr")[i]) for i in range(edge_dim)]).alias("__mean"))
    zeros = F.array(*[F.lit(0.0) for _ in range(edge_dim)])
    loops = (
        nodes.select(F.col("node_id").alias("dst"))
        .join(mean, "dst", "left")
        .select(
            F.concat(F.lit("loop-"), F.col("dst").cast("string")).alias("edge_idx"),
            F.col("dst").alias("src"),
            "dst",
            F.coalesce("__mean", zeros).alias("attr"),
        )
    )
    return others.select(F.col("edge_idx").cast("string").alias("edge_idx"), "src", "dst", "attr").unionByName(loops)


def _softmax_merge(heads: int, units: int):
    """Merging of rows [greatest logit, sums of w·z, sums of w] per head, where w = exp(logit - greatest logit of the row)."""

    def merge(values, starts):
        import numpy as np

        peak = np.maximum.reduceat(values[:, :heads], starts, axis=0)
        group = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(values)]))
        scale = np.exp(values[:, :heads] - peak[group])
        wide = np.concatenate([np.repeat(scale, units, axis=1), scale], axis=1)
        return np.concatenate([peak, np.add.reduceat(values[:, heads:] * wide, starts, axis=0)], axis=1)

    return merge


def _messages(met: DataFrame, heads: int, units: int) -> DataFrame:
    """(dst, l, z) → per Arrow batch one row (dst, salt, values) per destination, values as :func:`_softmax_merge` takes them.

    ``l`` holds a logit per head; with 0 units there is no ``z``.  A destination that fills a good part of a batch is a hub: its
    rows get changing salts, so that no task receives all of them.
    """
    merge = _softmax_merge(heads, units)
    schema = T.StructType(
        [met.schema["dst"], T.StructField("salt", T.IntegerType()), T.StructField("values", T.ArrayType(T.DoubleType()))]
    )

    def add_up(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        turn = TaskContext.get().partitionId()
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            turn += 1
            parts = [batch.column(c).flatten().to_numpy().reshape(n, -1) for c in (["l", "z"] if units else ["l"])]
            values = np.concatenate([*parts, np.ones((n, heads))], axis=1)
            dst = batch.column("dst").to_numpy(zero_copy_only=False)
            order = np.argsort(dst, kind="stable")
            starts = np.flatnonzero(np.r_[True, dst[order][1:] != dst[order][:-1]])
            sums = merge(values[order], starts)
            rows = np.diff(np.r_[starts, n])
            salt = np.where(rows > max(16, n // 100), turn % HUB_SALTS, 0).astype("int32")
            offsets = pa.array(range(0, sums.size + 1, sums.shape[1]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("dst").take(pa.array(order[starts])),
                    pa.array(salt),
                    pa.ListArray.from_arrays(offsets, pa.array(sums.ravel())),
                ],
                names=["dst", "salt", "values"],
            )

    return met.select("dst", "l", *(["z"] if units else [])).mapInArrow(add_up, schema)


def _merged(messages: DataFrame, heads: int, units: int) -> DataFrame:
    """One row (dst, values) per destination; the pieces of a hub are merged first."""
    merge = _softmax_merge(heads, units)
    return vector_sums(vector_sums(messages, ["dst", "salt"], merge=merge), ["dst"], merge=merge)


def vector_sums(df: DataFrame, keys: list[str], values: str = "values", merge=None) -> DataFrame:
    """Element-wise sum of an array column per key, or what ``merge(rows, starts)`` makes of each group of consecutive rows.

    Rows are sorted by key inside their partition and added up as a stream: memory holds one
    batch and one running sum, whatever the size of a group.
    """
    df = df.select(*keys, values)
    n_keys = len(keys)

    def add_up(batches):
        import numpy as np
        import pyarrow as pa

        combine = merge or (lambda rows, starts: np.add.reduceat(rows, starts, axis=0))

        def rows(columns, sums, types):
            offsets = pa.array(range(0, sums.size + 1, sums.shape[1]), pa.int32())
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            return pa.RecordBatch.from_arrays(
                [*arrays, pa.ListArray.from_arrays(offsets, pa.array(sums.ravel()))], names=[*keys, values]
            )

        held = None
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            types = [batch.column(i).type for i in range(n_keys)]
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(n_keys)]
            change = np.r_[True, np.zeros(n - 1, bool)]
            for c in columns:
                change[1:] |= c[1:] != c[:-1]
            starts = np.flatnonzero(change)
            sums = combine(batch.column(n_keys).flatten().to_numpy().reshape(n, -1), starts)
            firsts = [c[starts] for c in columns]
            if held is not None:
                if all(f[0] == h[0] for f, h in zip(firsts, held[0])):
                    sums[0] = combine(np.stack([held[1][0], sums[0]]), np.zeros(1, int))[0]
                else:
                    yield rows(*held, types)
            held = ([f[-1:] for f in firsts], sums[-1:].copy())
            if len(starts) > 1:
                yield rows([f[:-1] for f in firsts], sums[:-1], types)
        if held is not None:
            yield rows(*held, types)

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(add_up, df.schema)


def attention_layer(
    edges: DataFrame,
    nodes: DataFrame,
    weights: AttentionWeights,
    concat: bool = True,
    self_loops: bool = True,
    hot_rows: int = HOT_ROWS,
    check: bool = True,
) -> DataFrame:
    """One attention layer: nodes(node_id, x), edges(edge_idx, src, dst, attr) → nodes(node_id, x).

    Edges whose end points lack a vector are refused; ``check=False`` is for callers that have made sure of it.

    Per head: logit = LeakyReLU(a_s·Wx_src + a_d·Wx_dst + a_e·W_e attr), softmax over the edges
    into a node, weighted sum of Wx_src.  Heads are concatenated or averaged.

    Edges meet their destination's numbers first; the wide vectors of the sources are joined last and summed in the task that
    joined them.
    """
    spark = nodes.sparkSession
    if check:
        require_vectors(edges, nodes)
    h, c = weights.heads, weights.units

    # One product yields [Wx | a_s·Wx per head | a_d·Wx per head].
    blocks = weights.project.reshape(-1, h, c)
    stacked = np.concatenate(
        [
            weights.project,
            np.einsum("ihc,hc->ih", blocks, weights.att_src),
            np.einsum("ihc,hc->ih", blocks, weights.att_dst),
        ],
        axis=1,
    )
    projected = materialize(
        nodes.select("node_id", times(F.col("x"), stacked, spark).alias("p")).select(
            "node_id",
            F.slice("p", 1, h * c).alias("z"),
            F.slice("p", h * c + 1, h).alias("s"),
            F.slice("p", h * c + h + 1, h).alias("t"),
        ),
        "projected",
    )
    if weights.project_edge is not None:
        edge_dim = weights.project_edge.shape[0]
        per_head = np.einsum("ihc,hc->ih", weights.project_edge.reshape(edge_dim, h, c), weights.att_edge)
        if self_loops:
            edges = _with_self_loops(edges, nodes, edge_dim)
        lines = edges.select("edge_idx", "src", "dst", times(F.col("attr"), per_head, spark).alias("e"))
    else:
        if self_loops:
            edges = _with_self_loops(edges.withColumn("attr", F.array(F.lit(0.0))), nodes, 1)
        lines = edges.select("edge_idx", "src", "dst", F.array(*[F.lit(0.0)] * h).alias("e"))

    # Logits are known once both ends have been met; sums are kept relative to the greatest logit seen so far, so that no
    # pass is needed to find it first.
    lines = materialize(lines, "lines")
    receiver = projected.select(F.col("node_id").alias("dst"), "t")
    sender = projected.select(F.col("node_id").alias("src"), "s", "z")
    sent = salted_join(lines, receiver, "dst", "edge_idx", hot_rows)
    met = salted_join(sent, sender, "src", "edge_idx", hot_rows, hot=hot_keys(lines, "src", hot_rows))

    def logit(i: int) -> Column:
        v = F.col("s")[i] + F.col("t")[i] + F.col("e")[i]
        return F.when(v > 0, v).otherwise(v * SLOPE)

    sums = _merged(_messages(met.select("dst", F.array(*[logit(i) for i in range(h)]).alias("l"), "z"), h, c), h, c)

    def head(i: int) -> Column:
        total = F.col("values")[h + h * c + i]
        return F.transform(F.slice("values", h + i * c + 1, c), lambda v: v / total)

    if concat:
        mixed = F.concat(*[head(i) for i in range(h)])
    else:
        mixed = head(0)
        for i in range(1, h):
            mixed = F.zip_with(mixed, head(i), lambda a, b: a + b)
        mixed = F.transform(mixed, lambda v: v / h)
    bias = weights.bias if weights.bias is not None else np.zeros(h * c if concat else c)
    constant = F.array(*[F.lit(float(b)) for b in bias])
    out = sums.select(F.col("dst").alias("node_id"), F.zip_with(mixed, constant, lambda v, b: v + b).alias("__x"))
    # A node that receives nothing (possible without loops) keeps only the bias.
    return nodes.select("node_id").join(out, "node_id", "left").select("node_id", F.coalesce("__x", constant).alias("x"))


def linear(vector: Column, weights: np.ndarray, bias: np.ndarray, spark) -> Column:
    """vector · weights + bias."""
    extended = np.concatenate([weights, np.asarray(bias, dtype="float64")[None, :]], axis=0)
    return times(F.concat(vector, F.array(F.lit(1.0))), extended, spark)


def edge_scores(edges: DataFrame, nodes: DataFrame, w1, b1, w2, b2) -> DataFrame:
    """Linear → ReLU → Linear on [x_src, x_dst, attr]: one ``logit`` per edge.

    The rows of the first matrix that meet a node's vector are applied once per node; edges join the two short products.
    """
    spark = nodes.sparkSession
    require_vectors(edges, nodes)
    w1 = np.asarray(w1, dtype="float64")
    first = nodes.select(F.size("x").alias("n")).first()
    d = first["n"] if first else w1.shape[0] // 2
    hidden = w1.shape[1]
    both = nodes.select("node_id", times(F.col("x"), np.concatenate([w1[:d], w1[d : 2 * d]], axis=1), spark).alias("__p"))
    both = materialize(both.select("node_id", F.slice("__p", 1, hidden).alias("__s"), F.slice("__p", hidden + 1, hidden).alias("__d")), "ends")
    own = edges.withColumn("__e", linear(F.col("attr"), w1[2 * d :], b1, spark))
    met = own.join(both.select(F.col("node_id").alias("src"), "__s"), "src").join(both.select(F.col("node_id").alias("dst"), "__d"), "dst")
    total = F.zip_with(F.zip_with("__s", "__d", lambda a, b: a + b), "__e", lambda a, b: a + b)
    scored = met.withColumn("__h", relu(total)).drop("__s", "__d", "__e")
    return scored.withColumn("logit", linear(F.col("__h"), np.asarray(w2).reshape(-1, 1), np.atleast_1d(b2), spark)[0]).drop("__h")


def score_graph(edges: DataFrame, nodes: DataFrame, layers: list[dict], classifier: dict, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The whole network: attention, batch norm and ELU per layer, then the edge scorer.

    Each layer's node table is written out, so the plan does not grow with depth.
    """
    def constant(values):
        return F.array(*[F.lit(float(v)) for v in values])

    for at, layer in enumerate(layers):
        x = attention_layer(edges, nodes, layer["attention"], layer.get("concat", True), hot_rows=hot_rows, check=at == 0)
        norm = layer["norm"]
        normed = batch_norm(
            F.col("x"), constant(norm["mean"]), constant(norm["var"]), constant(norm["weight"]), constant(norm["bias"])
        )
        nodes = materialize(x.select("node_id", elu(normed).alias("x")))
    return edge_scores(edges, nodes, classifier["w1"], classifier["b1"], classifier["w2"], classifier["b2"])
