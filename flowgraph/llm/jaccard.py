"""Size-aware Jaccard join of documents by their sets of word n-grams: heavy sets by lists, light sets by subsets.

Sets of equal members become one class.  The members of a set are put in one global order (frequent n-grams last), and sets
of Jaccard similarity t or more, that are not equal, share k of the first n - ceil(t n) + k members, for any k up to their
overlap.  Small ("light") sets are found by enumerating their subsets of two of these members; all others ("heavy") are found
by scanning the inverted lists of single members.  The border between both is the size with the least estimated cost, from
the counts of sets by size and the mean length of a list.  Pairs of a light and a heavy set are found on the lists.

Groups of near copies never meet pair by pair.  Before any list is made, sets of equal least hashes are compared with two of
them, which joins most near copies to components; a list or subset of one component needs nothing more and is not kept.  What
is kept is searched by leaders: every set of a list is
compared with two sets of it, and links join components; a list whose sets are in one component needs nothing more.  Only sets
in different components are then compared with each other: on short lists by a join, on long ones in blocks, inside tasks,
which give away only pairs with enough shared first members.  What is left is decided exactly on the whole sets.

N-grams are 64-bit hashes, and so are the names of classes, by which sets are taken for equal.  The order by frequency comes from a sample of the documents and
only affects cost: any order gives the same links.

A null or blank text has no n-gram and is linked with nothing; a text of fewer words is one n-gram.  Repeated rows are equal
sets.  A component is named by its smallest id; null ids name none.  An empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgraph.llm.components import components
from flowgraph.llm.text import map_texts, split_words
from flowgraph.session import Scratch

#: One document of so many gives its n-grams to the estimate of frequencies; with so many sampled it counts as frequent.
SAMPLE = 8
FREQUENT = 2
#: Frequent n-grams that are sent to the tasks, the most frequent first (8 bytes each).
MOST_FREQUENT = 1_000_000
#: Largest set that may be light.
LIGHT_LIMIT = 256
#: Least hashes of a set, each under a function of its own, by which near copies meet first.
NEAR = 4
#: Pairs a posting that are compared without looking for leaders first.
PAIRS_A_POSTING = 8
#: Lists up to this length are joined with themselves; the sets of longer ones are counted against each other in blocks.
SHORT_LIST = 16
LIST_BLOCK = 1024
#: The blocks of lists longer than this bring whole sets, so that their pairs are decided where they meet.
HOT_LIST = 256


def _mix(h: np.ndarray, seed: int) -> np.ndarray:
    h = (h ^ np.uint64(seed)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(ends, members) of the sets of hashed n-grams of ``width`` words, each in ascending order."""
    ends, codes, words = split_words(texts)
    hashed = pd.util.hash_array(np.array(words.to_pylist(), dtype=object), categorize=False) if len(words) else np.zeros(0, np.uint64)
    word = hashed[codes]
    n = np.diff(ends)
    last = np.maximum(len(word) - width + 1, 0)
    gram = np.zeros(last, np.uint64)
    for j in range(width):
        gram = gram * np.uint64(0x9E3779B97F4A7C15) + word[j : j + last]
    gram = _mix(gram, 5)
    counts = np.where(n == 0, 0, np.maximum(n - width + 1, 1))
    begins = np.concatenate([[0], np.cumsum(counts)])
    out = np.empty(begins[-1], np.uint64)
    long = n >= width
    rows = np.repeat(np.flatnonzero(long), counts[long])
    within = np.arange(len(rows)) - np.repeat(np.concatenate([[0], np.cumsum(counts[long])])[:-1], counts[long])
    out[begins[rows] + within] = gram[ends[rows] + within]
    for row in np.flatnonzero((n > 0) & ~long):
        value = np.uint64(n[row])
        for w in word[ends[row] : ends[row + 1]]:
            value = _mix(np.array([value ^ w]), 77)[0]
        out[begins[row]] = value
    for a, b in zip(begins[:-1].tolist(), begins[1:].tolist()):
        out[a:b].sort()
    fresh = np.ones(len(out), bool)
    fresh[1:] = out[1:] != out[:-1]
    fresh[begins[:-1][counts > 0]] = True
    return np.concatenate([[0], np.cumsum(fresh)])[begins], out[fresh]


def _needed(n: np.ndarray, percent: int) -> np.ndarray:
    """Least overlap of a set of n members with one it is linked with."""
    return (percent * n + 99) // 100


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.zeros(len(ends) - 1, values.dtype)
    full = np.flatnonzero(np.diff(ends))
    if len(full):
        out[full] = np.add.reduceat(values, ends[full])
    return out


def _frequent(docs: DataFrame, width: int, scratch: Scratch) -> np.ndarray:
    """Hashes of frequent n-grams, in order."""
    sampled = docs.where(F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(SAMPLE)) == 0)

    def make():
        def apply(texts):
            ends, grams = shingle_sets(texts, width)
            return {None: np.repeat(np.arange(len(ends) - 1), np.diff(ends)), "gram": grams.view(np.int64)}

        return apply

    counts = map_texts(sampled, "text", [], [T.StructField("gram", T.LongType())], make).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.where("n > 1")
    counts = scratch.write(counts, "gram-counts")
    by_size = counts.groupBy(F.floor(F.log2("n")).alias("size")).agg(F.count(F.lit(1)).alias("grams"))
    sizes = sorted(by_size.collect(), key=lambda r: -r["size"])
    least, kept = 1 << 62, 0
    for row in sizes:
        if kept + row["grams"] > MOST_FREQUENT:
            break
        kept += row["grams"]
        least = max(FREQUENT, 1 << int(row["size"]))
    found = counts.where(F.col("n") >= least).select("gram").toArrow().column("gram").to_numpy()
    scratch.drop(counts)
    return np.sort(found.view(np.uint64))


FEATURES = [
    T.StructField("n", T.LongType()),
    T.StructField("set", T.LongType()),
    T.StructField("first", T.ArrayType(T.LongType(), False)),
    T.StructField("near", T.ArrayType(T.LongType(), False)),
]


def _class_names(members: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return _mix(_sums(_mix(members, 101), ends) + np.diff(ends).astype(np.uint64), 102)


def _features(docs: DataFrame, width: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """(id, n, set, first, near): size and name of the set, its first members in the global order, its least hashes."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def make():
        late = shared.value

        def apply(texts):
            ends, grams = shingle_sets(texts, width)
            n = np.diff(ends)
            row = np.repeat(np.arange(len(n)), n)
            if len(late) and len(grams):
                at = np.minimum(np.searchsorted(late, grams), len(late) - 1)
                order = np.argsort(row * 2 + (late[at] == grams), kind="stable")
            else:
                order = np.arange(len(grams))
            first = np.minimum(n, n - _needed(n, percent) + np.where(n <= LIGHT_LIMIT, 2, 1))
            chosen = order[np.arange(len(grams)) - ends[:-1][row] < first[row]]
            where = pa.array(np.concatenate([[0], np.cumsum(first)]).astype(np.int32))
            full = np.flatnonzero(n)
            near = np.zeros((len(n), NEAR), np.uint64)
            if len(full):
                near[full] = np.stack([np.minimum.reduceat(_mix(grams, 201 + j), ends[full]) for j in range(NEAR)], axis=1)
            return {
                "n": n,
                "set": _class_names(grams, ends).view(np.int64),
                "first": pa.ListArray.from_arrays(where, pa.array(grams[chosen].view(np.int64))),
                "near": pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * NEAR), pa.array(near.ravel().view(np.int64))),
            }

        return apply

    return map_texts(docs, "text", ["id"], FEATURES, make)


def _list_length(classes: DataFrame) -> float:
    """Mean length of the list that a first member is in, from one list of 64."""
    member = F.explode("first").alias("member")
    lists = classes.select(member).where(F.pmod(F.xxhash64("member"), F.lit(64)) == 0).groupBy("member").agg(F.count(F.lit(1)).alias("k"))
    sums = lists.agg(F.sum("k").alias("k"), F.sum(F.col("k") * F.col("k")).alias("squares")).first()
    return sums["squares"] / sums["k"] if sums["k"] else 1.0


def light_border(counts: dict[int, int], mean: float, percent: int) -> int:
    """Size up to which sets are light, with the least sum of subsets enumerated and list entries scanned."""
    sizes = np.arange(LIGHT_LIMIT + 1)
    sets = np.array([counts.get(int(n), 0) for n in sizes], float)
    first = sizes - _needed(sizes, percent)
    subsets = sets * (first + 2) * (first + 1) / 2
    lists = sets * (first + 1) * mean
    best, border = None, 0
    for x in sizes:
        cost = subsets[: x + 1].sum() + lists[int(_needed(x, percent)) if x else 0 :].sum()
        if best is None or cost < best:
            best, border = cost, int(x)
    return border


def _postings(classes: DataFrame, border: int, percent: int) -> DataFrame:
    """(key, set, n, component): a light set under every subset of two of its first members, the others under single members.

    Light sets that a heavy one may be linked with are on the lists too.
    """
    schema = T.StructType().add("key", "long").add("set", "long").add("n", "long").add("component", "long")
    on_lists = int(_needed(np.array(border + 1), percent))

    def run(batches):
        for batch in batches:
            n, name = (batch.column(c).to_numpy() for c in ("n", "set"))
            lists = batch.column("first")
            offsets, members = lists.offsets.to_numpy().astype(np.int64), lists.values.to_numpy().view(np.uint64)
            size = np.diff(offsets)
            keys, rows = [], []
            single = np.where(n >= on_lists, np.minimum(size, n - _needed(n, percent) + 1), 0)
            row = np.repeat(np.arange(len(n)), single)
            within = np.arange(len(row)) - np.repeat(np.cumsum(single) - single, single)
            keys.append(_mix(members[offsets[row] + within], 11))
            rows.append(row)
            light = n <= border
            for length in np.unique(size[light]):
                some = np.flatnonzero(light & (size == length))
                i, j = np.triu_indices(length, 1)
                if len(i):
                    table = members[offsets[some][:, None] + np.arange(length)]
                    low, high = np.minimum(table[:, i], table[:, j]), np.maximum(table[:, i], table[:, j])
                    keys.append(_mix(low * np.uint64(0x9E3779B97F4A7C15) + high, 12).ravel())
                    rows.append(np.repeat(some, len(i)))
            row = np.concatenate(rows)
            columns = [pa.array(np.concatenate(keys).view(np.int64)), *(batch.column(c).take(pa.array(row)) for c in ("set", "n", "component"))]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return classes.select("set", "n", "first", "component").mapInArrow(run, schema)


def _near(classes: DataFrame) -> DataFrame:
    """(a, b), once, of every set and the least and the greatest of those that have one of its least hashes."""
    postings = classes.select(F.explode("near").alias("key"), "set")
    lists = postings.groupBy("key").agg(F.min("set").alias("low"), F.max("set").alias("high")).where("low < high")
    pairs = postings.join(lists, "key").select("set", F.explode(F.array("low", "high")).alias("leader")).where("set <> leader")
    return pairs.select(*_pair("set", "leader")).distinct()


def _bounded(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The (a, b) whose shared first members leave room for a link."""
    side = classes.select("set", "n", "first")
    both = pairs.join(side.toDF("a", "na", "fa"), "a").join(side.toDF("b", "nb", "fb"), "b")
    # 100 * overlap >= percent * union is overlap * (100 + percent) >= percent * (na + nb).
    overlap = -F.floor(-percent * (F.col("na") + F.col("nb")) / F.lit(float(100 + percent)) + 1e-9)
    shared = F.size(F.array_intersect("fa", "fb"))
    # Up to the earlier of both last members, shared ones are in both; all later ones are in the rest of that set.
    rest = F.greatest(F.col("na") - F.size("fa"), F.col("nb") - F.size("fb"))
    fits = (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")) & (shared + rest >= overlap)
    return both.where(fits).select("a", "b")


def _sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(set, members) of the classes of ``wanted`` (set, id), from the text of one document of each."""
    texts = docs.join(wanted.withColumnRenamed("id", "wanted_id"), docs["id"].eqNullSafe(F.col("wanted_id"))).select("set", "text")

    def make():
        def apply(texts):
            ends, grams = shingle_sets(texts, width)
            raw = memoryview(grams.tobytes())
            members = [bytes(raw[8 * a : 8 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            return {"name": _class_names(grams, ends).view(np.int64), "members": pa.array(members, pa.binary())}

        return apply

    found = map_texts(texts, "text", ["set"], [T.StructField("name", T.LongType()), T.StructField("members", T.BinaryType())], make)
    # An id may have several texts; only one of them has the wanted set, and copies of it are equal.
    return found.where("name = set").select("set", "members").dropDuplicates(["set"])


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) with 100 * intersection >= percent * union, on whole sets."""
    both = pairs.join(sets.toDF("a", "ma"), "a").join(sets.toDF("b", "mb"), "b").select("a", "b", "ma", "mb")

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("ma"), batch.column("mb")):
                x, y = (np.frombuffer(v.as_py(), np.uint64) for v in (x, y))
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def _short_lists(postings: DataFrame, percent: int) -> DataFrame:
    """(a, b), once, of sets in different components that are in one of the short lists."""
    side = postings.select("key", "set", "n", "component")
    left, right = side.toDF("key", "a", "na", "ca"), side.toDF("key", "b", "nb", "cb")
    pairs = left.join(right, "key").where(f"ca < cb and 100 * least(na, nb) >= {percent} * greatest(na, nb)")
    return pairs.select(*_pair("a", "b")).distinct()


def _long_lists(postings: DataFrame, classes: DataFrame, percent: int, sets: DataFrame | None = None) -> DataFrame:
    """(a, b), once, of sets in different components that are in a list together and share enough first members.

    A list is cut into blocks by a hash of the set, and every two blocks of it meet in a group of bounded size; there each
    set scans the lists of its first members and counts how often it meets the others.  With ``sets`` (set, members) the
    pairs are also decided there, and only links that join components not joined in the group yet leave the task.
    """
    blocks = F.ceil(F.col("k") / F.lit(float(LIST_BLOCK)))
    long = postings.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("set", "key"), F.col("blocks")))
    long = long.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    long = long.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "set", "component")
    wide = long.join(classes.select("set", "n", "first"), "set")
    exact = sets is not None
    if exact:
        wide = wide.join(sets, "set")

    def scan(table: pa.Table) -> pa.Table:
        name, component, n = (table.column(c).to_numpy() for c in ("set", "component", "n"))
        lists = table.column("first").combine_chunks()
        wholes = table.column("members").combine_chunks() if exact else None
        size = np.diff(lists.offsets.to_numpy())
        owner, member = np.repeat(np.arange(len(name)), size), lists.flatten().to_numpy()
        order = np.argsort(member, kind="stable")
        cut = np.flatnonzero(np.diff(member[order])) + 1
        begin, end = np.append(0, cut), np.append(cut, len(order))
        where = np.empty(len(order), np.int64)
        where[order] = np.repeat(np.arange(len(begin)), end - begin)
        posted, place = owner[order], np.concatenate([[0], np.cumsum(size)])
        joined = np.unique(component, return_inverse=True)[1]
        found_a, found_b = [], []
        for x in range(len(name)):
            rows = [posted[begin[t] : end[t]] for t in where[place[x] : place[x + 1]]]
            shared = np.bincount(np.concatenate(rows), minlength=len(name)) if rows else np.zeros(len(name), int)
            both = n[x] + n
            needed = -(-percent * both // (100 + percent))
            rest = np.maximum(n[x] - size[x], n - size)
            fits = (component > component[x]) & (100 * np.minimum(n[x], n) >= percent * np.maximum(n[x], n)) & (shared + rest >= needed)
            hits = np.flatnonzero(fits)
            if exact and len(hits):
                own, links = np.frombuffer(wholes[x].as_py(), np.uint64), []
                for h in hits:
                    if joined[h] != joined[x]:
                        count = len(np.intersect1d(own, np.frombuffer(wholes[h].as_py(), np.uint64), assume_unique=True))
                        if 100 * count >= percent * (both[h] - count):
                            links.append(h)
                            joined[joined == joined[h]] = joined[x]
                hits = np.array(links, np.int64)
            found_a.append(np.minimum(name[x], name[hits]))
            found_b.append(np.maximum(name[x], name[hits]))
        return pa.table({"a": np.concatenate(found_a), "b": np.concatenate(found_b)})

    return wide.groupBy("key", "i", "j").applyInArrow(scan, "a long, b long").distinct()


class _Search:
    """Links found so far, and the steps that find more."""

    def __init__(self, docs: DataFrame, classes: DataFrame, width: int, percent: int, scratch: Scratch):
        self.scratch, self.docs, self.classes, self.width, self.percent = scratch, docs, classes, width, percent
        self.links = self.labels = None
        self.new = 0  # links that the labels do not know yet

    def joined(self, sets: DataFrame) -> DataFrame:
        """``sets`` with the component of each, null where no link of it is known."""
        if self.labels is None:
            return sets.withColumn("component", F.lit(None).cast("long"))
        return sets.join(self.labels.withColumnRenamed("node", "set"), "set", "left")

    def labelled(self, sets: DataFrame) -> DataFrame:
        return self.joined(sets).withColumn("component", F.coalesce("component", "set"))

    def test(self, pairs: DataFrame, hot: DataFrame | None = None) -> None:
        """Adds the links among ``pairs`` (a < b) and on the ``hot`` lists, and joins components by all links."""
        pairs = self.scratch.write(pairs, "pairs")
        wanted = pairs.select(F.col("a").alias("set")).unionByName(pairs.select(F.col("b").alias("set")))
        if hot is not None:
            wanted = wanted.unionByName(hot.select("set"))
        wanted = self.classes.join(wanted.distinct(), "set", "left_semi").select("set", "id")
        sets = self.scratch.write(_sets(self.docs, wanted, self.width), "sets")
        if hot is not None:
            self.add(_long_lists(hot, self.classes, self.percent, sets))
        self.add(_linked(pairs, sets, self.percent))
        self.scratch.drop(pairs, sets)
        if self.new:
            self.scratch.drop(self.labels)
            self.labels, self.new = components(self.links, scratch=self.scratch), 0

    def add(self, links: DataFrame) -> None:
        """Keeps ``links`` (a < b)."""
        found = self.scratch.write(links, "links")
        n = found.count()
        if n:
            self.links = found if self.links is None else self.links.unionByName(found)
            self.new += n


def _pair(one: str, other: str):
    return F.least(one, other).alias("a"), F.greatest(one, other).alias("b")


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, of which one of each group of linked rows stays: the one of the smallest id.

    Where several rows of a group have that id, that of the least set name stays.  Rows without n-grams, or without an id, all
    stay.
    """
    scratch = Scratch(docs.sparkSession)
    found = _components(docs, id, text, width, percent, scratch).where("set is not null and id is not null")
    first = found.groupBy("component").agg(F.min(F.struct("id", "set")).alias("first"))
    judged = found.join(first, "component").select("id", "set", (F.struct("id", "set") == F.col("first")).alias("stays"))
    judged = scratch.write(judged, "groups")
    # Ids of one row are judged by id alone; of an id's several rows, the sets must be told apart.
    per_id = judged.groupBy("id").agg(F.count(F.lit(1)).alias("rows"), F.max("stays").alias("stays"))
    per_id = scratch.write(per_id.where("rows > 1 or not stays").select(F.col("id").alias("judged_id"), (F.col("rows") > 1).alias("several")), "judged")
    left = docs.join(per_id.select("judged_id"), F.col(f"`{id}`") == F.col("judged_id"), "left_anti")
    if not per_id.where("several").limit(1).count():
        scratch.drop_all(but=per_id)
        return left
    several = per_id.where("several").select("judged_id")
    kept = judged.where("stays").join(several, F.col("id") == F.col("judged_id"), "left_semi").select(F.col("id").alias("kept_id"), F.col("set").alias("kept_set"))
    kept = scratch.write(kept.distinct(), "kept")
    scratch.drop(*(t for t in scratch.tables() if t is not per_id and t is not kept))
    rows = docs.join(several, F.col(f"`{id}`") == F.col("judged_id"))
    rows = rows.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"), "judged_id", docs[f"`{text}`"].alias("text"))

    def make():
        def apply(texts):
            ends, grams = shingle_sets(texts, width)
            return {"n": np.diff(ends), "set": _class_names(grams, ends).view(np.int64)}

        return apply

    rows = map_texts(rows, "text", ["row", "judged_id"], [T.StructField("n", T.LongType()), T.StructField("set", T.LongType())], make)
    ones = rows.where("n > 0").join(kept, (F.col("judged_id") == F.col("kept_id")) & (F.col("set") == F.col("kept_set")), "left_semi")
    ones = ones.dropDuplicates(["judged_id", "set"])
    return left.unionByName(rows.where("n = 0").select("row.*")).unionByName(ones.select("row.*"))


def link(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """(id, n_shingles, set, component_id) of every row; ``set`` names the class of equal sets (null without one)."""
    scratch = Scratch(docs.sparkSession)
    found = _components(docs, id, text, width, percent, scratch)
    component = F.when(F.col("set").isNotNull(), F.col("component_id")).otherwise(F.col("id"))
    result = scratch.write(found.select(F.col("id").alias(id), F.col("n").alias("n_shingles"), "set", component.alias("component_id")), "linked")
    scratch.drop_all(but=result)
    return result


def _components(docs: DataFrame, id: str, text: str, width: int, percent: int, scratch: Scratch) -> DataFrame:
    """(id, n, set, component, component_id) of every row: its group's name and smallest id, null without a set."""
    docs = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    frequent = _frequent(docs, width, scratch)
    features = scratch.write(_features(docs, width, percent, frequent), "features")
    full = features.where("n > 0")
    classes = full.groupBy("set").agg(F.min("id").alias("id"), *(F.first(c).alias(c) for c in ("n", "first", "near")))
    classes = scratch.write(classes, "classes")
    members = scratch.write(features.select("id", "n", F.when(F.col("n") > 0, F.col("set")).alias("set")), "members")
    scratch.drop(features)
    sizes = classes.where(F.col("n") <= LIGHT_LIMIT).groupBy("n").agg(F.count(F.lit(1)).alias("k")).collect()
    counts = {r["n"]: r["k"] for r in sizes}
    mean = _list_length(classes)
    border = light_border(counts, mean, percent)
    search = _Search(docs, classes, width, percent, scratch)
    search.test(_bounded(_near(classes), classes, percent))
    every = _postings(search.joined(classes), border, percent)
    # A key whose sets are all in one component already has nothing left to find; a null component is a set alone.
    ends = [F.min("component").alias("low"), F.max("component").alias("high"), F.count("component").alias("linked")]
    keys = every.groupBy("key").agg(F.count(F.lit(1)).alias("k"), *ends).where("k > 1 and (linked < k or low < high)")
    open_keys = scratch.write(keys.select("key"), "keys")
    postings = scratch.write(every.withColumn("component", F.coalesce("component", "set")).join(open_keys, "key"), "postings")
    scratch.drop(open_keys)
    before, lists, now = None, None, postings
    while True:
        per = now.groupBy("key", "component").agg(F.count(F.lit(1)).alias("m"), F.min("set").alias("set"))
        one = F.struct("component", "set")
        scratch.drop(lists)
        lists = per.groupBy("key").agg(F.min(one).alias("low"), F.max(one).alias("high"), F.sum("m").alias("k"), F.sum(F.col("m") * F.col("m")).alias("same"))
        lists = scratch.write(lists.where("low.component < high.component"), "lists")
        pairs = F.sum(F.col("k") * F.col("k") - F.col("same")).alias("pairs")
        size = lists.agg(F.sum("k").alias("k"), pairs, F.max("k").alias("longest")).first()
        if not size["k"]:
            break
        # Leaders are worth another round while they leave fewer pairs than before, and many.
        if size["pairs"] <= 2 * PAIRS_A_POSTING * size["k"] or (before is not None and size["pairs"] > 0.4 * before):
            break
        before = size["pairs"]
        leaders = F.explode(F.array("low", "high")).alias("leader")
        pairs = now.join(lists, "key").select("set", "component", leaders).where("component <> leader.component").select(*_pair("set", "leader.set"))
        search.test(_bounded(pairs.distinct(), classes, percent))
        now = search.labelled(postings.drop("component"))
    if size["k"]:
        left = scratch.write(now.join(lists.select("key", "k"), "key"), "postings")
        scratch.drop(postings, lists)
        short, long = left.where(F.col("k") <= SHORT_LIST), left.where((F.col("k") > SHORT_LIST) & (F.col("k") <= HOT_LIST))
        pairs = _bounded(_short_lists(short, percent), classes, percent).unionByName(_long_lists(long, classes, percent)).distinct()
        hot = left.where(F.col("k") > HOT_LIST) if size["longest"] > HOT_LIST else None
        search.test(pairs, hot)
        scratch.drop(left)
    if search.labels is None:
        named = classes.select("set", F.col("set").alias("component"), F.col("id").alias("component_id"))
    else:
        labelled = classes.select("set", "id").join(search.labels.withColumnRenamed("node", "set"), "set", "left")
        labelled = labelled.withColumn("component", F.coalesce("component", "set"))
        least = labelled.groupBy("component").agg(F.min("id").alias("component_id"))
        named = labelled.join(least, "component").select("set", "component", "component_id")
    return members.join(named, "set", "left").select("id", "n", "set", "component", "component_id")
