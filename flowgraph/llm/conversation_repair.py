"""Conversation repair at least cost: an auction algorithm for shortest paths over a lattice of edits.

A conversation is its rows by turn.  A row's fault is blank (nothing but white space), else duplicate (role and text seen
earlier), else truncated (its last visible character ends no sentence).  Keep, Rerole (to user or assistant), Delete and
Insert (an empty user or assistant row) turn it into nothing, or an optional system row and pairs of user and assistant.  A
node of the lattice is (rows consumed, state); the state says whose row came last, so an edit's letter names its arc.

The auction holds one path and a price for each node.  The path's last node is raised to its cheapest arc and price beyond
it; if that raises it, the path contracts by one node, else it is extended by that arc, until it ends in the sink.  Prices
never exceed what an arc costs plus the price beyond it, so every least-cost path consists of tight arcs alone; the one
with the least string of letters is traced among them.  Prices start from what each row costs at least.

Rows are numbered in order by one range sort and cut into pieces of at most ``PIECE_ROWS``.  A conversation in one piece is
one auction.  Of a longer one, each piece gives its costs from each state to each state; a pass over its pieces from the
last gives what follows each of them, and each piece is traced for every state it may be entered in.  Texts are met once
more, in order, by the task that hashes the repaired conversation: a hash is sequential, so that task streams all rows of
its conversations, but holds one batch and the letters only.

A null role or text is one blank, a null id is a conversation, null turns come first.  Rows of one turn are ordered by role,
then text (its first 32 characters, then its md5); repeated rows are duplicates.  Texts of any length are whole.  An empty
table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgraph.operators.numbering import global_row_number
from flowgraph.session import materialize

PIECE_ROWS = 128
PIECES_A_TASK = 1000
KEEP, REROLE, DELETE, INSERT = 0, 3, 4, 3
#: Added to a truncated row that stays.
TRUNCATED = 3

VISIBLE = r"[^\x20\x09-\x0D]"
SENTENCE_END = r"[.!?][\x20\x09-\x0D]*\z"

#: States: nothing yet, after the system row, after a user's row, after an assistant's row.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The role that must come next, and the state it leads to.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: A row's first letter as a number; the place of a letter is the state it may lead to, less one.
INITIALS = ("s", "u", "a")
OTHER = 3
FINE, BLANK, DUPLICATE, CUT = range(4)
#: Cost from each state at the end of a conversation: only nothing and an assistant's row may end it.
ACCEPT = (0, None, None, 0)


def damage(conversations: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(id, turn, role, text) with rows dropped, emptied, cut, repeated or given to the user by crc32 of ``id:turn``."""

    def shown(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" "))

    what = F.crc32(F.concat(shown(id), F.lit(":"), shown(turn)).cast("binary")) % 20
    rows = conversations.select(F.col(f"`{id}`").alias("c"), F.col(f"`{turn}`").alias("n"), shown(role).alias("r"), shown(text).alias("x"), what.alias("w"))
    rows = rows.where("w <> 0").select(
        F.col("c").alias(id),
        F.col("n").alias(turn),
        F.when(F.col("w") == 4, "user").otherwise(F.col("r")).alias(role),
        F.when(F.col("w") == 1, "").when(F.col("w") == 2, F.regexp_replace("x", "[.!?]", "")).otherwise(F.col("x")).alias(text),
        F.explode(F.sequence(F.lit(1), F.when(F.col("w") == 3, 2).otherwise(1))).alias("copy"),
    )
    return rows.drop("copy")


def arcs_of(initial: int, fault: int) -> tuple:
    """For each state: (letter, cost, state after it) of every edit that consumes this row."""
    stays = TRUNCATED if fault == CUT else 0
    out = []
    for state in range(4):
        arcs = [("D", DELETE, state)]
        if fault not in (BLANK, DUPLICATE):
            if initial + 1 == NEXT[state] or (initial == 0 and state == START):
                arcs.append(("K", KEEP + stays, initial + 1))
            arcs.append(("R", REROLE + stays, NEXT[state]))
        out.append(tuple(arcs))
    return tuple(out)


ARCS = {code: arcs_of(code >> 2, code & 3) for code in range(16)}
LEAST = {code: min(cost for arcs in ARCS[code] for _, cost, _ in arcs) for code in range(16)}


class Lattice:
    """Nodes (row, state) of a piece and its sink, which each state at the end reaches at the cost in ``ends``."""

    def __init__(self, codes: list[int], ends: list):
        self.codes, self.ends, self.n = codes, ends, len(codes)
        self.sink = 4 * (self.n + 1)
        self.price = [0] * (self.sink + 1)
        self.known: list = [None] * self.sink
        beyond = min(e for e in ends if e is not None)
        for row in range(self.n, -1, -1):
            beyond += LEAST[codes[row]] if row < self.n else 0
            self.price[4 * row : 4 * row + 4] = [beyond] * 4

    def arcs(self, node: int) -> list[tuple[str, int, int]]:
        if self.known[node] is not None:
            return self.known[node]
        row, state = divmod(node, 4)
        out = self.known[node] = [("I", INSERT, 4 * row + NEXT[state])]
        if row < self.n:
            out.extend((letter, cost, 4 * row + 4 + after) for letter, cost, after in ARCS[self.codes[row]][state])
        elif self.ends[state] is not None:
            out.append(("", self.ends[state], self.sink))
        return out

    def auction(self, origin: int) -> int:
        """Least cost from ``origin`` to the sink; the prices stay for further origins."""
        price, path = self.price, [origin]
        while path[-1] != self.sink:
            node = path[-1]
            best, nearest = None, None
            for _, cost, after in self.arcs(node):
                if best is None or cost + price[after] < best:
                    best, nearest = cost + price[after], after
            if price[node] < best:
                price[node] = best
                if len(path) > 1:
                    path.pop()
            else:
                path.append(nearest)
        return price[origin]

    def trace(self, origin: int) -> tuple[str, int]:
        """(least string of letters of a least-cost path, state in which it ends), after the auction from ``origin``."""
        if not hasattr(self, "tight"):
            self._find_tight()
        letters, node = [], origin
        while True:
            letter, after = min(self.tight[node])
            if after == self.sink:
                return "".join(letters), node % 4
            letters.append(letter)
            node = after

    def _find_tight(self) -> None:
        """Tight arcs of each node that lead to the sink by tight arcs."""
        self.tight: dict[int, list] = {self.sink: []}
        for row in range(self.n, -1, -1):
            for _ in range(3):  # inserts stay within a row's nodes, and no least-cost path has more than two in a run
                for node in range(4 * row, 4 * row + 4):
                    found = [(letter, after) for letter, cost, after in self.arcs(node) if after in self.tight and self.price[node] == cost + self.price[after]]
                    if found:
                        self.tight[node] = found


def transfer(codes: list[int]) -> list[int]:
    """Least cost of a piece from each state (slow index) to each state, -1 where there is no way."""
    starts = [{START}, {SYSTEM}]
    starts[0] |= {SYSTEM} if any(any(after == SYSTEM for _, _, after in ARCS[c][START]) for c in codes) else set()
    reach = [starts[0] | {USER, ASSISTANT}, starts[1] | {USER, ASSISTANT}, {USER, ASSISTANT}, {USER, ASSISTANT}]
    out = [-1] * 16
    for end in range(4):
        lattice = Lattice(codes, [0 if s == end else None for s in range(4)])
        for start in range(4):
            if end in reach[start]:
                out[4 * start + end] = lattice.auction(start)
    return out


def ways(codes: list[int], ends: list, entries: list[int]) -> tuple[list, list, list]:
    """(letters, state at the end, cost to the end of the conversation) for each state of entry, None for the others."""
    lattice = Lattice(codes, ends)
    letters, exits, costs = [None] * 4, [None] * 4, [None] * 4
    for entry in entries:
        costs[entry] = lattice.auction(entry)
    for entry in entries:
        letters[entry], exits[entry] = lattice.trace(entry)
    return letters, exits, costs


def _from_last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What follows each piece, from pieces sorted by conversation and from its last piece on."""
    last, ends = object(), None
    for batch in batches:
        rows = batch.to_pydict()
        found = []
        for conv, steps in zip(rows["conv"], rows["steps"]):
            if conv != last:
                last, ends = conv, list(ACCEPT)
            found.append(ends)
            ways_on = [[steps[4 * s + t] + ends[t] for t in range(4) if steps[4 * s + t] >= 0 and ends[t] is not None] for s in range(4)]
            ends = [min(w) if w else None for w in ways_on]
        yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("piece"), pa.array(found, pa.list_(pa.int64()))], ["conv", "piece", "ends"])


class _Repaired:
    """The repair of one conversation while its pieces and rows pass in order."""

    def __init__(self):
        self.state, self.cost, self.letters, self.before = START, None, iter(()), None
        self.audit: list[str] = []
        self.counts = [0, 0, 0, 0]
        self.illegal = 0
        self.hash, self.lines = hashlib.sha256(), 0

    def line(self, role: str, text: str) -> None:
        self.hash.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
        self.lines += 1

    def insert(self) -> None:
        self.state = NEXT[self.state]
        self.line(ROLE[self.state], "")

    def piece(self, codes: list[int], letters: list, costs: list) -> None:
        self.rest()
        for code in codes:
            self.counts[code & 3] += 1
            if self.before is not None and (self.before, code >> 2) not in ((0, 1), (1, 2), (2, 1)):
                self.illegal += 1
            self.before = code >> 2
        if self.cost is None:
            self.cost = costs[self.state]
        self.audit.append(letters[self.state])
        self.letters = iter(letters[self.state])

    def row(self, role: str, text: str) -> None:
        for letter in self.letters:
            if letter == "I":
                self.insert()
                continue
            if letter == "R":
                self.state = NEXT[self.state]
                self.line(ROLE[self.state], text)
            elif letter == "K":
                self.state = INITIALS.index(role[0]) + 1
                self.line(role, text)
            return

    def rest(self) -> None:
        for _ in self.letters:
            self.insert()

    def end(self) -> tuple:
        self.rest()
        return (*self.counts[1:], self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())


RESULT = "blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation, from its pieces and rows in order, each piece before its rows."""
    names = [part.split()[0] for part in RESULT.split(", ")]
    types = [pa.int64()] * 5 + [pa.string()] * 2
    last, held, conv_type = None, None, None

    def done(results: list) -> pa.RecordBatch:
        columns = list(zip(*results))
        return pa.RecordBatch.from_arrays([pa.array(columns[0], conv_type), *(pa.array(c, t) for c, t in zip(columns[1:], types))], ["conv", *names])

    for batch in batches:
        conv_type = batch.column("conv").type
        results = []
        fields = [batch.column(n) for n in ("conv", "role", "text", "codes", "letters", "costs")]
        for values in zip(*fields):
            conv, role, text, codes, letters, costs = (v.as_py() for v in values)
            if held is None or conv != last:
                if held is not None:
                    results.append((last, *held.end()))
                last, held = conv, _Repaired()
            if codes is not None:
                held.piece(codes, letters, costs)
            else:
                held.row(role, text)
        if results:
            yield done(results)
    if held is not None:
        yield done([(last, *held.end())])


def _each_piece(df: DataFrame, schema: str, values) -> DataFrame:
    """Columns conv, piece, at and codes of ``df``, followed by what ``values(batch as lists)`` gives."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                kept = [batch.column(n) for n in ("conv", "piece", "at", "codes")]
                more = values(batch.to_pydict())
                yield pa.RecordBatch.from_arrays([*kept, *more.values()], ["conv", "piece", "at", "codes", *more])

    kind = df.schema["conv"].dataType.simpleString()
    return df.mapInArrow(run, f"conv {kind}, piece long, at long, codes array<int>, {schema}")


def repair(
    rows: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", piece_rows: int = PIECE_ROWS
) -> DataFrame:
    """(id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation of ``rows``."""
    named = rows.select(
        F.col(f"`{id}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(" ")).alias("text"),
    )
    order = [F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), "role", F.left("text", F.lit(32)), F.md5("text")]
    ordered = global_row_number(named, order, name="pos")
    piece = F.floor(F.col("pos") / piece_rows).alias("piece")
    initial = F.left("role", F.lit(1))
    code = F.coalesce(F.array_position(F.array(*map(F.lit, INITIALS)), initial) - 1, F.lit(OTHER))
    looks = ordered.select(
        "conv", "turn", "pos", F.when(code < 0, OTHER).otherwise(code).cast("int").alias("initial"),
        (~F.col("text").rlike(VISIBLE)).alias("blank"), (~F.col("text").rlike(SENTENCE_END)).alias("cut"),
        F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")).alias("name"),
    )
    looks = materialize(looks, "conversation-rows")

    first = looks.where("not blank").groupBy("conv", "name").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = first.select(F.col("conv").alias("c"), F.col("name").alias("m"), "first")
    seen = looks.join(first, F.col("conv").eqNullSafe(F.col("c")) & (F.col("name") == F.col("m")), "left")
    fault = F.when(F.col("blank"), BLANK).when(F.col("pos") > F.col("first"), DUPLICATE).when(F.col("cut"), CUT).otherwise(FINE)
    coded = seen.select("conv", "pos", piece, (F.col("initial") * 4 + fault).cast("int").alias("code"))
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("pos", "code"))), lambda x: x["code"])
    pieces = materialize(coded.groupBy("conv", "piece").agg(F.min("pos").alias("at"), in_order.alias("codes")), "conversation-pieces")

    whole = looks.groupBy("conv").agg(
        F.min("turn").alias("low"), F.max("turn").alias("high"), F.count_distinct("turn").alias("turns"), F.min(piece).alias("first_piece"), F.max(piece).alias("last_piece")
    )
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).alias("gaps")
    whole = materialize(whole.select(F.col("conv").alias("c"), gaps, "first_piece", "last_piece"), "conversations")
    placed = pieces.join(whole, F.col("conv").eqNullSafe(F.col("c"))).drop("c", "gaps")

    short = placed.where("first_piece = last_piece").select("conv", "piece", "at", "codes", "first_piece", F.array(*map(F.lit, ACCEPT)).cast("array<bigint>").alias("ends"))
    tasks = -(-pieces.count() // PIECES_A_TASK)  # rows are small and the work on each is not
    long = placed.where("first_piece < last_piece").select("conv", "piece", "at", "codes", "first_piece").repartition(max(1, tasks), "conv", "piece")
    steps = _each_piece(long.drop("first_piece"), "steps array<bigint>", lambda b: {"steps": pa.array([transfer(c) for c in b["codes"]], pa.list_(pa.int64()))})
    steps = steps.select("conv", "piece", "steps").repartition("conv").sortWithinPartitions("conv", F.desc("piece"))
    kind = pieces.schema["conv"].dataType.simpleString()
    ends = steps.mapInArrow(_from_last, f"conv {kind}, piece long, ends array<bigint>").withColumnsRenamed({"conv": "c", "piece": "p"})
    long = long.join(ends, F.col("conv").eqNullSafe(F.col("c")) & (F.col("piece") == F.col("p"))).select(short.columns)

    def traced(batch: dict) -> dict:
        found = [
            ways(codes, end, [START] if piece == first else [0, 1, 2, 3])
            for codes, end, piece, first in zip(batch["codes"], batch["ends"], batch["piece"], batch["first_piece"])
        ]
        letters, _, costs = zip(*found)
        return {"letters": pa.array(letters, pa.list_(pa.string())), "costs": pa.array(costs, pa.list_(pa.int64()))}

    audits = _each_piece(short.unionByName(long), "letters array<string>, costs array<bigint>", traced)
    audits = audits.select("conv", F.col("at").alias("pos"), F.lit(0).alias("of"), F.lit(None).cast("string").alias("role"),
                           F.lit(None).cast("string").alias("text"), "codes", "letters", "costs")
    texts = ordered.select("conv", "pos", F.lit(1).alias("of"), "role", "text", *(F.lit(None).cast(audits.schema[n].dataType).alias(n) for n in ("codes", "letters", "costs")))
    stream = audits.unionByName(texts).repartition("conv").sortWithinPartitions("conv", "pos", "of")
    result = stream.mapInArrow(_hashed, f"conv {kind}, {RESULT}")
    return result.join(whole, F.col("conv").eqNullSafe(F.col("c"))).select(
        F.col("conv").alias(id), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )


def with_all(repaired: DataFrame, conversations: DataFrame, id: str = "conv_id") -> DataFrame:
    """``repaired`` with a row of zeros, an empty audit and the empty text's hash for each other id of ``conversations``."""
    every = conversations.select(F.col(f"`{id}`").alias("original")).distinct()
    nothing = {c: F.lit(0).cast("long") for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    nothing |= {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256().hexdigest())}
    joined = every.join(repaired, F.col("original").eqNullSafe(F.col(id)), "left")
    return joined.select(F.col("original").alias(id), *(F.coalesce(n, value).alias(n) for n, value in nothing.items()))


def duckdb_sql() -> str:
    """``with_all(repair(damage(conversations)), conversations)`` over the view ``conversations``, by dynamic programming."""

    def best(*ways: str) -> str:
        return f"list_sort(list_filter([{', '.join(ways)}], lambda x: x IS NOT NULL))[1]"

    def step(state: str, letter: str, cost: str, line: str, when: str = "true") -> str:
        line = f"{state}.lines || {line}" if line else f"{state}.lines"
        return f"CASE WHEN {state} IS NOT NULL AND ({when}) THEN {{'cost': {state}.cost + {cost}, 'audit': {state}.audit || '{letter}', 'lines': {line}}} END"

    stay = "CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END"
    free = "fault NOT IN ('blank', 'duplicate')"
    own = "[role || ':' || text]"
    before = {0: (), 1: (), 2: ("s0", "s1", "s3"), 3: ("s2",)}
    consumed = []
    for state, initial, name in ((0, "", ""), (1, "s", ""), (2, "u", "user"), (3, "a", "assistant")):
        options = [step(f"s{state}", "D", "4", "")]
        for source in ("s0",) if state == 1 else before[state]:
            options.append(step(source, "K", stay, own, f"{free} AND left(role, 1) = '{initial}'"))
            if name:
                options.append(step(source, "R", f"3 + {stay}", f"['{name}:' || text]", free))
        consumed.append(f"{best(*options)} AS s{state}")
    insert_user = f"SELECT * REPLACE ({best('s2', *(step(s, 'I', '3', chr(91) + repr('user:') + chr(93)) for s in before[2]))} AS s2) FROM"
    insert_assistant = f"SELECT * REPLACE ({best('s3', step('s2', 'I', '3', chr(91) + repr('assistant:') + chr(93)))} AS s3) FROM"

    def closed(rows: str) -> str:  # a run of inserts has two at most, whichever comes first
        return f"({insert_user} ({insert_assistant} ({insert_user} {rows})))"

    node = "STRUCT(cost BIGINT, audit VARCHAR, lines VARCHAR[])"
    begin = f"""(SELECT conv_id, CAST(0 AS BIGINT) AS i, CAST({{'cost': 0, 'audit': '', 'lines': []}} AS {node}) AS s0,
  CAST(NULL AS {node}) AS s1, CAST(NULL AS {node}) AS s2, CAST(NULL AS {node}) AS s3 FROM (SELECT DISTINCT conv_id FROM conversations))"""
    following = f"(SELECT s.conv_id, r.i, {', '.join(consumed)} FROM dp s JOIN coded r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.i = s.i + 1)"
    return f"""WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
dealt AS (SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''), lambda ch: ord(ch)::BIGINT)),
  lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS w FROM named, crc),
damaged AS (SELECT conv_id, turn, CASE WHEN w = 4 THEN 'user' ELSE role END AS role,
  CASE WHEN w = 1 THEN '' WHEN w = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(CASE WHEN w = 3 THEN [1, 2] ELSE [1] END) AS copy FROM dealt WHERE w <> 0),
ordered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, left(text, 32), md5(text), copy) AS i FROM damaged),
coded AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
  WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
  WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated' ELSE 'fine' END AS fault,
  left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) || left(role, 1) AS pair FROM ordered),
dp AS (SELECT * FROM {closed(begin)} UNION ALL SELECT * FROM {closed(following)}),
last AS (SELECT conv_id, {best("s0", "s3")} AS best FROM dp d
  WHERE i = coalesce((SELECT max(i) FROM coded c WHERE c.conv_id IS NOT DISTINCT FROM d.conv_id), 0)),
told AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
  count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
  count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM coded GROUP BY conv_id)
SELECT l.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, best.cost AS cost, best.audit AS audit, sha256(array_to_string(best.lines, chr(10))) AS repaired_sha256
FROM last l LEFT JOIN told t ON t.conv_id IS NOT DISTINCT FROM l.conv_id"""
