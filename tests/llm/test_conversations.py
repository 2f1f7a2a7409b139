"""Conversation repair against plain dynamic programming over (cost, letters)."""

import hashlib
import random
import re
import zlib

import pytest

from flowgraph.llm import conversation_repair as repair


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if role is None else role), (" " if text is None else text)
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        what = zlib.crc32(key.encode()) % 20
        if what == 0:
            continue
        text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
        out += [(conv, turn, "user" if what == 4 else role, text)] * (2 if what == 3 else 1)
    return out


def plain_repair(rows):
    """What the contract says of the damaged rows of one conversation."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3][:32], hashlib.md5(r[3].encode()).hexdigest()))
    faults, seen = [], set()
    for _, _, role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    initials = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    best = {"": (0, "", [])}  # what came last -> (cost, letters, lines)

    def offer(into, last, way):
        if last not in into or way[:2] < into[last][:2]:
            into[last] = way

    def inserts(ways):
        for _ in range(3):
            for last, (cost, letters, lines) in list(ways.items()):
                role = "assistant" if last == "u" else "user"
                offer(ways, role[0], (cost + 3, letters + "I", [*lines, f"{role}:"]))
        return ways

    best = inserts(best)
    for (_, _, role, text), fault in zip(rows, faults):
        after = {}
        for last, (cost, letters, lines) in best.items():
            offer(after, last, (cost + 4, letters + "D", lines))
            if fault in ("b", "d"):
                continue
            more = 3 if fault == "t" else 0
            need = "assistant" if last == "u" else "user"
            if role[:1] == need[0] or (role[:1] == "s" and last == ""):
                offer(after, role[0], (cost + more, letters + "K", [*lines, f"{role}:{text}"]))
            offer(after, need[0], (cost + more + 3, letters + "R", [*lines, f"{need}:{text}"]))
        best = inserts(after)
    cost, letters, lines = min((best[k] for k in ("", "a") if k in best), key=lambda w: w[:2])
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, letters, digest)


def plain(rows):
    damaged = plain_damage(rows)
    return {c: plain_repair([r for r in damaged if r[0] == c]) for c in {r[0] for r in rows}}


def found(spark, rows, **more):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, conv string, pos long")
    out = repair.with_all(repair.repair(repair.damage(df), **more), df).collect()
    assert len(out) == len({r["conv_id"] for r in out})
    return {r["conv_id"]: tuple(r)[1:] for r in out}


def random_rows(seed, convs, longest):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why?\n", "open end", " ", "", None, "a.b", "Good. \t", "☃."]
    rows = []
    for conv in range(convs):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.3 else ("system" if turn == 0 and rng.random() < 0.4 else ["user", "assistant"][turn % 2])
            rows.append((conv, turn, role, rng.choice(texts) if rng.random() < 0.4 else f"text {conv} {turn}."))
    return rows


@pytest.mark.parametrize("piece_rows", [1, 3, 128])
def test_repair_is_the_cheapest_and_least(spark, piece_rows):
    rows = random_rows(piece_rows, 60, 25)
    assert found(spark, rows, piece_rows=piece_rows) == plain(rows)


def test_long_conversation(spark):
    rows = random_rows(5, 1, 1)[:0] + [(7, t, ["user", "assistant"][(t + t // 50) % 2], f"t {t}" + "." * (t % 9 > 0)) for t in range(1500)]
    assert found(spark, rows) == plain(rows)


def test_nulls_ties_repeats_and_very_long_texts(spark):
    rows = [
        (None, None, None, None), (None, 1, "user", "Hi."), (1, None, "user", "Hi."), (1, None, "user", "Hi."), (1, None, "assistant", "Yes."),
        (2, 5, "user", "x" * 300_000 + "."), (2, 5, "user", "x" * 300_000 + "!"), (2, 6, "assistant", ""), (3, 1, "", "Odd."), (3, 2, "sys", "Odd."),
        (3, 3, "tool", "Odd."), (4, -3, "user", "A.\x00"), (4, 2**40, "assistant", "B."), (5, 1, "system", "Only."), (6, 1, "assistant", "Only."),
    ]
    rows += [(8, 1, "user", "Same.")] * 400
    assert found(spark, rows, piece_rows=16) == plain(rows)


def test_a_conversation_without_rows_and_no_table(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert found(spark, [(gone, 0, "user", "Hi.")]) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.with_all(repair.repair(repair.damage(df)), df).count() == 0


def test_prices_never_exceed_arcs():
    rng = random.Random(3)
    for _ in range(200):
        codes = [rng.randrange(16) for _ in range(rng.randint(0, 30))]
        lattice = repair.Lattice(codes, [0, None, rng.choice([None, 2]), 1])
        for origin in range(4):
            lattice.auction(origin)
        assert all(lattice.price[n] <= cost + lattice.price[after] for n in range(lattice.sink) for _, cost, after in lattice.arcs(n))
