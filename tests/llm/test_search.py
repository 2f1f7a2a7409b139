"""Searches and joins: top-k, near copies, leaks, personal data, urls."""

import random

import numpy as np
import pyarrow as pa
import pytest
from brute import base_spans, edit_occurrence, linked_components

from flowgraph.llm import decontaminate, jaccard, pii, queries, topk, url_templates
from flowgraph.llm.components import components


def _plain_topk(queries_, own, vectors, ids, k):
    out = []
    for q, i in zip(queries_, own):
        score = vectors @ q
        others = ids != i
        best = np.lexsort((ids[others], -score[others]))[:k]
        out += [(int(i), int(ids[others][b]), int(score[others][b])) for b in best]
    return sorted(out)


def test_topk_of_random_blocks():
    rng = np.random.default_rng(0)
    for _ in range(60):
        n, d, k = int(rng.integers(1, 3000)), int(rng.integers(1, 20)), int(rng.integers(1, 25))
        vectors = rng.integers(-6, 7, (n, d))
        if rng.random() < 0.5:
            vectors[rng.random(n) < 0.4] = vectors[0]
        ids, some = rng.permutation(n), rng.choice(n, min(n, 10), replace=False)
        got = topk.block_topk(vectors[some], ids[some], vectors, ids, k)
        assert sorted(zip(*(x.tolist() for x in got))) == _plain_topk(vectors[some], ids[some], vectors, ids, k)


def test_topk_stops_early_on_proof():
    rng = np.random.default_rng(2)
    centres = rng.integers(-40, 41, (20, 16))
    vectors = centres[rng.integers(0, 20, 20_000)] + rng.integers(-2, 3, (20_000, 16))
    index = topk.ImpactIndex(vectors)
    query = vectors[0].astype(float)
    rows = index.search(query, 10, 5000)
    assert len(rows) < 5000
    exact = vectors @ query
    assert set(np.flatnonzero(exact > np.sort(exact)[-10])) <= set(rows)


def test_topk_edges(spark):
    rows = [
        (0, [0.5, 0.25]), (1, [0.5, 0.25]), (2, None), (3, []), (4, [None, 1.0]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]),
        (20, [-0.01, 1.0]), (21, [1.0]), (None, [1.0, 1.0]), (1, [0.5, 0.25]), (40, [0.1, 0.2, 0.3]),
    ]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, score long, query_id string")
    found = topk.search(df, df.where("vec_id % 20 = 0"), 2, candidates_a_block=2, queries_a_block=1).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found) == [
        (0, 1, 1, 32 * 32 + 16 * 16), (0, 2, 1, 32 * 32 + 16 * 16), (20, 1, 0, -32 + 64 * 16), (20, 2, 1, -32 + 64 * 16),
    ]
    assert topk.search(df.limit(0), df, 2).count() == 0 and topk.search(df, df.limit(0), 2).count() == 0


VOCABULARY = [f"w{i}" for i in range(400)]


def _near_copies(seed):
    rnd = random.Random(seed)
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A b"), (6, "b a"), (7, "a b c d e"), (8, "a b c d e"), (8, "a b c d e")]
    i = 10
    for _ in range(30):
        base = [rnd.choice(VOCABULARY) for _ in range(rnd.choice([5, 8, 9, 12, 30, 80, 300]))]
        for _ in range(rnd.randint(1, 12)):
            p = rnd.choice([0, 0.005, 0.01, 0.02, 0.05])
            words = [rnd.choice(VOCABULARY) if rnd.random() < p else w for w in base]
            rows.append((i, " ".join(words + rnd.sample(VOCABULARY, rnd.randint(0, 1)))))
            i += 1
    passage = [rnd.choice(VOCABULARY) for _ in range(60)]
    for _ in range(40):
        rows.append((i, " ".join(passage + [rnd.choice(VOCABULARY) for _ in range(rnd.randint(0, 40))])))
        i += 1
    rnd.shuffle(rows)
    return rows


def _found(spark, rows):
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], "doc_id long, text string, id string, n long").repartition(3)
    return sorted(tuple(r) for r in jaccard.link(df).select("doc_id", "n_shingles", "component_id").collect())


@pytest.mark.parametrize("border", [None, 0, 20, 256])
def test_join_of_near_copies(spark, monkeypatch, border):
    rows = _near_copies(9)
    if border is not None:
        monkeypatch.setattr(jaccard, "light_border", lambda *a: border)
    else:
        monkeypatch.setattr(jaccard, "PAIRS_A_POSTING", 0)  # leaders as long as they find anything
    assert _found(spark, rows) == sorted(linked_components(rows))


def test_join_with_frequent_members_last(spark, monkeypatch):
    rows = _near_copies(4)
    monkeypatch.setattr(jaccard, "SAMPLE", 1)
    monkeypatch.setattr(jaccard, "PAIRS_A_POSTING", 2)
    assert _found(spark, rows) == sorted(linked_components(rows))


def test_join_of_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"]) for r in queries.table(spark, sf_dir, "documents").collect()]
    found = sorted(tuple(r) for r in queries.op9_jaccard(spark, sf_dir).collect())
    assert found == sorted(linked_components(rows))


def test_join_edges(spark, awkward, nothing):
    assert jaccard.link(nothing).count() == 0 and jaccard.one_of_each(nothing).count() == 0
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    found = jaccard.link(awkward).select("doc_id", "n_shingles", "component_id").collect()
    key = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted(map(key, found)) == sorted(map(key, linked_components(rows)))
    left = jaccard.one_of_each(awkward)
    assert left.columns == awkward.columns
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in left.collect()) == [-1, 1, 2, 3, 4, 6, 7, 8, 9, 9]


def test_light_border_has_least_cost():
    assert jaccard.light_border({}, 1.0, 80) == 0
    few, many = (jaccard.light_border({n: 10 for n in range(5, 257)}, mean, 80) for mean in (1.0, 50.0))
    assert few < many


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(300, 200), (200, 250)]
    random.Random(1).shuffle(links)
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 150)}, 200: 200, 250: 200, 300: 200}


def test_bit_parallel_distance():
    rnd = random.Random(2)
    for _ in range(1000):
        pattern = "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 70)))
        text = "".join(rnd.choice("abc") for _ in range(rnd.randint(0, 90)))
        got, plain = decontaminate.occurrence(pattern, text), edit_occurrence(pattern, text)
        assert got[0] == plain[0] and (got == plain or got[0] == len(pattern))


def test_leaks_with_edits(spark, documents):
    items = [(i, r["text"]) for i, r in enumerate(documents.where("length(text) between 90 and 300").limit(12).collect())]
    rnd, rows = random.Random(8), []
    for i, text in items:
        for edits in (0, int(0.04 * len(text)), int(0.3 * len(text))):
            chars = list(text)
            for _ in range(edits):
                chars[rnd.randrange(len(chars))] = rnd.choice("qxz ")
            rows.append((len(rows), "Before it. " * 3 + "".join(chars).upper().replace(" ", " \n") + " after"))
    docs, benchmark = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r for r in decontaminate.find_leaks(docs, benchmark).collect()}
    normal = lambda t: decontaminate.normal_form(pa.array([t]))[0].as_py()
    plain = {}
    for d, text in rows:
        for i, item in items:
            distance = edit_occurrence(normal(item), normal(text))[0]
            if distance <= int(len(normal(item)) * decontaminate.RATE):
                plain[d, i] = distance
    assert {k: r["distance"] for k, r in found.items()} == plain and len(plain) >= 10
    for (d, i), r in found.items():
        part = normal(rows[d][1][r["start"] : r["end"]])
        assert edit_occurrence(normal(items[i][1]), part)[0] == r["distance"]
    clean = decontaminate.without_leaks(docs, benchmark)
    assert {r["doc_id"] for r in clean.collect()} == {d for d, _ in rows} - {d for d, _ in plain}


def test_leaks_in_shards_and_edges(spark, awkward, nothing, documents, sf_dir):
    benchmark = queries.table(spark, sf_dir, "benchmark")
    parts = list(decontaminate.shards(benchmark, shard_bytes=2000))
    assert len(parts) > 3 and sum(map(len, parts)) == benchmark.count()
    whole = decontaminate.PieceIndex([x for p in parts for x in p], decontaminate.RATE)
    expected = set()
    for r in documents.collect():
        text = decontaminate.normal_form(pa.array([r["text"] or ""]))[0].as_py()
        expected |= {(r["doc_id"], whole.items[i][0]) for i, *_ in whole.find(text)}
    assert {(r["doc_id"], r["item_id"]) for r in queries.op6_decontamination(spark, sf_dir).collect()} == expected
    odd = spark.createDataFrame([(1, None), (2, ""), (3, " "), (4, "one"), (4, "one")], "item_id long, text string")
    found = decontaminate.find_leaks(awkward, odd).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found if r["doc_id"] in (4, 5)) == [(4, 4)] * 2 + [(5, 4)] * 4
    assert decontaminate.find_leaks(nothing, odd).count() == 0 and decontaminate.find_leaks(awkward, odd.limit(0)).count() == 0
    assert decontaminate.without_leaks(awkward, odd.limit(0)).count() == 12


def test_base_spans_are_those_of_the_patterns():
    rnd = random.Random(4)
    for letters in ["01 .-+()@a", "0123456789", "1.2 ", "12.+()- ", "ab@.-1 ", "0 -5"]:
        for _ in range(2000):
            text = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60)))
            assert pii.base_spans(text) == base_spans(text), text


def test_best_segmentation_is_that_of_all():
    rng = np.random.default_rng(3)

    def best(n, spans, scores, at=0):
        if at >= n:
            return 0.0
        ways = [best(n, spans, scores, at + 1)]
        ways += [scores[r].max() + best(n, spans, scores, j) for r, (i, j) in enumerate(spans) if i == at]
        return max(ways)

    for _ in range(200):
        n = int(rng.integers(1, 8))
        spans = [(i, j) for i in range(n) for j in range(i + 1, min(n, i + 4) + 1) if rng.random() < 0.7]
        scores = rng.normal(size=(len(spans), 4))
        row = {s: r for r, s in enumerate(spans)}
        got = sum(scores[row[i, j], k] for k, i, j in pii.decode(n, spans, scores))
        assert got == pytest.approx(best(n, spans, scores))


def test_segments_beyond_the_patterns(spark):
    weights = pii.train(queries.table(spark, "/root/testdata/sf0.1", "documents"))
    found = lambda t: [(pii.KINDS[k], t[a:b]) for k, a, b in pii.find_spans(t, weights)[1]]
    assert found("call (743) 555-3220 now") == [("phone", "(743) 555-3220")]
    assert found("card 4539.5787.6362.1486 ok") == [("card", "4539.5787.6362.1486")]
    assert found("mail john.doe [at] example.com please") == [("email", "john.doe [at] example.com")]
    assert found("order 1234567890123456 of 2024-01-15 10:30, 3.14159265 or 1,234,567.89") == []
    assert pii.masked("to a@b.example.org and 10.0.0.1!", weights) == "to <email> and <ip>!"


def test_pii_query_and_edges(spark, documents, sf_dir, awkward, nothing):
    import hashlib

    texts = {r["doc_id"]: r["text"] or "" for r in documents.collect()}
    rows = queries.op4_pii(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = base_spans(texts[r["doc_id"]])
        written = [f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(written).encode()).hexdigest()
        assert [r[f"n_{kind}"] for kind in pii.KINDS] == [sum(k == i for k, *_ in base) for i in range(4)]
        assert set(written) <= set(r["spans"].split(",") if r["spans"] else [])
    weights = pii.train(nothing)
    assert pii.detect(nothing, weights).count() == 0 and pii.detect(awkward, weights).count() == 12
    masked = {r["doc_id"]: r["text"] for r in pii.mask(awkward.where("doc_id in (1, 9)"), pii.train(awkward)).where("text is null or text like 'Call%'").collect()}
    assert masked == {1: None, 9: "Call <phone> or mail <email> now\nor not"}
    assert pii.mask(awkward, weights).columns == awkward.columns


def test_urls_and_rules(spark):
    urls = [
        "HTTP://WWW.Example.COM/en/1", "http://x.example.com/en/", "http://example.com/en", "http://example.com", "http://a.net/es/x?y", "http://net/es/",
        "http://Éa.net/fr/#t", "no scheme", None, "", "://h/p", "a://b://c/d", "http://a.com?x/y", "http://u@h:80/p\nq/r", "http://www.example.com.net/fr/",
        "http://a.org/" + "d/" * 9,
    ]
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate([*urls, urls[0]])], "page_id long, url string, host string")
    found = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_templates.judge_urls(df, queries.URL_RULES).collect()}
    assert len(found) == len(urls) + 1 and found[len(urls)] == found[0]
    assert found[0] == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert found[1][2:] == ("example.com/en/", "block") and found[2][2:] == ("com/", "allow") and found[3][1:3] == ("", None)
    assert found[4] == ("a.net", "/es/x", "net/es/", "block") and found[5][2] == "net/es/" and found[6][0] == "Éa.net"
    assert found[7][:3] == found[8][:3] == found[9][:3] == ("", "", None) and found[10][:2] == ("h", "/p") and found[11][:2] == ("b:", "//c/d")
    assert found[12][:2] == ("a.com", "") and found[13][:2] == ("u@h:80", "/p\nq/r") and found[14][2] == "net/fr/"
    assert url_templates.judge_urls(df.limit(0), queries.URL_RULES).count() == 0


def test_templates_learn_from_rules(spark):
    rows = [f"http://h.org/shop/{i}" for i in range(30)] + [f"http://h.org/news/{i}" for i in range(30)] + [f"http://h.org/{i}x/y" for i in range(9)]
    df = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    found = url_templates.judge_urls(df, [("h.org/shop/1", "block"), ("h.org/news/1", "allow")])
    verdicts = {(r["path"].split("/")[1], r["rule"]): (r["verdict"], r["template"]) for r in found.collect() if not r["path"].endswith("y")}
    assert verdicts["shop", None] == ("block", "/shop/~") and verdicts["news", None] == ("allow", "/news/~")


def test_urls_as_in_sql(spark, sf_dir):
    from checks import compare

    con = compare.duck(sf_dir)
    for name, sql in queries.ORACLES.items():
        assert compare.difference(queries.QUERIES[name](spark, sf_dir), con, sql) is None


def test_deep_paths_are_told_apart(spark):
    """Sections that differ below the fourth segment only, each with its own rule, and a path that is alone."""
    urls = [f"http://h.org/a/b/c/d/{part}/x{'abcdefgh'[i % 8]}{'klmno'[i // 8]}" for part in ("good", "bad") for i in range(40)]
    rules = [("h.org/a/b/c/d/good/xa", "allow"), ("h.org/a/b/c/d/bad/xa", "block"), ("h.org/a/b/c/d/bad/xb", "block")]
    urls += ["http://h.org/" + "s/" * 3000 + "end", "http://deep.org/" + "q" * 20_000, None]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = {r["page_id"]: r["verdict"] for r in url_templates.judge_urls(pages, rules).collect()}
    assert [found[i] for i in range(40)] == ["allow"] * 40 and [found[i] for i in range(40, 80)] == ["block"] * 40
    assert found[80] == found[81] == found[82] == "allow"
    import duckdb

    connection = duckdb.connect()
    connection.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    connection.executemany("INSERT INTO pages VALUES (?, ?)", list(enumerate(urls)))
    plain = connection.execute(url_templates.duckdb_sql(rules)).fetchall()
    assert {r[0]: r[4] for r in plain} == found


def test_one_host_holds_most_urls(spark):
    pages = spark.range(30_000).selectExpr("id page_id", "if(id % 3 = 0, concat('http://rare', id % 50, '.org/p'), concat('http://hot.com/s', substr('abcdefg', cast(id % 7 as int) + 1, 1), '/', id)) url")
    found = url_templates.judge_urls(pages, [("hot.com/sb/", "block")]).groupBy("verdict").count().collect()
    assert {r["verdict"]: r["count"] for r in found} == {"block": sum(i % 3 != 0 and i % 7 == 1 for i in range(30_000)), "allow": sum(i % 3 == 0 or i % 7 != 1 for i in range(30_000))}


def test_written_out_addresses_are_candidates_as_a_whole():
    text = "write to john.doe99 [at] mail.example.co.uk or 4 5 3 9 1 4 8 8 0 3 4 3 6 4 6 7 now"
    borders_of = lambda a, b: pii.segments(text, a, b)
    whole = {text.index("john"): text.index(" or"), text.index("4 5"): text.index(" now")}
    found = {}
    for a, b in pii.islands(text):
        borders, spans, _ = borders_of(a, b)
        found |= {(borders[i], borders[j]): True for i, j in spans}
    assert all((a, b) in found for a, b in whole.items())
    long = "x1" * 5000 + "@" + "y2." * 5000
    (a, b), *more = pii.islands(long)
    assert not more and a == 10_000 - pii.MAX_TOKENS and len(pii.segments(long, a, b)[1]) < 10_000


def test_linked_texts_under_one_id_leave_one(spark):
    words = [f"w{i}" for i in range(60)]
    near = " ".join(words[:-1] + ["other"])
    rows = [(5, " ".join(words)), (5, near), (5, near), (7, near), (5, "one two three four five six"), (9, "lone words"), (None, near), (5, ""), (6, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = jaccard.one_of_each(docs).collect()
    assert sorted(r["doc_id"] for r in left if r["doc_id"] is not None) == [5, 5, 5, 6, 9] and len(left) == 6
    fives = [r["text"] for r in left if r["doc_id"] == 5]
    assert "" in fives and "one two three four five six" in fives and sum(t in (near, rows[0][1]) for t in fives) == 1


def test_a_join_leaves_no_table_but_its_result(spark, documents):
    import os

    from flowgraph.session import shared_dir

    def tables():
        return {n for n in os.listdir(shared_dir(spark).removeprefix("file:")) if "-" in n}

    before = tables()
    jaccard.link(documents).count()
    assert {n.rsplit("-", 1)[0] for n in tables() - before} == {"linked"}
    before = tables()
    jaccard.one_of_each(documents).count()
    assert {n.rsplit("-", 1)[0] for n in tables() - before} == {"judged"}


def test_near_copies_of_one_component_leave_no_lists(spark, monkeypatch):
    """What a group of near copies is listed under is found by its least hashes first, and then not kept."""
    rnd, rows = random.Random(7), []
    base = [f"x{i}" for i in range(120)]
    for i in range(150):
        words = list(base)
        words[rnd.randrange(120)] = f"y{i}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(rnd.choice(VOCABULARY) for _ in range(60))) for i in range(50)]
    kept, write = [], jaccard.Scratch.write

    def counting(self, df, name="step"):
        out = write(self, df, name)
        if name == "postings":
            kept.append(out.count())
        return out

    monkeypatch.setattr(jaccard.Scratch, "write", counting)
    assert _found(spark, rows) == sorted(linked_components(rows))
    assert kept[0] <= len(rows)
