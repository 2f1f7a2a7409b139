"""Row-level rules at their edges."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgraph.functions import normalize as nz
from flowgraph.functions import rules, vector
from flowgraph.operators import graph, quality, report, retrieval, staging
from flowgraph.schemas import NETWORK_LOG_COLUMNS


def column(spark, values, kind):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def evaluated(df, expr):
    return [r["out"] for r in df.select("i", expr.alias("out")).orderBy("i").collect()]


def test_vlan_labels(spark):
    texts = [None, "unknown", "NaN", "nan", "1.0", "2.5", "3.5", "abc", "", "None", "1f", "Infinity", "-0.4"]
    got = evaluated(column(spark, texts, "string"), staging.vlan_label(F.col("v")))
    assert got == ["none", "none", "none", "0", "1", "2", "4", "0", "0", "0", "0", "0", "0"]


def test_target_of_missing_tactic(spark):
    got = evaluated(column(spark, [None, "none", "None", "", "Reconnaissance"], "string"), staging.final_target(F.col("v")))
    assert got == ["Normal", "Normal", "Attack", "Attack", "Attack"]


def test_null_text_decides_label_and_duplicate_filter(spark):
    raw = spark.createDataFrame([("a", None, None), ("b", "none", "False"), ("c", "x", "Duplicate")], "uid string, label_tactic string, label_binary string")
    kept = staging.stage_flows(nz.load_normalize(raw))
    assert {r["uid"]: r["final_target"] for r in kept.collect()} == {"b": "Normal"}
    named = staging.stage_flows(nz.load_normalize(raw, null_text="None"))
    assert {r["uid"]: r["final_target"] for r in named.collect()} == {"a": "Attack", "b": "Normal"}


def test_numbers_are_truncated_and_gaps_are_zero(spark):
    df = column(spark, [2.7, -2.7, None, float("nan")], "double")
    assert evaluated(df, nz.to_integer(F.col("v"), T.DoubleType())) == [2, -2, 0, 0]
    df = column(spark, ["7", "2.9", "x", None], "string")
    assert evaluated(df, nz.to_integer(F.col("v"), T.StringType(), "int")) == [7, 2, 0, 0]
    assert evaluated(column(spark, [2**53 + 1], "long"), nz.to_integer(F.col("v"), T.LongType())) == [2**53 + 1]


def test_flags(spark):
    assert evaluated(column(spark, [True, None, False], "boolean"), nz.to_flag(F.col("v"), T.BooleanType())) == [1, 0, 0]
    texts = column(spark, ["1", "5", "-3", "0.7", "true"], "string")
    assert evaluated(texts, nz.to_flag(F.col("v"), T.StringType())) == [1, 1, 0, 0, 0]


def test_times_do_not_depend_on_the_session_zone(spark):
    df = column(spark, ["2024-07-01 12:00:00", "2024-07-01T12:00:00Z", "2024-07-01 14:00:00.123456+02:00", "x", None], "string")
    noon, epoch = dt.datetime(2024, 7, 1, 12), dt.datetime(1970, 1, 1)
    wanted = [noon, noon, noon.replace(microsecond=123000), epoch, epoch]
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert evaluated(df, nz.to_utc(F.col("v"), T.StringType())) == wanted
            zoned = df.limit(1).select("i", F.timestamp_micros(F.lit(1719835200000000)).alias("v"))
            assert evaluated(zoned, nz.to_utc(F.col("v"), T.TimestampType())) == [noon]
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_text_gaps(spark):
    df = column(spark, [None, "a", "nan"], "string")
    assert evaluated(df, nz.to_text(F.col("v"), T.StringType(), "None")) == ["None", "a", ""]
    assert evaluated(df, nz.to_text(F.col("v"), T.StringType(), None)) == [None, "a", ""]
    df = column(spark, [1.5, float("nan")], "double")
    assert evaluated(df, nz.to_text(F.col("v"), T.DoubleType(), "None")) == ["1.5", ""]


def test_load_order_and_types(spark):
    out = nz.load_normalize(spark.createDataFrame([("a",)], "uid string"))
    assert out.columns == NETWORK_LOG_COLUMNS
    kinds = {f.name: f.dataType.simpleString() for f in out.schema}
    assert kinds["orig_bytes"] == "bigint" and kinds["src_port_zeek"] == "int" and kinds["local_orig"] == "tinyint"
    row = out.first()
    assert (row["local_orig"], row["duration"], row["service"], row["datetime"]) == (0, 0.0, "", dt.datetime(1970, 1, 1))


def clean_rows(spark, rows):
    columns = "src_ip_zeek string, dest_ip_zeek string, log_duration double, label int"
    df = spark.createDataFrame(rows, columns)
    zero = {c: F.lit(0) for c in "proto_tcp proto_udp proto_icmp srv_http srv_dns".split()}
    return df.withColumns({**zero, "log_orig_bytes": F.lit(0.0), "log_resp_bytes": F.lit(0.0)})


def test_edges_skip_null_ips_and_single_rows_have_no_deviation(spark):
    rows = [("b", "a", 1.0, 0), ("b", "a", 3.0, 1), ("a", "c", 1.0, 0), (None, "a", 1.0, 1), ("z", None, 1.0, 0)]
    pairs = graph.pair_stats(clean_rows(spark, rows))
    ids = graph.node_mapping(pairs)
    assert {r["ip"]: r["node_id"] for r in ids.collect()} == {"a": 0, "b": 1, "c": 2, "z": 3}
    edges = {(r["source_idx"], r["target_idx"]): r for r in graph.super_edges(pairs, ids).collect()}
    assert set(edges) == {(1, 0), (0, 2)}
    assert edges[0, 2]["std_log_duration"] is None
    assert edges[1, 0]["std_log_duration"] == pytest.approx(2**0.5) and edges[1, 0]["label"] == 1


def test_node_ids_follow_text_order(spark):
    pairs = spark.createDataFrame([("10.0.0.2", "10.0.0.10"), ("9.9.9.9", "10.0.0.2")], "src_ip_zeek string, dest_ip_zeek string")
    got = {r["ip"]: r["node_id"] for r in graph.node_mapping(pairs).collect()}
    assert got == {"10.0.0.10": 0, "10.0.0.2": 1, "9.9.9.9": 2}


BOUNDARIES = [
    # duration, orig, resp, tcp, http, dns -> full, compact
    ((3.1, 8.1, 0, 0, 0, 0), "T1041", "T1041"),
    ((3.0, 8.1, 0, 0, 0, 0), "T1190", "T1190"),
    ((-1.1, -1.1, 0, 0, 0, 0), "T1046", "T1046"),
    ((-1.0, -1.1, 0, 0.6, 0, 0), "T1110", "T1110"),
    ((-0.9, 0, 0, 0, 0.41, 0), "T1190", "T1190"),
    ((2.1, 0, 0, 0.71, 0, 0), "T1071", "T1071"),
    ((2.1, 5.0, -2, 0.71, 0, 0), "T1190", "T1071"),
    ((2.1, -2.0, 0, 0.81, 0, 0.4), "T1568", "T1071"),
    ((0, 0, 0, 0, 0, 0.31), "T1568", "T1568"),
    ((-0.1, 0, 0, 0.51, 0, 0), "T1190", "T1110"),
    ((0, 0, -0.9, 0.81, 0, 0), "T1021", "T1021"),
    ((0, 0, -1.0, 0.81, 0, 0), "T1190", "T1021"),
    ((0, 0, 0, 0, 0, 0), "T1190", "T1190"),
]


def test_technique_rules_at_their_bounds(spark):
    vectors = [[0.0, float(d), float(o), float(r), float(t), 0.0, float(h), float(n)] for (d, o, r, t, h, n), _, _ in BOUNDARIES]
    df = column(spark, vectors, "array<double>")
    for i, variant in enumerate(("full", "compact")):
        got = evaluated(df, rules.assign_technique(F.col("v"), variant)["id"])
        assert got == [b[1 + i] for b in BOUNDARIES]
    default = evaluated(df, rules.assign_technique(F.col("v"))["description"])
    assert default[-1] == "Web exploitation attempt" and default[4] == "Web server exploitation attempt"
    assert set(evaluated(df, rules.assign_technique(F.col("v"), "compact")["description"])) == {None}


def test_threat_levels_and_bands(spark):
    df = spark.createDataFrame([(0, 0.9, 1), (1, 0.7, 1), (2, 0.9, 0), (3, 0.2, 1)], "i int, s double, n int")
    level = rules.threat_level(F.col("s"), rules.prediction(F.col("s")), F.col("n"))
    assert evaluated(df, level) == ["HIGH", "MEDIUM", "LOW", "LOW"]
    assert evaluated(column(spark, [9.0, 7.0, 6.9], "double"), rules.severity_band(F.col("v"))) == ["Critical", "High", "Medium"]
    assert evaluated(column(spark, [0.0, 49.9, 50.0, 75.0, 100.0], "double"), rules.gauge_band(F.col("v"))) == [
        "0-50", "0-50", "50-75", "75-100", "75-100",
    ]


def test_query_texts_are_reproducible_and_use_their_phrases(spark):
    df = spark.range(200).select(F.col("id").alias("i"), F.array(*[F.lit(float(x)) for x in (0, 6, 11, 0.9, 1, 0, 0, 0)]).alias("v"))
    first = evaluated(df, rules.query_text(F.col("i"), F.col("v"), F.lit(0.9)))
    assert first == evaluated(df.repartition(5), rules.query_text(F.col("i"), F.col("v"), F.lit(0.9)))
    parts = {"critical security vulnerability", "persistent backdoor communication", "data exfiltration"}
    assert all(all(p in t for p in parts) for t in first) and len(set(first)) > 1
    second = evaluated(df, rules.query_text_2(F.col("i"), F.col("v")))
    phrases = [*rules.BASE_PHRASES, "persistent backdoor trojan malware", "data exfiltration theft leakage", "TCP protocol vulnerability"]
    counts = {sum(p in t for p in phrases) for t in second}
    assert counts == {2, 3, 4}


def test_query_text_without_bytes_phrase(spark):
    df = column(spark, [[0.0, -1.0, 5.0, 0.0]], "array<double>")
    got = evaluated(df, rules.query_text(F.col("i"), F.col("v"), F.lit(0.6)))[0]
    assert sorted(got.split(" ")) == sorted("suspicious network activity reconnaissance scanning".split(" "))


def test_severity_filter_zero_filters_and_none_does_not(spark):
    df = spark.createDataFrame([("a", -1.0), ("b", 0.0), ("c", 8.0)], "cve_id string, severity_score double")
    assert retrieval.metadata_filter(df, min_severity=0).count() == 2
    assert retrieval.metadata_filter(df).count() == 3


def test_zero_vector_has_similarity_zero(spark):
    df = spark.createDataFrame([(0, [0.0, 0.0], [1.0, 2.0]), (1, [2.0, 0.0], [3.0, 0.0])], "i int, a array<double>, b array<double>")
    assert evaluated(df, vector.cosine(F.col("a"), F.col("b"))) == [0.0, 1.0]
    assert evaluated(df, vector.l2_normalize(F.col("a"))) == [[0.0, 0.0], [1.0, 0.0]]


def test_triad_counts_missing_technique_as_a_value(spark):
    rows = [("q", 0.8, "T1", 9.0, 2019, 0.9), ("q", 0.6, None, 1.0, 2021, 0.9), ("r", 0.4, "T1", 1.0, 2001, 0.1)]
    df = spark.createDataFrame(rows, "query_id string, similarity double, mitre_id string, severity double, year int, score double")
    got = {r["query_id"]: r for r in retrieval.triad_per_query(df, 0.7).collect()}
    assert got["q"]["context_relevance"] == pytest.approx(0.7)
    assert got["q"]["groundedness"] == 0.75 and got["q"]["answer_relevance"] == 1.0
    assert got["r"]["groundedness"] == 0.0 and got["r"]["answer_relevance"] == 0.0


def test_triad_summary_without_hits(spark):
    queries = spark.createDataFrame([("q",), ("r",)], "query_id string")
    empty = spark.createDataFrame([], "query_id string, similarity double, mitre_id string, severity double, year int, score double")
    row = retrieval.triad_summary(queries, empty, 0.7).first()
    assert all(v == 0 for v in row)


def test_severity_ties_and_gaps_in_technique_index(spark):
    rows = [("b", "T1", 5.0, 2000), ("a", "T1", 5.0, 2000), ("c", "T1", None, 2000), ("d", None, 9.0, 2000)]
    df = spark.createDataFrame(rows, "cve_id string, matched_mitre_id string, severity_score double, year int")
    got = [(r["rank"], r["cve_id"]) for r in retrieval.technique_index(df, 5).orderBy("rank").collect()]
    assert got == [(1, "a"), (2, "b"), (3, "c")]


def test_gates(spark):
    df = spark.createDataFrame([("a",)], "proto string")
    assert sorted(r["column_name"] for r in quality.missing_columns(df).collect()) == sorted(
        ["src_ip_zeek", "dest_ip_zeek", "label_tactic", "label_binary", "source_period"]
    )
    with pytest.raises(quality.CheckFailed):
        quality.require_columns(df)
    with pytest.raises(quality.CheckFailed):
        quality.require_rows(df.limit(0), "x")
    assert quality.expect_count(5, 1176, "nodes", skip_if=True) is False
    assert quality.expect_count(1176, 1176, "nodes") is True
    with pytest.raises(quality.CheckFailed):
        quality.expect_count(5, 1176, "nodes")
    gate = quality.count_gate(df, 2, truncated=True).first()
    assert (gate["checked"], gate["ok"]) == (False, True)


def test_accepted_values_let_null_pass(spark):
    df = spark.createDataFrame([("tcp",), (None,), ("sctp",)], "proto string")
    got = quality.column_checks(df, "t", ["proto"], {"proto": ["tcp"]}).collect()
    assert [(r["check_name"], r["violations"]) for r in got] == [("not_null", 1), ("accepted_values", 1)]


def test_analysis_of_a_normal_edge_names_no_technique(spark):
    scored = spark.createDataFrame(
        [(0, 300, 2, [1.0] * 8, 1, 0.2), (1, 1, 2, [0.0] * 8, 1, 0.9)],
        "edge_idx long, src long, dst long, attr array<double>, y int, score double",
    )
    cves = spark.createDataFrame([("c", "T1190", 5.0, 2000)], "cve_id string, matched_mitre_id string, severity_score double, year int")
    got = {r["edge_id"]: r for r in report.export_records(report.analyze_edges(scored, cves)).collect()}
    assert (got[0]["mitre_technique"], got[0]["cve_ids"], got[0]["match"], got[0]["source_ip"]) == ("N/A", [], False, "10.0.1.44")
    assert (got[1]["mitre_technique"], got[1]["cve_ids"], got[1]["confidence"]) == ("T1190", ["c"], "90.00%")
