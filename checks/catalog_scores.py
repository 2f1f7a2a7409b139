"""Checked queries on scored edges: metrics, rules, selection, reports, graph scoring."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import inputs
from checks.catalog_flows import edges, spread
from checks.registry import query, rounded
from flowgraph.functions import rules, vector
from flowgraph.operators import attention, evaluation, quality, report, training
from flowgraph.operators.graph import edge_inputs
from flowgraph.plans import batch
from flowgraph.schemas import SEED
from flowgraph.session import materialize, new_path
from flowgraph.sources import sinks


def scored(spark, sf):
    return inputs.scored(spark, sf).withColumn("score", rules.sigmoid(F.col("logit")))


def scored_edges(spark, sf):
    """Every edge of the graph with a score."""
    return edges(spark, sf).join(scored(spark, sf).select("edge_idx", "logit", "score"), "edge_idx")


# --- metrics ------------------------------------------------------------------------------------


@query(
    "a3_class_distribution",
    "edges",
    """SELECT CASE y WHEN 0 THEN 'Normal' ELSE 'Attack' END AS label, count(*) AS count,
  round(100e0 * count(*) / sum(count(*)) OVER (), 6) AS percent FROM edges GROUP BY y""",
)
def _(spark, sf):
    return rounded(evaluation.class_distribution(edges(spark, sf)), ["percent"])


@query(
    "a4_positive_weight",
    "edges",
    "SELECT round(count_if(y = 0) / CAST(count_if(y = 1) AS DOUBLE), 6) AS pos_weight FROM edges WHERE mask = 'train'",
)
def _(spark, sf):
    return rounded(evaluation.positive_weight(edges(spark, sf)), ["pos_weight"])


@query(
    "a5_confusion",
    "scored",
    """SELECT count_if(y = 0 AND score < 0.5) AS tn, count_if(y = 0 AND score >= 0.5) AS fp,
  count_if(y = 1 AND score < 0.5) AS fn, count_if(y = 1 AND score >= 0.5) AS tp FROM scored""",
)
def _(spark, sf):
    return evaluation.confusion(scored(spark, sf))


_PRF = """CASE WHEN tp + fp = 0 THEN 0 ELSE tp / CAST(tp + fp AS DOUBLE) END AS precision,
  CASE WHEN tp + fn = 0 THEN 0 ELSE tp / CAST(tp + fn AS DOUBLE) END AS recall,
  CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) END AS f1"""


@query(
    "a6_precision_recall_f1",
    "scored",
    f"""SELECT round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM (SELECT {_PRF} FROM (
  SELECT count_if(y = 0 AND score >= 0.5) AS fp, count_if(y = 1 AND score < 0.5) AS fn,
    count_if(y = 1 AND score >= 0.5) AS tp FROM scored))""",
)
def _(spark, sf):
    return rounded(evaluation.precision_recall_f1(scored(spark, sf)), ["precision", "recall", "f1"])


_SWEEP = f"""SELECT threshold, round(recall, 6) AS recall, round(precision, 6) AS precision, round(f1, 6) AS f1,
  round(fp_rate, 6) AS fp_rate FROM (
  SELECT threshold, {_PRF}, fp / CAST(n AS DOUBLE) AS fp_rate FROM (
    SELECT threshold, count_if(y = 0 AND score >= threshold) AS fp, count_if(y = 1 AND score < threshold) AS fn,
      count_if(y = 1 AND score >= threshold) AS tp, count_if(y = 0) AS n
    FROM scored, (VALUES (0.7e0), (0.6e0), (0.5e0), (0.4e0), (0.3e0)) t(threshold) GROUP BY threshold))"""


@query("a7_threshold_sweep", "scored", _SWEEP)
def _(spark, sf):
    sweep = evaluation.threshold_sweep(scored(spark, sf))
    return rounded(sweep, ["recall", "precision", "f1", "fp_rate"])


@query("a8_best_threshold", "scored", f"SELECT threshold, f1 FROM ({_SWEEP}) ORDER BY f1 DESC, threshold DESC LIMIT 1")
def _(spark, sf):
    return rounded(evaluation.best_threshold(evaluation.threshold_sweep(scored(spark, sf))), ["f1"])


@query(
    "a9_classification_report",
    "scored",
    """, per AS (SELECT c AS class, count_if(y = c) AS support,
    count_if(y = c AND hit = c) / CAST(count_if(hit = c) AS DOUBLE) AS p,
    count_if(y = c AND hit = c) / CAST(count_if(y = c) AS DOUBLE) AS r,
    count_if(y = hit) / CAST(count(*) AS DOUBLE) AS acc
  FROM (SELECT y, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS hit FROM scored), (VALUES (0), (1)) k(c) GROUP BY c),
f AS (SELECT *, 2 * p * r / (p + r) AS f1 FROM per)
SELECT CASE class WHEN 0 THEN 'Normal' ELSE 'Attack' END AS row, round(p, 6) AS precision, round(r, 6) AS recall,
  round(f1, 6) AS f1, support FROM f
UNION ALL SELECT 'accuracy', round(any_value(acc), 6), round(any_value(acc), 6), round(any_value(acc), 6),
  CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
  round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f""",
)
def _(spark, sf):
    return rounded(evaluation.classification_report(scored(spark, sf)), ["precision", "recall", "f1"])


def ladder(spark, sf):
    return evaluation.score_ladder(scored(spark, sf))


_LADDER = """, g AS (SELECT score, count_if(y = 1) AS p, count_if(y = 0) AS n FROM scored GROUP BY score),
ladder AS (SELECT *, CAST(sum(p) OVER (ORDER BY score DESC) AS BIGINT) AS tp,
  CAST(sum(n) OVER (ORDER BY score DESC) AS BIGINT) AS fp FROM g)
"""


@query("w5_score_ladder", "scored", _LADDER + "SELECT round(score, 9) AS score, p, n, tp, fp FROM ladder")
def _(spark, sf):
    return rounded(ladder(spark, sf), ["score"], 9)


@query(
    "a10_roc_auc",
    "scored",
    """SELECT round((sum(CASE WHEN y = 1 THEN rnk END) - count_if(y = 1) * (count_if(y = 1) + 1) / 2e0)
  / (CAST(count_if(y = 1) AS DOUBLE) * count_if(y = 0)), 6) AS roc_auc
FROM (SELECT y, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2e0 AS rnk FROM scored)""",
)
def _(spark, sf):
    return rounded(evaluation.roc_auc(ladder(spark, sf)), ["roc_auc"])


@query(
    "a11_average_precision",
    "scored",
    _LADDER + "SELECT round(sum(p * (tp / CAST(tp + fp AS DOUBLE))) / sum(p), 6) AS average_precision FROM ladder",
)
def _(spark, sf):
    return rounded(evaluation.average_precision(ladder(spark, sf)), ["average_precision"])


@query(
    "a12_curve_points",
    "scored",
    _LADDER
    + """SELECT round(score, 9) AS threshold, round(fp / CAST(sum(n) OVER () AS DOUBLE), 6) AS fpr,
  round(tp / CAST(sum(p) OVER () AS DOUBLE), 6) AS tpr, round(tp / CAST(tp + fp AS DOUBLE), 6) AS precision,
  round(tp / CAST(sum(p) OVER () AS DOUBLE), 6) AS recall FROM ladder""",
)
def _(spark, sf):
    return rounded(
        rounded(evaluation.curve_points(ladder(spark, sf)), ["fpr", "tpr", "precision", "recall"]), ["threshold"], 9
    )


@query(
    "a21_dataset_summary",
    "edges cves",
    """SELECT count(*) AS edges, round(avg(y), 6) AS attack_rate, count_if(mask = 'train') AS train,
  count_if(mask = 'test') AS test, (SELECT count(*) FROM embeddings) AS nodes,
  (SELECT count(DISTINCT matched_mitre_id) FROM cves) AS techniques FROM edges""",
)
def _(spark, sf):
    summary = quality.dataset_summary(edges(spark, sf), inputs.nodes(spark, sf), inputs.cves(spark, sf))
    return rounded(summary, ["attack_rate"])


# --- selection ----------------------------------------------------------------------------------


@query(
    "l2_first_edges",
    "edges",
    "(SELECT edge_idx, y FROM edges WHERE y = 1 ORDER BY edge_idx LIMIT 30) UNION ALL"
    " (SELECT edge_idx, y FROM edges WHERE y = 0 ORDER BY edge_idx LIMIT 20)",
)
def _(spark, sf):
    e = edges(spark, sf).select("edge_idx", "y")
    return report.first_edges(e, 1).unionByName(report.first_edges(e, 0, 20))


@query("l3_edge_by_id", "edges", "SELECT edge_idx, src, dst, y FROM edges WHERE edge_idx = 54")
def _(spark, sf):
    return report.edge_by_id(edges(spark, sf), 54).select("edge_idx", "src", "dst", "y")


@query(
    "l3_random_edge",
    "edges",
    f"SELECT edge_idx, src, dst, y FROM edges ORDER BY md5(concat_ws('|', '{SEED}', edge_idx)), edge_idx LIMIT 1",
)
def _(spark, sf):
    return report.random_edge(edges(spark, sf)).select("edge_idx", "src", "dst", "y")


@query(
    "l4_sample_attack_edges",
    "edges",
    f"""SELECT edge_idx FROM edges WHERE y = 1 AND mask = 'test'
ORDER BY md5(concat_ws('|', '{SEED}', edge_idx)), edge_idx LIMIT 100""",
)
def _(spark, sf):
    return report.sample_attack_edges(edges(spark, sf)).select("edge_idx")


# --- rules --------------------------------------------------------------------------------------


@query(
    "x1_prediction",
    "scored",
    "SELECT edge_idx, round(score, 9) AS score, CASE WHEN score >= 0.5 THEN 'ATTACK' ELSE 'NORMAL' END AS prediction FROM scored",
)
def _(spark, sf):
    s = scored(spark, sf).select("edge_idx", "score", rules.prediction(F.col("score")).alias("prediction"))
    return rounded(s, ["score"], 9)


@query(
    "x2_threat_level",
    "scored",
    """SELECT edge_idx, CASE WHEN score >= 0.5 AND y > 0 THEN CASE WHEN score > 0.8 THEN 'HIGH' ELSE 'MEDIUM' END
  ELSE 'LOW' END AS threat_level FROM scored""",
)
def _(spark, sf):
    level = rules.threat_level(F.col("score"), rules.prediction(F.col("score")), F.col("y"))
    return scored(spark, sf).select("edge_idx", level.alias("threat_level"))


@query(
    "x3_severity_band",
    "cves",
    """SELECT cve_id, CASE WHEN severity_score >= 9 THEN 'Critical' WHEN severity_score >= 7 THEN 'High' ELSE 'Medium' END
  AS band FROM cves""",
)
def _(spark, sf):
    return inputs.cves(spark, sf).select("cve_id", rules.severity_band(F.col("severity_score")).alias("band"))


_NAMES = """CASE mitre_id WHEN 'T1041' THEN 'Exfiltration Over C2 Channel' WHEN 'T1046' THEN 'Network Service Discovery'
  WHEN 'T1190' THEN 'Exploit Public-Facing Application' WHEN 'T1071' THEN 'Application Layer Protocol'
  WHEN 'T1568' THEN 'Dynamic Resolution' WHEN 'T1110' THEN 'Brute Force' WHEN 'T1021' THEN 'Remote Services' END"""
_FULL = """CASE WHEN a2 > 8 AND a1 > 3 THEN 'T1041' WHEN a1 < -1 AND a2 < -1 THEN 'T1046' WHEN a6 > 0.4 AND a1 > -1 THEN 'T1190'
  WHEN a4 > 0.7 AND a1 > 2 AND a2 > -2 AND a2 < 5 THEN 'T1071' WHEN a7 > 0.3 THEN 'T1568'
  WHEN a1 < 0 AND a4 > 0.5 AND a2 < 0 THEN 'T1110' WHEN a4 > 0.8 AND a3 > -1 THEN 'T1021' ELSE 'T1190' END"""
_COMPACT = """CASE WHEN a2 > 8 AND a1 > 3 THEN 'T1041' WHEN a1 < -1 AND a2 < -1 THEN 'T1046' WHEN a6 > 0.4 AND a1 > -1 THEN 'T1190'
  WHEN a4 > 0.7 AND a1 > 2 THEN 'T1071' WHEN a7 > 0.3 THEN 'T1568' WHEN a1 < 0 AND a4 > 0.5 THEN 'T1110'
  WHEN a4 > 0.8 THEN 'T1021' ELSE 'T1190' END"""


def _technique(spark, sf, variant):
    t = rules.assign_technique(F.col("attr"), variant)
    return edges(spark, sf).select("edge_idx", t["id"].alias("mitre_id"), t["name"].alias("mitre_name"))


@query(
    "x4_technique_rules",
    "edges",
    f"SELECT edge_idx, mitre_id, {_NAMES} AS mitre_name FROM (SELECT edge_idx, {_FULL} AS mitre_id FROM edges)",
)
def _(spark, sf):
    return _technique(spark, sf, "full")


@query(
    "x5_technique_rules_compact",
    "edges",
    f"SELECT edge_idx, mitre_id, {_NAMES} AS mitre_name FROM (SELECT edge_idx, {_COMPACT} AS mitre_id FROM edges)",
)
def _(spark, sf):
    return _technique(spark, sf, "compact")


@query(
    "x6_node_ip",
    "edges",
    """SELECT edge_idx, concat('10.0.', src // 256, '.', src % 256) AS src_ip,
  concat('10.0.', dst // 256, '.', dst % 256) AS dst_ip FROM edges""",
)
def _(spark, sf):
    return edges(spark, sf).select(
        "edge_idx", rules.node_ip(F.col("src")).alias("src_ip"), rules.node_ip(F.col("dst")).alias("dst_ip")
    )


@query("x7_protocol", "edges", "SELECT edge_idx, CASE WHEN a4 > 0.5 THEN 'TCP' ELSE 'UDP' END AS protocol FROM edges")
def _(spark, sf):
    return edges(spark, sf).select("edge_idx", rules.protocol_label(F.col("attr")).alias("protocol"))


def _draw(slot):
    return f"md5(concat_ws('|', '{SEED}', '{slot}', edge_idx))"


def _chosen(phrases, n):
    options = ", ".join(f"{{'draw': {_draw(i)}, 'phrase': {p}}}" for i, p in enumerate(phrases))
    return (
        f"array_to_string(list_transform(list_slice(list_sort(list_filter([{options}], lambda o: o.phrase IS NOT NULL)),"
        f" 1, {n}), lambda o: o.phrase), ' ')"
    )


_Q1 = [
    """CASE WHEN score > 0.8 THEN 'critical security vulnerability' WHEN score > 0.6 THEN 'network attack exploitation'
  ELSE 'suspicious network activity' END""",
    """CASE WHEN a1 > 5 THEN 'persistent backdoor communication' WHEN a1 > 0 THEN 'web application vulnerability'
  ELSE 'reconnaissance scanning' END""",
    "CASE WHEN a2 > 10 THEN 'data exfiltration' WHEN a2 > 5 THEN 'command control channel' END",
]
_Q2 = [
    f"""['network intrusion detection system', 'cyber attack vulnerability exploit', 'malicious network traffic pattern',
  'security breach remote access', 'threat actor exploitation technique'][1 + ('0x' || substr({_draw('base')}, 1, 7))::BIGINT % 5]""",
    """CASE WHEN a1 > 3 THEN 'persistent backdoor trojan malware' WHEN a1 > 0 THEN 'web application server exploit'
  WHEN a1 > -2 THEN 'port scanning network reconnaissance' ELSE 'denial of service flood attack' END""",
    """CASE WHEN a2 > 8 THEN 'data exfiltration theft leakage' WHEN a2 > 3 THEN 'command control communication channel'
  WHEN a2 > 0 THEN 'lateral movement privilege escalation' ELSE 'initial access phishing' END""",
    """CASE WHEN a3 > 0.8 THEN 'TCP protocol vulnerability' WHEN a3 > 0.3 THEN 'mixed protocol attack'
  ELSE 'UDP amplification reflection' END""",
]


@query(
    "x8_query_text",
    "edges scored",
    f"SELECT edge_idx, {_chosen(_Q1, 3)} AS text FROM (SELECT e.*, score FROM edges e JOIN scored USING (edge_idx))",
)
def _(spark, sf):
    return scored_edges(spark, sf).select(
        "edge_idx", rules.query_text(F.col("edge_idx"), F.col("attr"), F.col("score")).alias("text")
    )


@query(
    "x9_query_text_2",
    "edges",
    f"SELECT edge_idx, {_chosen(_Q2, '2 + (' + chr(39) + '0x' + chr(39) + ' || substr(' + _draw('terms') + ', 1, 7))::BIGINT % 3')} AS text FROM edges",
)
def _(spark, sf):
    return edges(spark, sf).select("edge_idx", rules.query_text_2(F.col("edge_idx"), F.col("attr")).alias("text"))


@query(
    "x10_diagnostic_query",
    "edges",
    """SELECT edge_idx, 'network attack vulnerability exploitation persistent connection data exfiltration' AS text
FROM edges WHERE y = 1""",
)
def _(spark, sf):
    return edges(spark, sf).filter("y = 1").select("edge_idx", rules.diagnostic_query().alias("text"))


_PROFILE = ["duration", "orig_bytes", "resp_bytes", "tcp", "udp", "http", "dns"]


@query(
    "x11_traffic_profile",
    "edges",
    "SELECT edge_idx, "
    + ", ".join(
        f"round(least(100e0, greatest(0e0, (a{i} + 3) / 6 * 100)), 6) + 0e0 AS {n}"
        if i <= 3
        else f"round(CASE WHEN a{i} > 0 THEN a{i} * 100 ELSE 0e0 END, 6) + 0e0 AS {n}"
        for i, n in enumerate(_PROFILE, 1)
    )
    + " FROM edges",
)
def _(spark, sf):
    profile = rules.traffic_profile(F.col("attr"))
    return rounded(edges(spark, sf).select("edge_idx", *[c.alias(n) for n, c in profile.items()]), _PROFILE)


@query(
    "x12_gauge",
    "scored",
    """SELECT edge_idx, round(shown, 6) AS shown, CASE WHEN shown < 50 THEN '0-50' WHEN shown < 75 THEN '50-75' ELSE '75-100' END
  AS band FROM (SELECT edge_idx, CASE WHEN score >= 0.5 THEN score * 100 ELSE (1 - score) * 100 END AS shown FROM scored)""",
)
def _(spark, sf):
    shown = rules.shown_confidence(F.col("score"), rules.prediction(F.col("score")))
    out = scored(spark, sf).select("edge_idx", shown.alias("shown"))
    return rounded(out.withColumn("band", rules.gauge_band(F.col("shown"))), ["shown"])


@query("x13_match", "scored", "SELECT edge_idx, (score >= 0.5) = (y = 1) AS match FROM scored")
def _(spark, sf):
    match = rules.prediction(F.col("score")) == rules.label_name(F.col("y"))
    return scored(spark, sf).select("edge_idx", match.alias("match"))


_BEST = """, best AS (SELECT matched_mitre_id AS mitre_id, string_agg(cve_id, ',' ORDER BY rank) AS cve_ids, count(*) AS n FROM (
  SELECT matched_mitre_id, cve_id, row_number() OVER (PARTITION BY matched_mitre_id
    ORDER BY severity_score DESC NULLS LAST, cve_id) AS rank FROM cves WHERE matched_mitre_id IS NOT NULL)
  WHERE rank <= 5 GROUP BY 1)
"""


@query(
    "j3_related_cves",
    "edges cves",
    _BEST
    + f"""SELECT edge_idx, e.mitre_id, coalesce(cve_ids, '') AS cve_ids FROM (SELECT edge_idx, {_FULL} AS mitre_id FROM edges) e
LEFT JOIN best b ON b.mitre_id = e.mitre_id""",
)
def _(spark, sf):
    related = report.related_cves(_technique(spark, sf, "full"), inputs.cves(spark, sf))
    return related.select("edge_idx", "mitre_id", F.array_join("cve_ids", ",").alias("cve_ids"))


_ANALYSIS = (
    _BEST
    + f""", a AS (SELECT e.*, score, CASE WHEN score >= 0.5 THEN 'ATTACK' ELSE 'NORMAL' END AS prediction,
  CASE WHEN e.y = 1 THEN 'ATTACK' ELSE 'NORMAL' END AS actual_label,
  CASE WHEN score >= 0.5 THEN {_FULL} END AS mitre_id FROM edges e JOIN scored USING (edge_idx)),
record AS (SELECT edge_idx, prediction, printf('%.2f%%', score * 100) AS confidence, actual_label,
  prediction = actual_label AS match, concat('10.0.', src // 256, '.', src % 256) AS source_ip,
  concat('10.0.', dst // 256, '.', dst % 256) AS destination_ip, CASE WHEN a4 > 0.5 THEN 'TCP' ELSE 'UDP' END AS protocol,
  coalesce(a.mitre_id, 'N/A') AS mitre_technique, coalesce({_NAMES.replace('mitre_id', 'a.mitre_id')}, 'N/A') AS mitre_name,
  CAST(coalesce(n, 0) AS INTEGER) AS cves_found, coalesce(cve_ids, '') AS cve_ids
  FROM a LEFT JOIN best b ON b.mitre_id = a.mitre_id)
"""
)
_RECORD = (
    "edge_id prediction confidence actual_label match source_ip destination_ip protocol mitre_technique mitre_name "
    "cves_found cve_ids"
).split()
_RECORD_SQL = _ANALYSIS + "SELECT " + ", ".join("edge_idx AS edge_id" if c == "edge_id" else c for c in _RECORD) + " FROM record"


def analysis(spark, sf):
    return report.analyze_edges(scored_edges(spark, sf), inputs.cves(spark, sf))


@query("x14_analysis_record", "edges scored cves", _RECORD_SQL)
def _(spark, sf):
    record = report.export_records(analysis(spark, sf))
    return record.withColumn("cve_ids", F.array_join("cve_ids", ",")).select(*_RECORD)


@query("s18_export_json", "edges scored cves", _RECORD_SQL)
def _(spark, sf):
    records = report.export_records(analysis(spark, sf))
    back = spark.read.schema(records.schema).json(sinks.export(records, new_path(spark, "export"), "json"))
    return back.withColumn("cve_ids", F.array_join("cve_ids", ",")).select(*_RECORD)


@query("s18_export_csv", "edges scored cves", _RECORD_SQL)
def _(spark, sf):
    records = report.export_records(analysis(spark, sf))
    path = sinks.export(records, new_path(spark, "export"), "csv")
    flat = records.withColumn("cve_ids", F.to_json("cve_ids"))
    back = spark.read.schema(flat.schema).option("header", True).option("escape", '"').csv(path)
    ids = F.array_join(F.from_json("cve_ids", "array<string>"), ",")
    return back.withColumn("cve_ids", ids).select(*_RECORD)


# --- vectors and graph scoring ------------------------------------------------------------------


@query(
    "j2_edge_inputs",
    "edges",
    """SELECT edge_idx, CAST(len(s.embedding) + len(d.embedding) + 8 AS INTEGER) AS dim,
  round(s.embedding[1]::DOUBLE, 6) + 0e0 AS first_src, round(d.embedding[1]::DOUBLE, 6) + 0e0 AS first_dst, round(a7, 6) + 0e0 AS last_attr,
  round(list_sum(s.embedding::DOUBLE[]) + 2 * list_sum(d.embedding::DOUBLE[]), 6) + 0e0 AS total
FROM edges e JOIN embeddings s ON s.vec_id = e.src JOIN embeddings d ON d.vec_id = e.dst""",
)
def _(spark, sf):
    wide = edge_inputs(edges(spark, sf), inputs.nodes(spark, sf))

    def total(start):
        return F.aggregate(F.slice("features", start, 64), F.lit(0.0), lambda s, x: s + x)

    return rounded(
        wide.select(
            "edge_idx",
            F.size("features").alias("dim"),
            F.col("features")[0].alias("first_src"),
            F.col("features")[64].alias("first_dst"),
            F.element_at("features", -1).alias("last_attr"),
            (total(1) + 2 * total(65)).alias("total"),
        ),
        ["first_src", "first_dst", "last_attr", "total"],
    )


@query(
    "w6_edge_softmax",
    "edges",
    """SELECT edge_idx, round(exp(a1 - m) / sum(exp(a1 - m)) OVER (PARTITION BY dst), 6) AS alpha
FROM (SELECT *, max(a1) OVER (PARTITION BY dst) AS m FROM edges)""",
)
def _(spark, sf):
    e = edges(spark, sf).withColumn("logit", F.col("attr")[1])
    return rounded(attention.edge_softmax(e).select("edge_idx", "alpha"), ["alpha"])


def _grid(rows, cols, a, b, m, shift, scale):
    """Fixed example weights ((a*i + b*j) % m - shift) / scale; the same rule is written in the SQL."""
    i, j = np.arange(rows)[:, None], np.arange(cols)[None, :]
    return ((a * i + b * j) % m - shift) / scale


def _layer(heads=1, units=8, inputs_=64, edge_dim=8):
    return attention.AttentionWeights(
        project=_grid(inputs_, heads * units, 31, 17, 23, 11, 50.0),
        att_src=_grid(heads, units, 3, 7, 5, 2, 10.0),
        att_dst=_grid(heads, units, 5, 3, 7, 3, 10.0),
        project_edge=_grid(edge_dim, heads * units, 13, 5, 17, 8, 60.0),
        att_edge=_grid(heads, units, 2, 11, 9, 4, 10.0),
        bias=_grid(1, heads * units, 0, 3, 4, 1, 20.0)[0],
    )


_ATTENTION = """, z AS (SELECT vec_id AS node_id, list_transform(range(0, 8), lambda j: list_sum(list_transform(range(0, 64),
    lambda i: embedding[i + 1]::DOUBLE * (((31 * i + 17 * j) % 23) - 11) / 50e0))) AS z FROM embeddings),
n AS (SELECT node_id, z, list_sum(list_transform(range(0, 8), lambda j: z[j + 1] * ((7 * j) % 5 - 2) / 10e0)) AS s,
  list_sum(list_transform(range(0, 8), lambda j: z[j + 1] * ((3 * j) % 7 - 3) / 10e0)) AS t FROM z),
e AS (SELECT edge_idx, src, dst, list_sum(list_transform(range(0, 8), lambda j: ((11 * j) % 9 - 4) / 10e0 *
    list_sum(list_transform(range(0, 8), lambda i: [a0, a1, a2, a3, a4, a5, a6, a7][i + 1] * ((13 * i + 5 * j) % 17 - 8) / 60e0)))) AS u
  FROM edges),
l AS (SELECT e.dst, a.z, CASE WHEN a.s + b.t + u > 0 THEN a.s + b.t + u ELSE 0.2e0 * (a.s + b.t + u) END AS logit
  FROM e JOIN n a ON a.node_id = src JOIN n b ON b.node_id = dst),
w AS (SELECT dst, z, exp(logit - max(logit) OVER (PARTITION BY dst)) AS w FROM l)
SELECT v.vec_id AS node_id, """ + ", ".join(
    f"round(coalesce(sum(w * z[{j + 1}]) / sum(w), 0) + ((3 * {j}) % 4 - 1) / 20e0, 6) + 0e0 AS x{j}" for j in range(8)
) + " FROM embeddings v LEFT JOIN w ON w.dst = v.vec_id GROUP BY 1"


@query("m1_attention_layer", "edges", _ATTENTION)
def _(spark, sf):
    out = attention.attention_layer(edges(spark, sf), inputs.nodes(spark, sf), _layer(), self_loops=False)
    return spread(out, "x", 8, prefix="x")


def _layer_sql(at: int, heads: int, units: int, width: int) -> str:
    """One layer of the network over the nodes ``x{at}(node_id, x)`` and the edges with loops ``le``; gives ``x{at + 1}``."""
    own = f"list_sum(list_transform(range(0, {units}), lambda c: z[h * {units} + c + 1] *"
    return f""", z{at} AS (SELECT node_id, list_transform(range(0, {heads * units}), lambda j: list_sum(list_transform(range(0, {width}),
    lambda i: x[i + 1] * (((31 * i + 17 * j) % 23) - 11) / 50e0))) AS z FROM x{at}),
n{at} AS (SELECT node_id, z, list_transform(range(0, {heads}), lambda h: {own} ((3 * h + 7 * c) % 5 - 2) / 10e0))) AS s,
  list_transform(range(0, {heads}), lambda h: {own} ((5 * h + 3 * c) % 7 - 3) / 10e0))) AS t FROM z{at}),
h{at} AS (SELECT src, dst, attr, unnest(range(0, {heads})) AS h FROM le),
r{at} AS (SELECT dst, h, a.z[h * {units} + 1 : h * {units} + {units}] AS z, a.s[h + 1] + b.t[h + 1] +
  list_sum(list_transform(range(0, {units}), lambda c: ((2 * h + 11 * c) % 9 - 4) / 10e0 * list_sum(list_transform(range(0, 8),
    lambda i: attr[i + 1] * ((13 * i + 5 * (h * {units} + c)) % 17 - 8) / 60e0)))) AS u
  FROM h{at} JOIN n{at} a ON a.node_id = src JOIN n{at} b ON b.node_id = dst),
l{at} AS (SELECT dst, h, z, CASE WHEN u > 0 THEN u ELSE 0.2e0 * u END AS u FROM r{at}),
w{at} AS (SELECT dst, h, z, exp(u - max(u) OVER (PARTITION BY dst, h)) AS w FROM l{at}),
c{at} AS (SELECT dst, h * {units} + c AS j, sum(w * v) / sum(w) AS v FROM
  (SELECT dst, h, w, unnest(range(0, {units})) AS c, unnest(z) AS v FROM w{at}) GROUP BY dst, h, c),
b{at} AS (SELECT dst, j, (v + ((3 * j) % 4 - 1) / 20e0) / sqrt(1 + 1e-5) AS v FROM c{at}),
x{at + 1} AS (SELECT dst AS node_id, list(CASE WHEN v > 0 THEN v ELSE exp(v) - 1 END ORDER BY j) AS x FROM b{at} GROUP BY dst)"""


_NETWORK = (
    """, others AS (SELECT src, dst, [a0, a1, a2, a3, a4, a5, a6, a7] AS attr FROM edges WHERE src <> dst),
le AS (SELECT * FROM others UNION ALL SELECT vec_id, vec_id, ["""
    + ", ".join(f"coalesce(avg(attr[{i + 1}]), 0)" for i in range(8))
    + """] FROM embeddings LEFT JOIN others ON dst = vec_id GROUP BY vec_id),
x0 AS (SELECT vec_id AS node_id, embedding::DOUBLE[] AS x FROM embeddings)"""
    + _layer_sql(0, 4, 4, 64) + _layer_sql(1, 4, 4, 16) + _layer_sql(2, 1, 8, 16)
    + """ SELECT edge_idx, round(0.1e0 + list_sum(list_transform(range(0, 8), lambda j: greatest(0, list_sum(list_transform(range(0, 24),
  lambda i: f[i + 1] * (((31 * i + 17 * j) % 23) - 11) / 50e0))) * ((7 * j) % 5 - 2) / 10e0)), 6) + 0e0 AS logit
FROM (SELECT edge_idx, list_concat(list_concat(s.x, d.x), [a0, a1, a2, a3, a4, a5, a6, a7]) AS f
  FROM edges JOIN x3 s ON s.node_id = src JOIN x3 d ON d.node_id = dst)"""
)


@query("m1_score_graph", "edges", _NETWORK)
def _(spark, sf):
    """Three layers with several heads, self loops, norms and the edge scorer."""

    def norm(n):
        return {"mean": np.zeros(n), "var": np.ones(n), "weight": np.ones(n), "bias": np.zeros(n)}

    layers = [
        {"attention": _layer(4, 4, 64), "norm": norm(16)},
        {"attention": _layer(4, 4, 16), "norm": norm(16)},
        {"attention": _layer(1, 8, 16), "norm": norm(8), "concat": False},
    ]
    classifier = {"w1": _grid(24, 8, 31, 17, 23, 11, 50.0), "b1": np.zeros(8), "w2": _grid(8, 1, 7, 1, 5, 2, 10.0), "b2": [0.1]}
    out = attention.score_graph(edges(spark, sf), inputs.nodes(spark, sf), layers, classifier)
    return rounded(out.select("edge_idx", "logit"), ["logit"])


_NORM = "(((i * 7) % 11) - 5) / 40e0, 0.5e0 + ((i * 3) % 5) / 10e0, 1e0 + ((i * 5) % 7) / 10e0, (((i * 2) % 9) - 4) / 20e0".split(", ")


@query(
    "m2_batch_norm",
    "",
    "SELECT vec_id AS node_id, "
    + ", ".join(f"round(v[{i + 1}], 6) + 0e0 AS x{i}" for i in range(64))
    + f""" FROM (SELECT vec_id, list_transform(range(0, 64), lambda i:
  (embedding[i + 1]::DOUBLE - {_NORM[0]}) / sqrt({_NORM[1]} + 1e-5) * ({_NORM[2]}) + {_NORM[3]}) AS v FROM embeddings)""",
)
def _(spark, sf):
    i = np.arange(64)

    def constant(values):
        return F.array(*[F.lit(float(v)) for v in values])

    normed = vector.batch_norm(
        F.col("x"),
        constant(((i * 7) % 11 - 5) / 40),
        constant(0.5 + ((i * 3) % 5) / 10),
        constant(1 + ((i * 5) % 7) / 10),
        constant(((i * 2) % 9 - 4) / 20),
    )
    return spread(inputs.nodes(spark, sf).select("node_id", normed.alias("x")), "x", 64, prefix="x")


@query(
    "m3_activations",
    "",
    """SELECT vec_id AS node_id, round(list_sum(list_transform(v, lambda x: greatest(x, 0))), 6) + 0e0 AS relu_sum,
  round(list_sum(list_transform(v, lambda x: CASE WHEN x > 0 THEN x ELSE exp(x) - 1 END)), 6) + 0e0 AS elu_sum
FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings)""",
)
def _(spark, sf):
    def total(a):
        return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)

    x = F.col("x")
    out = inputs.nodes(spark, sf).select(
        "node_id", total(vector.relu(x)).alias("relu_sum"), total(vector.elu(x)).alias("elu_sum")
    )
    return rounded(out, ["relu_sum", "elu_sum"])


@query(
    "m4_edge_scores",
    "edges",
    """SELECT edge_idx, round(0.1e0 + list_sum(list_transform(range(0, 8), lambda j: greatest(0, (j - 3) / 20e0 +
  list_sum(list_transform(range(0, 136), lambda i: f[i + 1] * (((31 * i + 17 * j) % 23) - 11) / 50e0))) * ((7 * j) % 5 - 2) / 10e0)), 6)
  + 0e0 AS logit
FROM (SELECT edge_idx, list_concat(list_concat(s.embedding::DOUBLE[], d.embedding::DOUBLE[]), [a0, a1, a2, a3, a4, a5, a6, a7]) AS f
  FROM edges e JOIN embeddings s ON s.vec_id = e.src JOIN embeddings d ON d.vec_id = e.dst)""",
)
def _(spark, sf):
    out = attention.edge_scores(
        edges(spark, sf),
        inputs.nodes(spark, sf),
        _grid(136, 8, 31, 17, 23, 11, 50.0),
        (np.arange(8) - 3) / 20,
        _grid(8, 1, 7, 1, 5, 2, 10.0),
        [0.1],
    )
    return rounded(out.select("edge_idx", "logit"), ["logit"])


@query(
    "x14_score_and_analyze",
    "edges",
    """, l AS (SELECT edge_idx, mask, y, 0.1e0 + list_sum(list_transform(range(0, 8), lambda j: greatest(0, (j - 3) / 20e0 +
    list_sum(list_transform(range(0, 136), lambda i: f[i + 1] * (((31 * i + 17 * j) % 23) - 11) / 50e0))) * ((7 * j) % 5 - 2) / 10e0)) AS logit
  FROM (SELECT e.*, list_concat(list_concat(s.embedding::DOUBLE[], d.embedding::DOUBLE[]), [a0, a1, a2, a3, a4, a5, a6, a7]) AS f
    FROM edges e JOIN embeddings s ON s.vec_id = e.src JOIN embeddings d ON d.vec_id = e.dst)),
p AS (SELECT *, 1 / (1 + exp(-logit)) AS score FROM l),
f AS (SELECT threshold, 2e0 * count_if(y = 1 AND score >= threshold) / nullif(count_if(score >= threshold) + count_if(y = 1), 0) AS f1
  FROM p, (VALUES (0.7e0), (0.6e0), (0.5e0), (0.4e0), (0.3e0)) t(threshold) WHERE mask = 'test' GROUP BY threshold),
b AS (SELECT coalesce((SELECT threshold FROM f WHERE f1 > 0 ORDER BY f1 DESC, threshold DESC LIMIT 1), 0.5e0) AS threshold)
SELECT edge_idx, round(score, 6) AS score, threshold, CASE WHEN score >= threshold THEN 'ATTACK' ELSE 'NORMAL' END AS prediction,
  (score >= threshold) = (y = 1) AS match FROM p, b""",
)
def _(spark, sf):
    """Weights from their table (the edge scorer of m4 alone), the threshold from the test edges, a record for every edge."""
    classifier = {"w1": _grid(136, 8, 31, 17, 23, 11, 50.0), "b1": (np.arange(8) - 3) / 20, "w2": _grid(8, 1, 7, 1, 5, 2, 10.0), "b2": [0.1]}
    weights = attention.network_table(spark, [], classifier)
    out = batch.score_and_analyze(edges(spark, sf), inputs.nodes(spark, sf), weights, inputs.cves(spark, sf))
    return rounded(out.select("edge_idx", "score", "threshold", "prediction", "match"), ["score"])


@query("m5_edge_classifier")
def _(spark, sf):
    e = edges(spark, sf)
    model = training.fit_edge_classifier(e)
    return training.classify_edges(model, e).select("edge_idx", "y", "mask", "score")


@query("m6_select_classifier")
def _(spark, sf):
    e = training.three_way_mask(edges(spark, sf))
    (model, _, _), _ = training.select_classifier(e, [{"reg": 1e-4}, {"reg": 1e-2}])
    return training.classify_edges(model, e).select("edge_idx", "y", "mask", "score")


# At an optimum the weighted mean of score · feature, plus the penalty, is that of label · feature, which the data alone give.
_MOMENTS = """, marked AS (SELECT *, {mask} AS m FROM edges),
t AS (SELECT *, CASE WHEN y = 1 THEN (SELECT count_if(y = 0) / CAST(count_if(y = 1) AS DOUBLE) FROM marked WHERE m = 'train') ELSE 1e0 END AS w
  FROM marked WHERE m = 'train'),
v AS (SELECT w, y, unnest(range(1, 9)) AS coordinate, unnest([a0, a1, a2, a3, a4, a5, a6, a7]) AS x FROM t),
c AS (SELECT coordinate, sum(w * x) / sum(w) AS mean, sum(w * x * x) / sum(w) AS square FROM v GROUP BY 1),
d AS (SELECT coordinate, mean, CASE WHEN square - mean * mean > 1e-12 * mean * mean THEN 1 / sqrt(square - mean * mean) ELSE 0 END AS scale FROM c),
o AS (SELECT coordinate, sum(w * y * (x - mean) * scale) / sum(w) AS moment FROM v JOIN d USING (coordinate) GROUP BY 1
  UNION ALL SELECT 0, sum(w * y) / sum(w) FROM t)
SELECT CAST(candidate AS INTEGER) AS candidate, CAST(coordinate AS INTEGER) AS coordinate, round(moment, 6) + 0e0 AS moment
FROM o, (SELECT unnest(range(0, {candidates})) AS candidate)"""


def _moments(models, e):
    """(candidate, coordinate, moment) of the scores of the training rows, features standardised as for training."""
    train = materialize(e.where(F.col("mask") == "train").select("y", "attr"))
    n = train.agg(F.count_if(F.col("y") == 0).alias("n0"), F.count_if(F.col("y") == 1).alias("n1")).first()
    weight = F.when(F.col("y") == 1, n["n0"] / n["n1"]).otherwise(1.0)
    width = len(models[0].coefficients)
    means = train.agg(*[(F.sum(weight * F.col("attr")[j]) / F.sum(weight)).alias(f"m{j}") for j in range(width)]).first()
    out = []
    for i, model in enumerate(models):
        p = weight * rules.sigmoid(model.logit(F.col("attr")))
        scale = [b / s if s else 0.0 for b, s in zip(model.coefficients, model.optimum[1:])]
        sums = train.agg(
            (F.sum(p) / F.sum(weight)).alias("a0"),
            *[(F.sum(p * (F.col("attr")[j] - means[j]) * float(scale[j])) / F.sum(weight) + float(model.reg * model.optimum[j + 1])).alias(f"a{j + 1}") for j in range(width)],
        )
        pairs = [F.struct(F.lit(i).alias("candidate"), F.lit(j).alias("coordinate"), F.col(f"a{j}").alias("moment")) for j in range(width + 1)]
        out.append(sums.select(F.inline(F.array(*pairs))))
    return rounded(reduce(DataFrame.unionByName, out), ["moment"])


@query("m5_optimality", "edges", _MOMENTS.format(mask="mask", candidates=1))
def _(spark, sf):
    e = edges(spark, sf)
    return _moments([training.fit_edge_classifier(e)], e)


@query("m6_optimality", "edges", _MOMENTS.format(mask="CASE WHEN edge_idx % 10 < 2 THEN 'test' WHEN edge_idx % 10 = 2 THEN 'val' ELSE 'train' END", candidates=3))
def _(spark, sf):
    """Three candidates fitted together."""
    turn = F.pmod("edge_idx", F.lit(10))
    e = edges(spark, sf).withColumn("mask", F.when(turn < 2, "test").when(turn == 2, "val").otherwise("train"))
    return _moments(training.fit_edge_classifiers(e, [{"reg": 1e-4}, {"reg": 1e-2}, {"reg": 1.0}]), e)
