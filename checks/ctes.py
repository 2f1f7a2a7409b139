"""DuckDB building blocks: the inputs and the intermediate tables, written independently as SQL."""

from __future__ import annotations

CTE: dict[str, tuple[list[str], str]] = {}


def cte(name: str, needs: str, sql: str) -> None:
    CTE[name] = (needs.split(), sql)


def with_ctes(needs: str, select: str) -> str:
    """``select`` preceded by the building blocks it needs, in dependency order."""
    done: list[str] = []

    def visit(name):
        for dep in CTE[name][0]:
            visit(dep)
        if name not in done:
            done.append(name)

    for name in needs.split():
        visit(name)
    head = ",\n".join(f"{n} AS ({CTE[n][1]})" for n in done)
    if not done:
        return select
    # A statement may go on with CTEs of its own: ", name AS (...) SELECT ...".
    return f"WITH {head}{select}" if select.startswith(",") else f"WITH {head}\n{select}"


_TACTIC = """CASE WHEN l_discount < 0.005 THEN NULL
  WHEN l_suppkey % 10 < 3 AND l_discount > 0.095 THEN 'Reconnaissance'
  WHEN l_suppkey % 10 < 3 AND l_discount > 0.085 AND l_returnflag = 'A' THEN 'Credential Access'
  ELSE 'none' END"""

cte(
    "flows",
    "",
    f"""SELECT
  CAST(l_linenumber * l_quantity AS BIGINT) AS resp_pkts,
  CASE l_linenumber WHEN 1 THEN 'http' WHEN 2 THEN 'dns' WHEN 3 THEN 'ssl' WHEN 4 THEN 'ssh'
    WHEN 5 THEN 'unknown' WHEN 6 THEN 'ftp' END AS service,
  CAST(floor(l_extendedprice) AS BIGINT) + 40 * CAST(l_quantity AS BIGINT) AS orig_ip_bytes,
  l_linestatus = 'O' AS local_resp,
  CAST(0 AS BIGINT) AS missed_bytes,
  CASE l_returnflag WHEN 'A' THEN 'tcp' WHEN 'N' THEN 'udp' WHEN 'R' THEN 'icmp' END AS proto,
  NULLIF(l_tax, 0) * 100 AS duration,
  CASE WHEN l_linestatus = 'F' THEN 'SF' ELSE 'S0' END AS conn_state,
  concat('10.0.0.', l_partkey % 40) AS dest_ip_zeek,
  CAST(l_quantity AS BIGINT) AS orig_pkts,
  concat('1:', l_partkey) AS community_id,
  coalesce(CAST(floor(NULLIF(l_extendedprice * l_discount, 0)) AS BIGINT), 0)
    + 40 * CAST(l_linenumber * l_quantity AS BIGINT) AS resp_ip_bytes,
  CASE l_linenumber WHEN 1 THEN 80 WHEN 2 THEN 53 WHEN 3 THEN 443 WHEN 4 THEN 22 ELSE 0 END AS dest_port_zeek,
  CAST(floor(l_extendedprice) AS BIGINT) AS orig_bytes,
  l_linestatus = 'F' AS local_orig,
  l_shipdate AS datetime,
  CASE WHEN l_linestatus = 'F' THEN 'ShADadFf' END AS history,
  CAST(floor(NULLIF(l_extendedprice * l_discount, 0)) AS BIGINT) AS resp_bytes,
  concat('C', l_orderkey, '-', l_linenumber) AS uid,
  CAST(1024 + l_orderkey % 60000 AS INTEGER) AS src_port_zeek,
  date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) * CAST(86400.0 AS DOUBLE) AS ts,
  concat('10.0.', CAST((l_suppkey - l_suppkey % 256) / 256 AS INTEGER), '.', l_suppkey % 256) AS src_ip_zeek,
  {_TACTIC} AS label_tactic,
  concat('p', year(l_shipdate)) AS source_period,
  CASE {_TACTIC} WHEN 'Reconnaissance' THEN 'T1595' WHEN 'Credential Access' THEN 'T1110' ELSE 'none' END
    AS label_technique,
  'unknown' AS label_cve,
  CASE WHEN l_orderkey % 20 = 0 THEN 'Duplicate' WHEN l_orderkey % 20 = 1 THEN NULL ELSE 'False' END AS label_binary,
  CASE l_orderkey % 8 WHEN 0 THEN 'unknown' WHEN 1 THEN 'NaN' WHEN 3 THEN '1.0' WHEN 4 THEN '2.5'
    WHEN 5 THEN '3.5' WHEN 6 THEN 'abc' WHEN 7 THEN '' END AS vlan
FROM lineitem""",
)

cte(
    "stg",
    "flows",
    """SELECT uid, src_ip_zeek, dest_ip_zeek, src_port_zeek, dest_port_zeek, proto, service,
  coalesce(duration, 0) AS duration, coalesce(orig_bytes, 0) AS orig_bytes, coalesce(resp_bytes, 0) AS resp_bytes,
  orig_pkts, resp_pkts, orig_ip_bytes, resp_ip_bytes, missed_bytes, conn_state,
  coalesce(history, '-') AS history,
  CASE WHEN vlan IS NULL OR vlan IN ('unknown', 'NaN') THEN 'none'
    ELSE CAST(CAST(round_even(coalesce(TRY_CAST(vlan AS FLOAT), 0), 0) AS INTEGER) AS VARCHAR) END AS vlan,
  label_tactic, label_technique, source_period, datetime, ts,
  CASE WHEN label_tactic <> 'none' AND label_tactic IS NOT NULL THEN 'Attack' ELSE 'Normal' END AS final_target
FROM flows WHERE label_binary <> 'Duplicate'""",
)

cte(
    "clean",
    "stg",
    """SELECT src_ip_zeek, dest_ip_zeek,
  ln(1 + duration) AS log_duration, ln(1 + orig_bytes) AS log_orig_bytes, ln(1 + resp_bytes) AS log_resp_bytes,
  ln(1 + orig_pkts) AS log_orig_pkts, ln(1 + resp_pkts) AS log_resp_pkts,
  CASE WHEN proto = 'tcp' THEN 1 ELSE 0 END AS proto_tcp,
  CASE WHEN proto = 'udp' THEN 1 ELSE 0 END AS proto_udp,
  CASE WHEN proto = 'icmp' THEN 1 ELSE 0 END AS proto_icmp,
  CASE WHEN service = 'http' THEN 1 ELSE 0 END AS srv_http,
  CASE WHEN service = 'dns' THEN 1 ELSE 0 END AS srv_dns,
  CASE WHEN service = 'ssl' THEN 1 ELSE 0 END AS srv_ssl,
  CASE WHEN service = 'ssh' THEN 1 ELSE 0 END AS srv_ssh,
  CASE WHEN service = 'unknown' THEN 1 ELSE 0 END AS srv_unknown,
  CASE WHEN final_target = 'Attack' THEN 1 ELSE 0 END AS label,
  label_tactic, label_technique, final_target
FROM stg""",
)

cte(
    "ids",
    "clean",
    """SELECT ip, row_number() OVER (ORDER BY ip) - 1 AS node_id
FROM (SELECT src_ip_zeek AS ip FROM clean UNION SELECT dest_ip_zeek FROM clean) WHERE ip IS NOT NULL""",
)

cte(
    "se",
    "ids",
    """SELECT s.node_id AS source_idx, d.node_id AS target_idx, count(*) AS connection_count,
  avg(log_duration) AS mean_log_duration, stddev_samp(log_duration) AS std_log_duration,
  avg(log_orig_bytes) AS mean_log_orig_bytes, avg(log_resp_bytes) AS mean_log_resp_bytes,
  CAST(sum(proto_tcp) AS BIGINT) AS tcp_count, CAST(sum(proto_udp) AS BIGINT) AS udp_count,
  CAST(sum(proto_icmp) AS BIGINT) AS icmp_count, max(label) AS label,
  avg(proto_tcp) AS tcp, avg(proto_udp) AS udp, avg(srv_http) AS http, avg(srv_dns) AS dns
FROM clean e JOIN ids s ON e.src_ip_zeek = s.ip JOIN ids d ON e.dest_ip_zeek = d.ip
GROUP BY s.node_id, d.node_id""",
)

cte(
    "gnn",
    "se",
    """SELECT *, CASE WHEN row_number() OVER (ORDER BY source_idx, target_idx) % 5 = 0 THEN 'test' ELSE 'train' END
  AS split_mask FROM se""",
)

cte(
    "edges",
    "se",
    """SELECT row_number() OVER o - 1 AS edge_idx, source_idx AS src, target_idx AS dst,
  CAST(connection_count AS DOUBLE) AS a0,
  (mean_log_duration - avg(mean_log_duration) OVER ()) / stddev_pop(mean_log_duration) OVER () AS a1,
  (mean_log_orig_bytes - avg(mean_log_orig_bytes) OVER ()) / stddev_pop(mean_log_orig_bytes) OVER () AS a2,
  (mean_log_resp_bytes - avg(mean_log_resp_bytes) OVER ()) / stddev_pop(mean_log_resp_bytes) OVER () AS a3,
  tcp AS a4, udp AS a5, http AS a6, dns AS a7, label AS y,
  CASE WHEN row_number() OVER o % 5 = 0 THEN 'test' ELSE 'train' END AS mask
FROM se WINDOW o AS (ORDER BY source_idx, target_idx)""",
)

cte(
    "scored",
    "",
    """SELECT edge_idx, y, logit, 1 / (1 + exp(-logit)) AS score FROM (
  SELECT event_id AS edge_idx, CAST(event_type = 'error' AS INTEGER) AS y,
    (CASE WHEN event_type = 'error' THEN 250 ELSE -125 END + (event_id * 7919) % 1000 - 500) / 250e0 AS logit
  FROM events)""",
)

_MITRE = """CASE label WHEN 0 THEN 'T1041' WHEN 1 THEN 'T1046' WHEN 2 THEN 'T1190' WHEN 3 THEN 'T1071' WHEN 4 THEN 'T1568'
  WHEN 5 THEN 'T1110' WHEN 6 THEN 'T1021' WHEN 7 THEN 'T1595' WHEN 9 THEN 'T1059' END"""

cte(
    "cves",
    "",
    f"""SELECT vec_id, concat('CVE-', 2015 + vec_id % 11, '-', 1000 + vec_id) AS cve_id, text AS description,
  {_MITRE} AS matched_mitre_id,
  CASE WHEN vec_id % 17 <> 0 THEN CAST((vec_id * 37) % 101 AS DOUBLE) / 10 END AS severity_score,
  CASE WHEN vec_id % 13 <> 0 THEN CAST(2015 + vec_id % 11 AS INTEGER) END AS year,
  CAST(embedding AS DOUBLE[]) AS vec
FROM embeddings LEFT JOIN documents ON vec_id = doc_id""",
)

cte(
    "techniques",
    "",
    f"""SELECT {_MITRE} AS mitre_id, concat('technique ', label) AS name, vec FROM (
  SELECT label, CAST(arg_min(embedding, vec_id) AS DOUBLE[]) AS vec FROM embeddings GROUP BY label)
WHERE {_MITRE} IS NOT NULL""",
)

cte(
    "qvec",
    "",
    "SELECT vec_id AS query_id, CAST(list_reverse(embedding) AS DOUBLE[]) AS qv FROM embeddings",
)

# Every query vector against every CVE vector, compared at 12 decimals as in the library.
cte(
    "sims",
    "qvec cves",
    """SELECT query_id, vec_id, cve_id, matched_mitre_id, severity_score, year, description,
  round(list_cosine_similarity(qv, vec), 12) AS similarity
FROM qvec, cves""",
)

cte(
    "retrieved",
    "sims scored",
    """SELECT h.*, s.score FROM (
  SELECT query_id, cve_id, matched_mitre_id AS mitre_id, coalesce(severity_score, 0.0) AS severity,
    coalesce(year, 2026) AS year, similarity,
    row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, cve_id) AS rank
  FROM sims WHERE similarity >= 0.3) h JOIN scored s ON s.edge_idx = h.query_id
WHERE rank <= 5""",
)
