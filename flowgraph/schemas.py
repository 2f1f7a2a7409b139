"""Schemas and fixed values of the flow, knowledge-base and vector tables."""

from pyspark.sql import types as T

# --- fixed values: the 28 raw columns, in load order --------------------------------------
NETWORK_LOG_COLUMNS = [
    "resp_pkts", "service", "orig_ip_bytes", "local_resp", "missed_bytes", "proto", "duration",
    "conn_state", "dest_ip_zeek", "orig_pkts", "community_id", "resp_ip_bytes", "dest_port_zeek",
    "orig_bytes", "local_orig", "datetime", "history", "resp_bytes", "uid", "src_port_zeek", "ts",
    "src_ip_zeek", "label_tactic", "source_period", "label_technique", "label_cve",
    "label_binary", "vlan",
]

# --- fixed values: column groups of the raw table -----------------------------------------
FLAG_COLUMNS = ["local_resp", "local_orig"]
COUNTER_COLUMNS = [
    "resp_pkts", "orig_ip_bytes", "missed_bytes", "orig_pkts", "resp_ip_bytes", "orig_bytes", "resp_bytes",
]
PORT_COLUMNS = ["dest_port_zeek", "src_port_zeek"]
REAL_COLUMNS = ["duration", "ts"]
TIME_COLUMN = "datetime"
TEXT_COLUMNS = [
    "service", "proto", "conn_state", "dest_ip_zeek", "community_id", "history", "uid", "src_ip_zeek",
    "label_tactic", "source_period", "label_technique", "label_cve", "label_binary", "vlan",
]
# Columns that older period files lack; they are filled with the text "unknown".
LATE_COLUMNS = ["label_technique", "label_cve", "label_binary", "vlan"]
REQUIRED_COLUMNS = ["src_ip_zeek", "dest_ip_zeek", "proto", "label_tactic", "label_binary", "source_period"]
SORT_KEYS = ["src_ip_zeek", "dest_ip_zeek", "datetime"]

# Schema every period file is cast to before the files are united.
CANONICAL = T.StructType(
    [
        T.StructField("community_id", T.StringType()),
        T.StructField("conn_state", T.StringType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("history", T.StringType()),
        T.StructField("src_ip_zeek", T.StringType()),
        T.StructField("src_port_zeek", T.LongType()),
        T.StructField("dest_ip_zeek", T.StringType()),
        T.StructField("dest_port_zeek", T.LongType()),
        T.StructField("local_orig", T.BooleanType()),
        T.StructField("local_resp", T.BooleanType()),
        T.StructField("missed_bytes", T.LongType()),
        T.StructField("orig_bytes", T.DoubleType()),
        T.StructField("orig_ip_bytes", T.LongType()),
        T.StructField("orig_pkts", T.LongType()),
        T.StructField("proto", T.StringType()),
        T.StructField("resp_bytes", T.DoubleType()),
        T.StructField("resp_ip_bytes", T.LongType()),
        T.StructField("resp_pkts", T.LongType()),
        T.StructField("service", T.StringType()),
        T.StructField("ts", T.DoubleType()),
        T.StructField("uid", T.StringType()),
        T.StructField("datetime", T.TimestampNTZType()),
        T.StructField("vlan", T.StringType()),
        T.StructField("label_tactic", T.StringType()),
        T.StructField("label_technique", T.StringType()),
        T.StructField("label_binary", T.StringType()),
        T.StructField("label_cve", T.StringType()),
        T.StructField("source_period", T.StringType()),
    ]
)

CVE = T.StructType(
    [
        T.StructField("cve_id", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("matched_mitre_id", T.StringType()),
        T.StructField("severity_score", T.DoubleType()),
        T.StructField("year", T.IntegerType()),
    ]
)

# The parts of an ATT&CK bundle that are read; everything else is pruned by the parser.
BUNDLE = T.StructType(
    [
        T.StructField(
            "objects",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("type", T.StringType()),
                        T.StructField("x_mitre_deprecated", T.BooleanType()),
                        T.StructField("name", T.StringType()),
                        T.StructField("description", T.StringType()),
                        T.StructField(
                            "external_references",
                            T.ArrayType(
                                T.StructType(
                                    [
                                        T.StructField("source_name", T.StringType()),
                                        T.StructField("external_id", T.StringType()),
                                    ]
                                )
                            ),
                        ),
                    ]
                )
            ),
        )
    ]
)

# --- fixed values: categories of the one-hot columns --------------------------------------
PROTOCOLS = ["tcp", "udp", "icmp"]
SERVICES = ["http", "dns", "ssl", "ssh", "unknown"]

# --- fixed values: defaults of retrieval and evaluation -----------------------------------
SIMILARITY_THRESHOLD = 0.65
TOP_K_CVES = 10
TOP_K_TECHNIQUES = 5
TOP_K_CONTEXT = 5
MIN_CVE_SEVERITY = 7.0
SWEEP_THRESHOLDS = [0.7, 0.6, 0.5, 0.4, 0.3]
DECISION_THRESHOLD = 0.5
SHARDS = 5
FILE_CAP = 5
SEED = 42
