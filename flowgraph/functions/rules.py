"""Rules on a scored edge, as column expressions: labels, techniques, query texts, display numbers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowgraph.schemas import DECISION_THRESHOLD, SEED

# --- fixed values: positions in the edge vector -------------------------------------------
DURATION, ORIG_BYTES, RESP_BYTES, TCP, UDP, HTTP, DNS = 1, 2, 3, 4, 5, 6, 7

# --- fixed values: techniques (id, name, description) and the open interval each measure
# --- must lie in; the first rule that fits decides ----------------------------------------
TECHNIQUE_RULES = [
    ("T1041", "Exfiltration Over C2 Channel", "High outbound data transfer via command and control",
     {ORIG_BYTES: (8, None), DURATION: (3, None)}),
    ("T1046", "Network Service Discovery", "Reconnaissance through port scanning",
     {DURATION: (None, -1), ORIG_BYTES: (None, -1)}),
    ("T1190", "Exploit Public-Facing Application", "Web server exploitation attempt",
     {HTTP: (0.4, None), DURATION: (-1, None)}),
    ("T1071", "Application Layer Protocol", "Command and control communication",
     {TCP: (0.7, None), DURATION: (2, None), ORIG_BYTES: (-2, 5)}),
    ("T1568", "Dynamic Resolution", "DNS-based command and control",
     {DNS: (0.3, None)}),
    ("T1110", "Brute Force", "Credential guessing attack",
     {DURATION: (None, 0), TCP: (0.5, None), ORIG_BYTES: (None, 0)}),
    ("T1021", "Remote Services", "Remote access exploitation",
     {TCP: (0.8, None), RESP_BYTES: (-1, None)}),
]
DEFAULT_TECHNIQUE = ("T1190", "Exploit Public-Facing Application", "Web exploitation attempt")
# The compact variant does not look at bytes in these rules.
COMPACT_IGNORES = {"T1071": {ORIG_BYTES}, "T1110": {ORIG_BYTES}, "T1021": {RESP_BYTES}}
TECHNIQUE_IDS = sorted({rule[0] for rule in TECHNIQUE_RULES} | {DEFAULT_TECHNIQUE[0]})

# --- fixed values: phrases of the first query builder; (lower bound, phrase), then the rest
SCORE_PHRASES = ([(0.8, "critical security vulnerability"), (0.6, "network attack exploitation")],
                 "suspicious network activity")
DURATION_PHRASES = ([(5, "persistent backdoor communication"), (0, "web application vulnerability")],
                    "reconnaissance scanning")
BYTES_PHRASES = ([(10, "data exfiltration"), (5, "command control channel")], None)

# --- fixed values: phrases of the second query builder ------------------------------------
BASE_PHRASES = [
    "network intrusion detection system",
    "cyber attack vulnerability exploit",
    "malicious network traffic pattern",
    "security breach remote access",
    "threat actor exploitation technique",
]
DURATION_PHRASES_2 = ([(3, "persistent backdoor trojan malware"), (0, "web application server exploit"),
                       (-2, "port scanning network reconnaissance")], "denial of service flood attack")
BYTES_PHRASES_2 = ([(8, "data exfiltration theft leakage"), (3, "command control communication channel"),
                    (0, "lateral movement privilege escalation")], "initial access phishing")
PROTOCOL_PHRASES_2 = ([(0.8, "TCP protocol vulnerability"), (0.3, "mixed protocol attack")],
                      "UDP amplification reflection")

# --- fixed values: the diagnostic query ---------------------------------------------------
DIAGNOSTIC_PHRASES = ["network attack vulnerability exploitation", "persistent connection", "data exfiltration"]


def sigmoid(logit: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-logit))


def is_hit(score: Column, threshold: float | Column = DECISION_THRESHOLD) -> Column:
    """A score that is no number is no hit."""
    return (score >= threshold) & ~F.isnan(score)


def prediction(score: Column, threshold: float | Column = DECISION_THRESHOLD) -> Column:
    return F.when(is_hit(score, threshold), F.lit("ATTACK")).otherwise(F.lit("NORMAL"))


def label_name(y: Column) -> Column:
    return F.when(y == 1, F.lit("ATTACK")).otherwise(F.lit("NORMAL"))


def threat_level(score: Column, predicted: Column, n_hits: Column) -> Column:
    """An attack without any retrieved record is LOW, like normal traffic."""
    supported = (predicted == "ATTACK") & (F.coalesce(n_hits, F.lit(0)) > 0)
    return F.when(supported & (score > 0.8), "HIGH").when(supported, "MEDIUM").otherwise("LOW")


def severity_band(severity: Column) -> Column:
    return F.when(severity >= 9, "Critical").when(severity >= 7, "High").otherwise("Medium")


def _inside(value: Column, low, high) -> Column:
    tests = ([value > low] if low is not None else []) + ([value < high] if high is not None else [])
    return reduce(lambda a, b: a & b, tests)


def assign_technique(attr: Column, variant: str = "full") -> Column:
    """Struct(id, name, description) of the first rule an edge vector fits.

    ``variant="compact"`` is the shorter rule set; it carries no descriptions.
    """
    if variant not in ("full", "compact"):
        raise ValueError(f"unknown rule variant: {variant}")

    def result(technique, name, description):
        fields = [F.lit(technique).alias("id"), F.lit(name).alias("name")]
        return F.struct(*fields, F.lit(description if variant == "full" else None).cast("string").alias("description"))

    chain = F
    for technique, name, description, bounds in TECHNIQUE_RULES:
        ignored = COMPACT_IGNORES.get(technique, set()) if variant == "compact" else set()
        tests = [_inside(attr[i], *limits) for i, limits in bounds.items() if i not in ignored]
        chain = chain.when(reduce(lambda a, b: a & b, tests), result(technique, name, description))
    return chain.otherwise(result(*DEFAULT_TECHNIQUE))


def node_ip(node_id: Column) -> Column:
    """Display address of a node id."""
    return F.format_string("10.0.%d.%d", F.floor(node_id / 256), node_id % 256)


def protocol_label(attr: Column) -> Column:
    return F.when(attr[TCP] > 0.5, "TCP").otherwise("UDP")


def band(value: Column, phrases) -> Column:
    """The phrase of the first lower bound that ``value`` exceeds, else the closing phrase."""
    steps, rest = phrases
    chain = F
    for low, phrase in steps:
        chain = chain.when(value > low, F.lit(phrase))
    return chain.otherwise(F.lit(rest).cast("string"))


def _draw(key: Column, slot, seed: int) -> Column:
    """A reproducible random text for (seed, slot, key): the same in every run and every engine."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(str(slot)), key.cast("string")))


def _draw_int(key: Column, slot, seed: int, n: Column | int) -> Column:
    """A reproducible whole number in [0, n), from the first seven hex digits of the draw."""
    value = F.conv(F.substring(_draw(key, slot, seed), 1, 7), 16, 10).cast("long")
    return F.pmod(value, n if isinstance(n, Column) else F.lit(n)).cast("int")


def choose(phrases: list[Column], key: Column, n: Column | int, seed: int) -> Column:
    """``n`` of the non-null phrases in drawn order, joined by blanks."""
    options = F.filter(
        F.array(
            *[F.struct(_draw(key, slot, seed).alias("draw"), p.alias("phrase")) for slot, p in enumerate(phrases)]
        ),
        lambda o: o["phrase"].isNotNull(),
    )
    return F.array_join(F.transform(F.slice(F.array_sort(options), 1, n), lambda o: o["phrase"]), " ")


def query_phrases(attr: Column, score: Column) -> list[Column]:
    return [
        band(score, SCORE_PHRASES),
        band(attr[DURATION], DURATION_PHRASES),
        band(attr[ORIG_BYTES], BYTES_PHRASES),
    ]


def query_text(key: Column, attr: Column, score: Column, seed: int = SEED) -> Column:
    """First query builder: up to three phrases on score, duration and bytes."""
    return choose(query_phrases(attr, score), key, 3, seed)


def query_phrases_2(key: Column, attr: Column, seed: int = SEED) -> list[Column]:
    base = F.element_at(F.array(*[F.lit(p) for p in BASE_PHRASES]), _draw_int(key, "base", seed, len(BASE_PHRASES)) + 1)
    return [
        base,
        band(attr[DURATION], DURATION_PHRASES_2),
        band(attr[ORIG_BYTES], BYTES_PHRASES_2),
        band(attr[RESP_BYTES], PROTOCOL_PHRASES_2),
    ]


def query_text_2(key: Column, attr: Column, seed: int = SEED) -> Column:
    """Second query builder: two to four of base, duration, bytes and protocol phrases."""
    return choose(query_phrases_2(key, attr, seed), key, _draw_int(key, "terms", seed, 3) + 2, seed)


def diagnostic_query() -> Column:
    return F.concat_ws(" ", *[F.lit(p) for p in DIAGNOSTIC_PHRASES])


def traffic_profile(attr: Column) -> dict[str, Column]:
    """Seven display values on a 0-100 scale."""

    def spread(i):
        return F.least(F.lit(100.0), F.greatest(F.lit(0.0), (attr[i] + 3) / 6 * 100))

    def share(i):
        return F.when(attr[i] > 0, attr[i] * 100).otherwise(F.lit(0.0))

    return {
        "duration": spread(DURATION),
        "orig_bytes": spread(ORIG_BYTES),
        "resp_bytes": spread(RESP_BYTES),
        "tcp": share(TCP),
        "udp": share(UDP),
        "http": share(HTTP),
        "dns": share(DNS),
    }


def shown_confidence(score: Column, predicted: Column) -> Column:
    """Confidence in the prediction that is shown, in percent."""
    return F.when(predicted == "ATTACK", score * 100).otherwise((1 - score) * 100)


def gauge_band(percent: Column) -> Column:
    return F.when(percent < 50, "0-50").when(percent < 75, "50-75").otherwise("75-100")
