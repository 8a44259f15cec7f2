"""Facts out of texts: indicators, severities and statements per source, agreement between sources, guidance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Patterns of indicators and what is excluded.
SHA256, SHA1, MD5 = r"\b([a-fA-F0-9]{64})\b", r"\b([a-fA-F0-9]{40})\b", r"\b([a-fA-F0-9]{32})\b"
URL, IPV4 = r"(?i)\bhttps?://[^\s<>\"')\]}{]+", r"\b(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})\b"
DOMAIN = r"\b([a-zA-Z0-9](?:[a-zA-Z0-9\-]{0,61}[a-zA-Z0-9])?(?:\.[a-zA-Z0-9](?:[a-zA-Z0-9\-]{0,61}[a-zA-Z0-9])?)*\.[a-zA-Z]{2,})\b"
NO_DOMAINS = ("example.com", "example.org", "example.net", "localhost.localdomain")
# Severities, and how texts speak of patches and exploits.
SEVERITY = r"(?i)\b(critical|high|medium|moderate|low|informational)\b"
STATEMENTS = {
    "no_patch": r"(?i)\bno (available )?(patch|fix|update)\b|\bunpatched\b|\bno fix\b",
    "patch_available": r"(?i)\bpatch(ed| available| released)\b|\bfix(ed| available| released)\b|\bupdate available\b",
    "workaround": r"(?i)\bworkaround\b|\bmitigat(e|ion)\b",
    "actively_exploited": r"(?i)\bactively exploited\b|\bin the wild\b|\bknown exploit\b",
    "poc_available": r"(?i)\bproof of concept\b|\bpoc\b",
}
# Kinds of weaknesses and what to do about them, in order of precedence.
GUIDANCE = [
    ("rce", "Isolate affected systems. Block untrusted inbound connections.|Apply vendor patch when available."),
    ("remote code execution", "Isolate affected systems. Block untrusted inbound connections.|Apply vendor patch when available."),
    ("code injection", "Isolate affected systems. Block untrusted inbound connections.|Apply vendor patch when available."),
    ("deserialization", "Isolate affected systems. Block untrusted inbound connections.|Apply vendor patch when available."),
    ("sql injection", "Restrict database access to application accounts only.|Enable query logging.|Apply vendor patch."),
    ("sqli", "Restrict database access to application accounts only.|Enable query logging.|Apply vendor patch."),
    ("cross-site scripting", "Implement input validation and output encoding.|Apply vendor patch."),
    ("xss", "Implement input validation and output encoding.|Apply vendor patch."),
    ("buffer overflow", "Isolate affected systems from untrusted input sources.|Apply vendor patch when available."),
    ("privilege escalation", "Restrict local access to trusted users only.|Review account privileges.|Apply vendor patch when available."),
    ("authentication bypass", "Restrict network access to affected service.|Enable additional authentication factors where possible.|Apply vendor patch when available."),
    ("path traversal", "Restrict file system access from application context.|Apply vendor patch when available."),
]
DEFAULT_GUIDANCE = "Review vendor advisory for mitigation guidance.|Monitor for exploitation indicators."


def valid_ipv4(ip: Column) -> Column:
    """Octets up to 255, not local, not 255.*, and not a version (all octets below 32)."""
    octets = F.transform(F.split(ip, r"\."), lambda x: x.cast("int"))
    first = F.get(octets, F.lit(0))
    return F.forall(octets, lambda x: x <= 255) & ~first.isin(0, 127, 255) & F.exists(octets, lambda x: x >= 32)


def valid_domain(d: Column) -> Column:
    return ~d.isin(*NO_DOMAINS) & d.rlike(r"\.[a-z]{2,}$") & ~d.rlike(r"^\d")


def indicators(rows: DataFrame, key: str, hay: Column) -> DataFrame:
    """Distinct ``(key, type, value)`` of CVEs, digests, addresses and domains in a text.

    A shorter digest is only taken where it stands alone: the patterns demand a boundary, so it can't be part of a longer one.
    """
    all_of = lambda p, g: F.regexp_extract_all(F.col("__t"), F.lit(p), F.lit(g))
    typed = lambda kind, values: F.transform(values, lambda v: F.struct(F.lit(kind).alias("type"), v.alias("value")))
    found = F.concat(
        typed("cve", F.transform(all_of(r"(?i)\bCVE-\d{4}-\d{4,}\b", 0), F.upper)), typed("hash_sha256", F.transform(all_of(SHA256, 1), F.lower)), typed("hash_sha1", F.transform(all_of(SHA1, 1), F.lower)),
        typed("hash_md5", F.transform(all_of(MD5, 1), F.lower)), typed("url", F.transform(all_of(URL, 0), lambda u: F.regexp_replace(u, r"[.,;:)]+$", ""))),
        typed("ip", F.filter(all_of(IPV4, 1), valid_ipv4)), typed("domain", F.filter(F.transform(all_of(DOMAIN, 1), F.lower), valid_domain)),
    )
    return rows.select(key, hay.alias("__t")).select(key, F.explode(F.array_distinct(found)).alias("i")).select(key, "i.type", "i.value").distinct()


def stix_pattern(kind: Column, value: Column) -> Column:
    """Pattern of an indicator in the notation of threat exchanges; null for kinds without one."""
    hashes = {"hash_sha256": "SHA-256", "hash_sha1": "SHA-1", "hash_md5": "MD5"}
    quoted = F.regexp_replace(value, "'", "\\\\'")
    out = F.when(kind == "ip", F.concat(F.lit("[ipv4-addr:value = '"), quoted, F.lit("']"))).when(kind == "domain", F.concat(F.lit("[domain-name:value = '"), quoted, F.lit("']")))
    out = out.when(kind == "url", F.concat(F.lit("[url:value = '"), quoted, F.lit("']")))
    for name, digest in hashes.items():
        out = out.when(kind == name, F.concat(F.lit(f"[file:hashes.'{digest}' = '"), quoted, F.lit("']")))
    return out.when(kind == "cve", F.concat(F.lit("[vulnerability:name = '"), quoted, F.lit("']")))


def source_facts(records: DataFrame) -> DataFrame:
    """Distinct ``(issue_id, source, kind, fact)`` of what each source's texts (title, summary and, if there is one, guid) say: severities, CVEs, patches, exploits."""
    parts = [c for c in ("title", "summary", "guid") if c in records.columns]
    hay = F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in parts])
    severity = F.transform(F.regexp_extract_all(F.col("t"), F.lit(SEVERITY), F.lit(1)), lambda s: F.when(F.lower(s) == "moderate", "medium").otherwise(F.lower(s)))
    cves = F.transform(F.regexp_extract_all(F.col("t"), F.lit(r"(?i)\bCVE-\d{4}-\d{4,7}\b"), F.lit(0)), F.upper)
    said = F.array_compact(F.array(*[F.when(F.col("t").rlike(p), F.struct(F.lit("exploit" if k in ("actively_exploited", "poc_available") else "patch").alias("kind"), F.lit(k).alias("fact"))) for k, p in STATEMENTS.items()]))
    typed = lambda kind, values: F.transform(values, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("fact")))
    rows = records.where("issue_id is not null and source is not null").select("issue_id", "source", hay.alias("t"))
    return rows.select("issue_id", "source", F.explode(F.concat(typed("severity", severity), typed("cve", cves), said)).alias("f")).select("issue_id", "source", "f.kind", "f.fact").distinct()


def consensus(facts: DataFrame) -> DataFrame:
    """``(issue_id, kind, fact, n_sources, n_speaking, status)``: agreed if all of at least two sources that speak of the kind say it,
    unique if one of several does, else disputed; single if only one source speaks of the kind at all."""
    speaking = facts.groupBy("issue_id", "kind").agg(F.countDistinct("source").alias("n_speaking"))
    told = facts.groupBy("issue_id", "kind", "fact").agg(F.countDistinct("source").alias("n_sources"))
    status = F.when(F.col("n_speaking") == 1, "single").when(F.col("n_sources") == F.col("n_speaking"), "agreed").when(F.col("n_sources") == 1, "unique").otherwise("disputed")
    return told.join(speaking, ["issue_id", "kind"]).withColumn("status", status)


def conflicts(facts: DataFrame) -> DataFrame:
    """``(issue_id, kind, n_values, n_sources)`` where sources differ on a kind that can have one value."""
    rows = facts.where(F.col("kind").isin("severity", "patch")).groupBy("issue_id", "kind").agg(F.countDistinct("fact").alias("n_values"), F.countDistinct("source").alias("n_sources"))
    return rows.where("n_values > 1 and n_sources > 1")


def weakness(hay: Column, whole_words: bool = True) -> Column:
    """First kind of ``GUIDANCE`` that a text names. ``whole_words=False`` also takes "rce" inside other words."""
    out = F.lit(None).cast("string")
    for name, _ in reversed(GUIDANCE):
        hit = F.lower(hay).rlike(rf"(^|[^a-z0-9]){name}([^a-z0-9]|$)") if whole_words else F.lower(hay).contains(name)
        out = F.when(hit, name).otherwise(out)
    return out


def remediation(required: Column, hay: Column) -> Column:
    """Steps joined by ``|``: the required action, else the guidance for the kind of weakness, else the default."""
    kind, out = weakness(hay), F.lit(DEFAULT_GUIDANCE)
    for name, steps in reversed(GUIDANCE):
        out = F.when(kind == name, steps).otherwise(out)
    return F.when(F.coalesce(F.trim(required), F.lit("")) != "", required).otherwise(out)


def own_sentences(summary: Column, name: Column) -> Column:
    """The sentences of a summary that name ``name``, joined; the whole summary if none does."""
    kept = F.array_join(F.filter(F.split(summary, r"(?<=[.!?])\s+"), lambda s: s.contains(name)), " ")
    return F.when(kept != "", kept).otherwise(summary)
