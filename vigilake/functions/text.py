"""Text functions as column expressions; the few that the JVM has no built-in for are Arrow UDFs."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

CVE = r"(?i)\bCVE-\d{4}-\d{4,7}\b"
NVD_PAGE = "https://nvd.nist.gov/vuln/detail/"
# Words that carry no meaning for the similarity of issues.
STOPWORDS = (
    "a an the in of on for and or to with is are was were be been by at from has have this that via due can may allows allow "
    "could which when affects affecting affect"
).split()
# Forms of text that try to take over a model's instructions, and what replaces them.
INJECTIONS = [
    (r"(?i)(?:please\s+)?(?:ignore|disregard|forget|override|bypass)\s+(?:all\s+)?(?:previous|prior|above|earlier|system|original)\s+(?:instructions?|prompts?|rules?|constraints?|directions?)", "[REDACTED-INSTRUCTION-OVERRIDE]"),
    (r"(?i)you\s+are\s+(?:now|actually|really|henceforth)\s+[a-zA-Z]", "[REDACTED-ROLE-HIJACK]"),
    (r"(?i)(?:do\s+not|don'?t|stop)\s+follow(?:ing)?\s+(?:the\s+)?(?:previous|above|system|original|prior)\s+", "[REDACTED-INSTRUCTION-OVERRIDE]"),
    (r"(?i)(?:new|updated|revised|real)\s+(?:system\s+)?(?:instructions?|prompt|role)\s*:", "[REDACTED-PROMPT-HEADER]"),
    (r"(?i)```\s*(?:system|instruction|prompt)", "[REDACTED-BLOCK]"),
]


def some(c: Column) -> Column:
    """Null for the empty text."""
    return F.when(c != "", c)


def strip(c: Column) -> Column:
    """Without white space, of any kind, around it; null stays null."""
    return F.regexp_replace(c, r"^[\s\x{a0}]+|[\s\x{a0}]+$", "")


def text(c: Column) -> Column:
    """Stripped, empty for null."""
    return F.coalesce(strip(c), F.lit(""))


def norm_title(c: Column) -> Column:
    """Lower case, runs of blanks, dashes and underscores as one blank, nothing but ``[a-z0-9 .:/]``."""
    s = F.regexp_replace(F.lower(text(c)), r"[\s\x{a0}_-]+", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(s, r"[^a-z0-9 .:/]+", ""), r"\s+", " "))


def cves(*parts: Column) -> Column:
    """Distinct CVE ids of the texts, upper case, sorted."""
    hay = F.concat_ws(" ", *parts)
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(hay, F.lit(CVE), F.lit(0)), F.upper)))


def signal_id(source: Column, *keys: Column) -> Column:
    """Digest of the source and the first of ``keys`` that isn't empty; null if all are."""
    first = F.coalesce(*[some(text(k)) for k in keys])
    return F.when(first.isNotNull(), F.sha2(F.concat(source, F.lit("|"), first), 256))


@F.pandas_udf(StringType())
def unescape(s: pd.Series) -> pd.Series:
    """HTML entities as characters."""
    return s.map(html.unescape, na_action="ignore")


def strip_html(c: Column, line: str = " ") -> Column:
    """Plain text of HTML: scripts and styles out, breaks and block ends as ``line``, tags as blanks, blank lines out.

    Entities are unescaped by ``unescape`` only where there is an ampersand. Text without a tag is returned as it is.
    """
    s = F.regexp_replace(c, r"(?is)<(script|style).*?>.*?</\1>", " ")
    s = F.regexp_replace(F.regexp_replace(s, r"(?is)<br\s*/?>", line), r"(?is)</(p|div|li|h[1-6])\s*>", line)
    s = unescape(F.regexp_replace(s, r"(?s)<[^>]+>", " "))
    lines = F.filter(F.transform(F.split(s, r"\r\n|[\r\n]"), lambda x: F.trim(F.regexp_replace(x, r"[ \t\f\x0b]+", " "))), lambda x: x != "")
    return F.when(c.contains("<"), F.array_join(lines, line)).otherwise(c)


def normalize_text(c: Column) -> Column:
    """White space of any kind and length as one blank."""
    return F.trim(F.regexp_replace(c, r"[\s\x{a0}]+", " "))


def words(c: Column, shortest: int, stop: list[str] | None = None) -> Column:
    """Distinct lower-case tokens between other characters than ``[a-z0-9]``."""
    tokens = F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+"), lambda t: F.length(t) >= shortest)
    if stop:
        tokens = F.filter(tokens, lambda t: ~t.isin(*stop))
    return F.array_distinct(tokens)


def tokens(c: Column) -> Column:
    """Tokens for similarity: three characters or more, no stop words."""
    return words(c, 3, STOPWORDS)


def jaccard(a: Column, b: Column) -> Column:
    """Shared part of two sets; 0 if both are empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when(F.size(a) + F.size(b) == 0, F.lit(0.0)).otherwise(both / (F.size(a) + F.size(b) - both))


def sanitize_for_prompt(c: Column, longest: int = 12_000) -> Column:
    """Text for a prompt: control characters out, attempts to give orders redacted, cut at ``longest`` with a mark."""
    s = F.regexp_replace(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", "")
    for pattern, instead in INJECTIONS:
        s = F.regexp_replace(s, pattern, instead.replace("$", r"\$"))
    return F.when(F.length(s) > longest, F.concat(F.substring(s, 1, longest), F.lit("\n[TRUNCATED]"))).otherwise(s)


def safe_stem(c: Column) -> Column:
    return F.regexp_replace(c, r"[^A-Za-z0-9_-]", "_")


def excel_clean(c: Column) -> Column:
    """Without the control characters that spreadsheets refuse."""
    return F.regexp_replace(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "")


def nvd_link(cve: Column) -> Column:
    return F.when(cve.rlike(r"^CVE-\d{4}-\d+$"), F.concat(F.lit(NVD_PAGE), cve)).otherwise("")


def advisory_id(content_hash: Column) -> Column:
    return F.concat(F.lit("adv_"), F.substring(content_hash, 1, 12))


def rss_date(c: Column) -> Column:
    """``YYYY-MM-DD...`` in the form of RFC 2822; anything else as it is."""
    day = F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd")
    return F.when(day.isNotNull(), F.date_format(day, "EEE, dd MMM yyyy '00:00:00 +0000'")).otherwise(c)


def token_estimate(c: Column) -> Column:
    return F.floor(F.length(c) / 4).cast("long")


def cpe_product(cpe: Column) -> Column:
    """"Vendor Product" of a CPE 2.3 name, every stretch of letters capitalised; empty if it has no such parts."""
    parts = F.split(cpe, ":")
    named = F.filter(F.slice(parts, 4, 2), lambda p: ~p.isin("*", "-", ""))
    title = lambda p: F.array_join(F.transform(F.regexp_extract_all(F.lower(F.replace(p, F.lit("_"), F.lit(" "))), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1)), lambda w: F.initcap(w)), "")
    return F.when(F.size(parts) >= 5, F.array_join(F.transform(named, title), " ")).when(cpe.isNotNull(), "")


def revised_date(c: Column) -> Column:
    """Day of "Last Revised" or "Last Updated" in a text, as ``yyyy-MM-dd``; null if there is none."""
    found = F.regexp_extract(c, r"(?i)last\s+(?:revised|updated)\s*:?\s*([a-z]+ \d{1,2}, \d{4})", 1)
    return F.date_format(F.try_to_date(F.initcap(found), "MMMM d, yyyy"), "yyyy-MM-dd")
