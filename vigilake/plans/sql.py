"""Pieces of SQL that the oracle queries share. Written for DuckDB over the same parquet tables."""

from __future__ import annotations

from vigilake.functions.text import STOPWORDS
from vigilake.operators import facts, rules


def q(text: str) -> str:
    """A string literal."""
    return "'" + text.replace("'", "''") + "'"


def strip(c: str) -> str:
    return rf"coalesce(regexp_replace({c}, '^[\s\x{{a0}}]+|[\s\x{{a0}}]+$', '', 'g'), '')"


def norm_title(c: str) -> str:
    s = rf"regexp_replace(lower({c}), '[\s\x{{a0}}_-]+', ' ', 'g')"
    return rf"trim(regexp_replace(regexp_replace({s}, '[^a-z0-9 .:/]+', '', 'g'), '\s+', ' ', 'g'))"


def latin(c: str) -> str:
    """Letters beyond ASCII as x: the JVM's word boundary knows them, DuckDB's is ASCII only."""
    letters = r"[\x{aa}\x{b5}\x{ba}\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{2c1}\x{370}-\x{1fff}\x{3005}-\x{3007}\x{3041}-\x{3096}\x{309d}-\x{309f}\x{30a1}-\x{30fa}\x{30fc}-\x{30ff}\x{3400}-\x{9fff}\x{ff10}-\x{ff19}\x{ff21}-\x{ff3a}\x{ff41}-\x{ff5a}\x{ff66}-\x{ff9d}]"
    return f"regexp_replace({c}, '{letters}', 'x', 'g')"


def cves(hay: str, least: str = "{4,7}") -> str:
    return rf"list_sort(list_distinct(list_transform(regexp_extract_all({latin(hay)}, '(?i)\bCVE-\d{{4}}-\d{least}\b'), lambda x: upper(x))))"


def like(c: str, pattern: str) -> str:
    return f"regexp_matches({latin(c)}, {q('(?i)' + pattern)})"


def joined(items: str, sep: str = ";") -> str:
    return f"array_to_string({items}, '{sep}')"


def tokens(c: str, shortest: int = 3, stop: bool = True) -> str:
    out = f"list_filter(list_distinct(regexp_split_to_array(lower(coalesce({c}, '')), '[^a-z0-9]+')), lambda x: length(x) >= {shortest})"
    return f"list_filter({out}, lambda x: x NOT IN ({', '.join(map(q, STOPWORDS))}))" if stop else out


SIG = f"""sig AS (
    SELECT row_id, batch_no, {', '.join(f'{strip(c)} AS {c}' for c in ('source', 'guid', 'title', 'link', 'published_date', 'summary', 'fetched_at'))},
        coalesce(nullif({strip('signal_id')}, ''), CASE WHEN coalesce(nullif({strip('guid')}, ''), nullif({strip('link')}, ''), nullif({strip('title')}, '')) IS NOT NULL
            THEN sha256({strip('source')} || '|' || coalesce(nullif({strip('guid')}, ''), nullif({strip('link')}, ''), nullif({strip('title')}, ''))) END, '') AS signal_id
    FROM signals)"""
KEYED = f"""{SIG}, named AS (SELECT *, {cves("guid || ' ' || title || ' ' || summary || ' ' || link")} AS found FROM sig),
keyed AS (
    SELECT *, 'cve' AS issue_type, unnest(found) AS cve FROM named WHERE len(found) > 0
    UNION ALL SELECT *, 'unknown', NULL FROM named WHERE len(found) = 0),
ided AS (SELECT *, coalesce(cve, 'UNK-' || left(sha256(source || '|' || {norm_title('title')} || '|' || published_date), 16)) AS issue_id FROM keyed)"""
ISSUES = f"""{KEYED}, iss AS (
    SELECT issue_id, issue_type, list_sort(list_distinct(list(cve) FILTER (cve IS NOT NULL))) AS cves,
        CASE WHEN issue_type = 'cve' THEN coalesce(min(title) FILTER (contains(upper(title), upper(issue_id))), issue_id)
            ELSE coalesce(first(title ORDER BY length(title) DESC, title) FILTER (title <> ''), '') END AS title,
        coalesce(first(summary ORDER BY length(summary) DESC, summary) FILTER (summary <> ''), '') AS summary,
        coalesce(min(link) FILTER (contains(link, 'nvd.nist.gov/vuln/detail/')), min(link) FILTER (link <> ''), '') AS canonical_link,
        list_sort(list_distinct(list(link) FILTER (link <> ''))) AS links, list_sort(list_distinct(list(source) FILTER (source <> ''))) AS sources,
        list_sort(list_distinct(list(published_date) FILTER (published_date <> ''))) AS published_dates,
        min(fetched_at) FILTER (fetched_at <> '') AS first_seen_at, max(fetched_at) FILTER (fetched_at <> '') AS last_seen_at, count(*) AS n_signals
    FROM ided GROUP BY issue_id, issue_type)"""
AUTHORITY = f"""{ISSUES}, auth AS (
    SELECT i.issue_id, max(s.weight) AS weight, first(s.source_id ORDER BY s.weight DESC, s.source_id) AS best_source, first(s.tier ORDER BY s.weight DESC, s.source_id) AS tier, bool_or(s.medical) AS medical
    FROM (SELECT issue_id, unnest(sources) AS s FROM iss) i JOIN sources s ON s.source_id = i.s GROUP BY i.issue_id),
known AS (SELECT i.*, a.weight, a.best_source, a.tier, a.medical, CASE right(i.issue_id, 1) WHEN '3' THEN '3' WHEN '2' THEN '2' WHEN '1' THEN '1' END AS fda_risk_class
    FROM iss i LEFT JOIN auth a USING (issue_id))"""


def score_terms(version: int) -> list[tuple[str, str, str]]:
    """(condition, points, label) of each reason, in order."""
    hay = "(issue_id || chr(10) || title || chr(10) || summary)"
    terms = [("issue_type = 'cve'", "10", q("base: issue_type=cve (+10)")), ("issue_type <> 'cve'", "2", q("base: issue_type!=cve (+2)")), ("contains(lower(array_to_string(sources, ' ')), 'kev')", "80", q("source: KEV source (+80)"))]
    rule = lambda table: [(like(hay, p), str(points), q(label)) for p, points, label in table]
    terms += [*rule(rules.KEYWORDS), ("contains(lower(array_to_string(links, ' ')), 'nvd.nist.gov/vuln/detail/')", "5", q("link: NVD detail present (+5)"))]
    if version == 2:
        points = f"CAST(round_even({rules.AUTHORITY_POINTS} * weight, 0) AS INTEGER)"
        terms.append(("coalesce(weight, 0) > 0", points, f"'source-authority: tier-' || tier || ' (+' || {points} || ')'"))
        terms.append(("coalesce(medical, false)", str(rules.MEDICAL_BONUS), q(f"healthcare-source: tier-1 medical source (+{rules.MEDICAL_BONUS})")))
        terms += [*rule(rules.DEVICES), *rule(rules.PATCHES), *rule(rules.CLINICAL)]
        terms += [("fda_risk_class = '3'", "30", q("fda-risk-class: Class III highest-risk device (+30)")), ("fda_risk_class = '2'", "10", q("fda-risk-class: Class II moderate-risk device (+10)"))]
    return terms


def scored(version: int) -> str:
    terms = score_terms(version)
    total = " + ".join(f"CASE WHEN {c} THEN {p} ELSE 0 END" for c, p, _ in terms)
    why = joined("list_filter([" + ", ".join(f"CASE WHEN {c} THEN {label} END" for c, _, label in terms) + "], lambda x: x IS NOT NULL)")
    return f"""{AUTHORITY}, points AS (SELECT *, {total} AS score, {why} AS why FROM known),
scored AS (SELECT * EXCLUDE (why), why || ';priority: ' || priority || ' (score=' || score || ')' AS why FROM (SELECT *, {priority('score')} AS priority FROM points))"""


def priority(score: str) -> str:
    return "CASE " + " ".join(f"WHEN {score} >= {least} THEN '{name}'" for name, least in rules.PRIORITIES) + " ELSE 'P3' END"


def actions(p: str) -> str:
    return f"CASE {p} WHEN 'P0' THEN 'notify;ingest;track' WHEN 'P1' THEN 'ingest;track' WHEN 'P2' THEN 'track' ELSE 'log' END"


def category() -> str:
    hay = "(title || ' ' || summary)"
    plain = f"CASE WHEN {like(hay, rules.SYSTEM_WORDS)} THEN 'healthcare_it' WHEN {like(hay, rules.SITE_WORDS)} THEN 'healthcare_infrastructure' ELSE 'healthcare_adjacent' END"
    false = f"({like(hay, rules.NOT_MEDICAL)} OR ({like(hay, rules.THREATS)} AND NOT {like(hay, rules.STRONG_DEVICE)}))"
    # No lookbehind here: a maker's name stands between characters that belong to no word.
    makers = "|".join(v.replace(".", r"\.") for v in rules.VENDORS)
    named = f"regexp_matches({latin(hay)}, {q('(?i)(^|[^0-9A-Za-z_])(?:' + makers + ')([^0-9A-Za-z_]|$)')})"
    device = f"(coalesce(medical, false) OR {named} OR fda_risk_class IS NOT NULL OR {like(hay, rules.DEVICE_WORDS)})"
    relevant = f"(coalesce(medical, false) OR {like(hay, rules.RELEVANT_WORDS)} OR {named})"
    return f"SELECT issue_id, {relevant} AS relevant, CASE WHEN NOT {relevant} THEN 'not_healthcare' WHEN {false} THEN {plain} WHEN {device} THEN 'medical_device' ELSE {plain} END AS category"


def weakness(hay: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches(lower({hay}), '(^|[^a-z0-9]){name}([^a-z0-9]|$)') THEN {q(name)}" for name, _ in facts.GUIDANCE) + " END"


def steps(kind: str) -> str:
    return f"CASE {kind} " + " ".join(f"WHEN {q(name)} THEN {q(text)}" for name, text in facts.GUIDANCE) + f" ELSE {q(facts.DEFAULT_GUIDANCE)} END"
