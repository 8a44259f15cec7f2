"""Rule tables turned into one projection each: scores with reasons, tags, categories.

A table of patterns becomes one expression per row over a text column that is computed once (``let``), so thirty patterns share one
concatenation and the whole rule set is a single pass over the issues.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilake.operators.timestamps import let

# Patterns, points and labels of the scores.
KEYWORDS = [
    (r"\bactively exploited\b", 40, "keyword: actively exploited (+40)"),
    (r"\bknown exploited\b|\bkev\b", 80, "keyword: KEV/known exploited (+80)"),
    (r"\bremote code execution\b|\brce\b", 30, "keyword: RCE (+30)"),
    (r"\bauthentication bypass\b|\bauth bypass\b", 25, "keyword: auth bypass (+25)"),
    (r"\bprivilege escalation\b|\bpriv esc\b", 20, "keyword: privilege escalation (+20)"),
    (r"\barbitrary code\b|\bcode execution\b", 25, "keyword: code execution (+25)"),
    (r"\bdata exfiltration\b|\bexfiltration\b", 15, "keyword: data exfiltration (+15)"),
    (r"\binformation disclosure\b", 15, "keyword: information disclosure (+15)"),
    (r"\bsql injection\b|\bsqli\b", 15, "keyword: SQLi (+15)"),
    (r"\bdenial of service\b|\bdos\b", 5, "keyword: DoS (+5)"),
    (r"\bproof of concept\b|\bpoc\b", 10, "keyword: PoC (+10)"),
]
DEVICES = [
    (r"\binfusion pump\b|\binsulin pump\b|\bdrug pump\b|\biv pump\b", 25, "device: infusion/drug pump (+25)"),
    (r"\bventilator\b|\brespir(ator|atory)\b|\blife support\b", 25, "device: ventilator/life-support (+25)"),
    (r"\bdefibrillator\b|\baed\b|\bpacemaker\b|\bimplantable\b|\bcardiac implant\b", 25, "device: cardiac implant/defibrillator (+25)"),
    (r"\bpatient monitor\b|\bcentral monitor\b|\bvital signs?\b|\becg\b|\bekg\b|\bcardiac monitor\b|\bbedside monitor\b", 20, "device: patient monitor (+20)"),
    (r"\bpacs\b|\bdicom\b|\bradiology\b|\bimaging\b|\bmri\b|\bct scan\b|\bx.?ray\b|\bultrasound\b|\bpet scan\b|\bfluoroscop\b", 15, "device: medical imaging/PACS (+15)"),
    (r"\behr\b|\bemr\b|\belectronic health record\b|\belectronic medical record\b", 10, "device: EHR/EMR (+10)"),
    (r"\bhospital\b|\bclinic\b|\bmedical device\b|\bhealthcare\b|\bhealth care\b", 10, "device: healthcare context (+10)"),
]
PATCHES = [
    (r"\bno patch\b|\bno fix\b|\bunpatched\b|\bno (available )?(patch|fix|update)\b|\bpatch (is )?not available\b", 20, "patch: no patch available (+20)"),
    (r"\bend.of.life\b|\bend of support\b|\beol\b|\bdecommissioned\b|\bno longer supported\b", 15, "patch: end of life/decommissioned (+15)"),
    (r"\bvendor.managed\b|\bvendor patch\b|\bcontact vendor\b|\breach out.*vendor\b", 10, "patch: vendor-managed remediation (+10)"),
    (r"\bfirmware\b", 10, "patch: firmware update required (+10)"),
]
CLINICAL = [
    (r"\blife.sustaining\b|\blife support\b", 30, "clinical: life-sustaining impact (+30)"),
    (r"\bpatient safety\b", 25, "clinical: patient safety (+25)"),
    (r"\bicu\b|\bintensive care\b|\bcritical care unit\b", 20, "clinical: ICU/critical care (+20)"),
    (r"\bphi\b|\bprotected health information\b|\bpatient (data|record|information)\b", 15, "clinical: PHI/patient data (+15)"),
    (r"\bclinical\b", 5, "clinical: clinical context (+5)"),
]
AUTHORITY_POINTS, MEDICAL_BONUS = 30, 50
PRIORITIES = [("P0", 150), ("P1", 100), ("P2", 60)]
# Keywords of device, information system and infrastructure; what is none; general threat reports.
DEVICE_WORDS = r"infusion pump|ventilator|defibrillator|pacemaker|implantable|patient monitor|pulse oximeter|surgical robot|insulin pump|blood gas analyzer|x-ray|ultrasound|\bmri\b|\bct\b|medical device|biomedical|imaging|pacs|dicom|catheter|oxygenator|respirator|wearable medical|510\(k\)|premarket|postmarket|medical device regulation|\bfda\b|iec 62443"
SYSTEM_WORDS = r"\behr\b|\bemr\b|electronic health record|electronic medical record|\bhl7\b|\bfhir\b|telehealth|point of care|clinical informatics|health information (system|exchange)|cerner|epic systems"
SITE_WORDS = r"\bhospital\b|\bclinic\b|health care|healthcare|hipaa|\bphi\b|\bephi\b|protected health information|clinical|bedside|\bicu\b|intensive care"
RELEVANT_WORDS = r"infusion pump|ventilator|patient monitor|defibrillator|pacemaker|imaging|pacs|dicom|\bmri\b|\bct\b|x-ray|ultrasound|surgical robot|insulin pump|blood gas analyzer|pulse oximeter|\behr\b|\bemr\b|\bhl7\b|\bfhir\b|medical device|clinical|biomedical|telehealth|point of care|bedside|wearable medical|\bfda\b|iec 62443|hipaa|\bphi\b|\bephi\b|510\(k\)|premarket|postmarket|medical device regulation"
NOT_MEDICAL = r"sunscreen|sunblock|cosmetic|lipstick|mascara|fragrance|perfume|shampoo|conditioner|lotion|moisturizer|body wash|hair dye|food safety|food recall|food product|pet food|animal feed|veterinary"
THREATS = r"\bbackdoor\b|\btrojan\b|\bransomware campaign\b|\bapt\d+\b|\bthreat actor\b|\bmalware analysis\b"
STRONG_DEVICE = r"infusion pump|ventilator|defibrillator|pacemaker|implantable|patient monitor|pulse oximeter|surgical robot|insulin pump|blood gas analyzer"


# Makers of medical devices.
VENDORS = [
    "ge healthcare", "philips", "siemens healthineers", "bd", "baxter", "medtronic", "stryker", "abbott", "boston scientific", "draeger", "hillrom", "welch allyn", "zoll", "mindray", "nihon kohden", "b. braun", "spacelabs",
    "masimo", "natus", "getinge", "olympus medical", "fujifilm medical", "carestream", "hologic", "beckman coulter", "biomerieux", "biomérieux", "roche diagnostics", "cerner", "epic systems", "contec health", "whill",
]
VENDOR_WORDS = r"(?<![\w])(?:" + "|".join(v.replace(".", r"\.") for v in VENDORS) + r")(?![\w])"


# Words of the filter for recalls, of which only what touches security counts.
CYBER = ["cybersecurity", "vulnerability", "exploit", "unauthorized access", "data breach", "encryption", "authentication", "password", "remote", "network", "software", "firmware", "patch", "hack", "malware", "ransomware", "cve-", "security update"]


def ilike(c: Column, pattern: str) -> Column:
    return c.rlike("(?i)" + pattern)


def cyber(*texts: Column) -> Column:
    """Whether one of ``texts``, joined by blanks, holds a word of ``CYBER``, also within another word."""
    return ilike(F.concat_ws(" ", *[F.coalesce(t, F.lit("")) for t in texts]), "|".join(CYBER))


def priority(score: Column) -> Column:
    out = F.lit("P3")
    for name, least in reversed(PRIORITIES):
        out = F.when(score >= least, name).otherwise(out)
    return out


def actions(p: Column) -> Column:
    return F.when(p == "P0", "notify;ingest;track").when(p == "P1", "ingest;track").when(p == "P2", "track").otherwise("log")


def priority_rank(p: Column) -> Column:
    rank = F.upper(F.trim(p))
    return F.when(rank == "P0", 3).when(rank == "P1", 2).when(rank == "P2", 1).when(rank == "P3", 0).otherwise(-1)


def _reasons(hay: Column, rules: list[tuple[str, int, str]]) -> list[Column]:
    return [F.when(ilike(hay, p), F.struct(F.lit(points).alias("points"), F.lit(label).alias("label"))) for p, points, label in rules]


def scored(issues: DataFrame, version: int = 2) -> DataFrame:
    """``issues`` with ``score``, ``priority``, ``actions`` and ``why`` (reasons in order and the priority they lead to, joined by ``;``).

    Needs ``issue_id, issue_type, title, summary, sources, links`` and for version 2 ``weight`` (of the best source, null: none known),
    ``tier``, ``medical`` and ``fda_risk_class``. Nulls count as empty.
    """
    empty = F.array().cast("array<string>")
    base = F.when(F.lower(F.trim("issue_type")) == "cve", F.struct(F.lit(10).alias("points"), F.lit("base: issue_type=cve (+10)").alias("label")))
    base = base.otherwise(F.struct(F.lit(2).alias("points"), F.lit("base: issue_type!=cve (+2)").alias("label")))
    kev = F.lower(F.array_join(F.coalesce("sources", empty), " ")).contains("kev")
    linked = F.lower(F.array_join(F.coalesce("links", empty), " ")).contains("nvd.nist.gov/vuln/detail/")
    reason = lambda when, points, label: F.when(when, F.struct(points.alias("points"), label.alias("label")))
    hay = F.concat_ws("\n", F.coalesce("issue_id", F.lit("")), F.coalesce("title", F.lit("")), F.coalesce("summary", F.lit("")))

    def all_reasons(t: Column) -> Column:
        found = [base, reason(kev, F.lit(80), F.lit("source: KEV source (+80)")), *_reasons(t, KEYWORDS), reason(linked, F.lit(5), F.lit("link: NVD detail present (+5)"))]
        if version == 2:
            weight = F.coalesce("weight", F.lit(0.0))
            points = F.bround(AUTHORITY_POINTS * weight, 0).cast("int")
            found.append(reason(weight > 0, points, F.concat(F.lit("source-authority: tier-"), F.coalesce(F.col("tier").cast("string"), F.lit("?")), F.lit(" (+"), points.cast("string"), F.lit(")"))))
            found.append(reason(F.coalesce("medical", F.lit(False)), F.lit(MEDICAL_BONUS), F.lit(f"healthcare-source: tier-1 medical source (+{MEDICAL_BONUS})")))
            found += [*_reasons(t, DEVICES), *_reasons(t, PATCHES), *_reasons(t, CLINICAL)]
            found.append(reason(F.col("fda_risk_class") == "3", F.lit(30), F.lit("fda-risk-class: Class III highest-risk device (+30)")))
            found.append(reason(F.col("fda_risk_class") == "2", F.lit(10), F.lit("fda-risk-class: Class II moderate-risk device (+10)")))
        return F.filter(F.array(*found), lambda x: x.isNotNull())

    r = let(hay, all_reasons)
    out = issues.withColumn("__r", let(r, lambda x: F.struct(F.aggregate(x, F.lit(0), lambda a, y: a + y.points).alias("score"), F.array_join(F.transform(x, lambda y: y.label), ";").alias("why"))))
    out = out.select(*issues.columns, F.col("__r.score").alias("score"), F.col("__r.why").alias("why")).withColumn("priority", priority(F.col("score")))
    closing = F.concat(F.lit("priority: "), F.col("priority"), F.lit(" (score="), F.col("score").cast("string"), F.lit(")"))
    return out.withColumn("why", F.concat_ws(";", "why", closing)).withColumn("actions", actions(F.col("priority")))


def rescored(rows: DataFrame) -> DataFrame:
    """``rows`` after enrichment: the class bonus where the label isn't in ``why`` yet, 40 for exploited devices, priority derived anew.

    Needs ``score, why, fda_risk_class, is_kev_medical``.
    """
    label = F.when(F.col("fda_risk_class") == "3", "fda-risk-class: Class III highest-risk device (+30)").when(F.col("fda_risk_class") == "2", "fda-risk-class: Class II moderate-risk device (+10)")
    fresh = label.isNotNull() & ~F.col("why").contains(label)
    bonus = F.when(fresh & (F.col("fda_risk_class") == "3"), 30).when(fresh, 10).otherwise(0)
    kev = F.coalesce("is_kev_medical", F.lit(False))
    why = F.concat_ws(";", F.col("why"), F.when(fresh, label), F.when(kev, F.lit("kev-medical-device: actively exploited medical device (+40)")))
    out = rows.withColumn("score", F.col("score") + bonus + F.when(kev, 40).otherwise(0)).withColumn("why", why)
    return out.withColumn("priority", priority(F.col("score"))).withColumn("actions", actions(F.col("priority")))


def tagged(issues: DataFrame) -> DataFrame:
    """``issue_id`` with four exploit and four impact flags and a confidence of two digits."""
    src = F.lower(F.array_join(F.coalesce("sources", F.array().cast("array<string>")), " "))
    body = F.lower(F.concat_ws("\n", F.coalesce("title", F.lit("")), F.coalesce("summary", F.lit(""))))
    full = F.concat_ws("\n", src, body)
    kev = src.contains("kev") | full.contains("known exploited")
    active = full.contains("actively exploited") | full.contains("active exploitation")
    has_cve = (F.size(F.coalesce("cves", F.array().cast("array<string>"))) > 0) | F.concat_ws(" ", "issue_id", body).rlike(r"(?i)\bCVE-\d{4}-\d{4,7}\b")
    confidence = F.lit(0.4) + F.when(has_cve, 0.2).otherwise(0) + F.when(kev, 0.3).otherwise(0) + F.when(active, 0.1).otherwise(0)
    return issues.select(
        "issue_id", kev.alias("kev"), active.alias("active_exploitation"), (full.contains("proof of concept") | full.rlike(r"\bpoc\b")).alias("poc"), full.contains("ransomware").alias("ransomware"),
        (body.contains("code execution") | body.rlike(r"\brce\b")).alias("rce"), (body.contains("privilege escalation") | body.contains("priv esc")).alias("priv_esc"),
        (body.contains("authentication bypass") | body.contains("auth bypass")).alias("auth_bypass"), body.contains("exfiltration").alias("data_exfil"),
        F.bround(F.least(F.greatest(confidence, F.lit(0.0)), F.lit(1.0)), 2).alias("confidence"),
    )


def false_positive(hay: Column) -> Column:
    """No medical device: cosmetics and food, or a general threat report without a definite device."""
    return ilike(hay, NOT_MEDICAL) | (ilike(hay, THREATS) & ~ilike(hay, STRONG_DEVICE))


def categorised(issues: DataFrame) -> DataFrame:
    """``issue_id, relevant, category``. Needs ``title, summary, medical`` (any source is medical) and ``fda_risk_class``; ``vendor`` and ``sources`` are used if there.

    A maker of medical devices named in title, summary or vendor makes an issue relevant and a device; a maker only within a longer name of the vendor does so
    for issues that a KEV source brought, after the keywords.
    """
    vendor = F.coalesce("vendor", F.lit("")) if "vendor" in issues.columns else F.lit("")
    kev = F.lower(F.array_join(F.coalesce("sources", F.array().cast("array<string>")), " ")).contains("kev") if "sources" in issues.columns else F.lit(False)
    hay = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("summary", F.lit("")), vendor)
    medical = F.coalesce("medical", F.lit(False))

    def of(t: Column) -> Column:
        maker = kev & F.greatest(*[F.lower(vendor).contains(v) for v in VENDORS])
        words = F.when(ilike(t, SYSTEM_WORDS), "healthcare_it").when(ilike(t, SITE_WORDS), "healthcare_infrastructure")
        named = ilike(t, VENDOR_WORDS)
        device = medical | named | F.col("fda_risk_class").isNotNull() | ilike(t, DEVICE_WORDS)
        category = F.when(false_positive(t), F.coalesce(words, F.lit("healthcare_adjacent"))).when(device, "medical_device").otherwise(F.coalesce(words, F.when(maker, "medical_device"), F.lit("healthcare_adjacent")))
        relevant = medical | ilike(t, RELEVANT_WORDS) | named | maker
        return F.struct(relevant.alias("relevant"), F.when(relevant, category).otherwise("not_healthcare").alias("category"))

    return issues.select("issue_id", let(hay, of).alias("c")).select("issue_id", "c.relevant", "c.category")
