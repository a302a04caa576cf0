"""Ordered rules that classify records, as CASE expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from gritmill.functions.text import as_col, bind, filled, known, strip

# Keywords of each domain, in the order in which they are tried.
DOMAIN_KEYWORDS = {
    "prompt_injection_jailbreak": ("prompt", "jailbreak", "gandalf", "hackaprompt", "genai", "llm", "giskard"),
    "phishing_social": ("phish", "spam", "social_engineering", "nazario", "nigerian"),
    "blockchain_web3": ("blockchain", "web3", "smart_contract", "ethereum", "defi", "smartbugs", "solidity", "crypto"),
    "malware_code": (
        "malware", "malmem", "bodmas", "ember", "ransomware", "vulnerable_code", "sard", "juliet", "diversevul", "cvefixes", "code_weakness",
    ),
    "network_intrusion": (
        "network", "nb15", "cicids", "cic_ids", "ids", "iot", "ics", "telemetry", "swat", "wadi", "ton_iot", "awid", "flow", "intrusion",
    ),
    "cloud_infrastructure": ("cloud", "mordor", "otrf", "host_", "k8s", "kubernetes", "aws", "azure", "gcp", "infrastructure"),
    "threat_intelligence": ("mitre", "att&ck", "attack_stix", "capec", "cti", "threat_intel", "adversary_tactic"),
    "vulnerabilities_exposures": ("nvd", "cve", "advisory", "kev", "osv", "ghsa", "supply_chain", "vulnerability", "exposure", "cwe"),
    "web_app_security": ("web", "owasp", "crapi", "api", "xss", "sqli", "benchmark", "appsec"),
}

# Task types by source type, then by domain.
TASK_BY_SOURCE_TYPE = {
    "code": "vulnerability_classification", "vulnerable_code": "vulnerability_classification", "network_flow": "intrusion_classification",
    "iot_flow": "intrusion_classification", "ics_telemetry": "intrusion_classification", "malware_features": "malware_classification",
    "email": "phishing_classification", "url": "phishing_classification", "prompt": "prompt_attack_detection", "prompt_text": "prompt_attack_detection",
    "cloud_log": "anomaly_detection", "mobile_features": "malware_classification", "cti": "knowledge_reference", "advisory": "knowledge_reference",
    "vulnerability_advisory": "knowledge_reference", "package_metadata": "knowledge_reference",
}
TASK_BY_DOMAIN = {
    "web_app_security": "vulnerability_classification", "network_intrusion": "intrusion_classification", "malware_code": "malware_classification",
    "phishing_social": "phishing_classification", "prompt_injection_jailbreak": "prompt_attack_detection", "vulnerabilities_exposures": "knowledge_reference",
    "cloud_infrastructure": "anomaly_detection", "blockchain_web3": "vulnerability_classification", "threat_intelligence": "knowledge_reference",
}

# Fixed values: (head, categories, source types, labels, task), in the order in which they are tried.
HEADS = (
    (
        "malware_code",
        ("Vulnerable Code & Software Weaknesses", "Malware & PE/Memory Features", "Web Application Security", "API Security", "Mobile Security"),
        ("vulnerable_code", "malware_features", "malware_binary_metadata", "smart_contract_code", "smart_contract_bytecode_metadata", "web_app_request", "api_request", "mobile_app_metadata"),
        (), "classification",
    ),
    (
        "cti",
        ("Threat Intelligence, CVE, Advisory & Taxonomy", "Supply Chain & Open Source Package Security", "DNS, Exfiltration & C2 Abuse", "Cryptocurrency & Blockchain Attacks"),
        ("cti_taxonomy", "vulnerability_advisory", "package_metadata", "dns_event", "defi_incident"),
        (), "knowledge",
    ),
    ("prompt_injection_jailbreaks", ("AI, LLM & ML Security",), ("prompt_text", "llm_io_pair"), ("malicious_prompt", "benign_prompt", "jailbreak_prompt", "ai_security_risk"), "classification"),
    ("network_intrusion", ("Network Intrusion & Traffic Attacks",), (), (), "classification"),
    ("phishing_social", ("Phishing, Social Engineering & Fraud",), (), (), "classification"),
    ("cloud_saas_abuse", ("Cloud, SaaS & Identity Abuse", "Identity & Credential Attacks"), (), (), "classification"),
    ("iot_ics", ("IoT, Embedded & Hardware Attacks", "ICS, OT & Critical Infrastructure Attacks"), (), (), "classification"),
    ("supply_chain", ("Supply Chain & Open Source Package Security",), (), (), "knowledge"),
)

# Where known sources are published, by a part of their name, in the order in which they are tried.
SOURCE_URLS = {
    "nvd": "https://nvd.nist.gov/", "cisa_kev": "https://www.cisa.gov/known-exploited-vulnerabilities-catalog", "kev": "https://www.cisa.gov/known-exploited-vulnerabilities-catalog",
    "osv": "https://osv.dev/", "github_advisor": "https://github.com/advisories", "ghsa": "https://github.com/advisories", "mitre_attack": "https://attack.mitre.org/",
    "capec": "https://capec.mitre.org/", "cwe": "https://cwe.mitre.org/", "phishtank": "https://phishtank.org/", "unsw_nb15": "https://research.unsw.edu.au/projects/unsw-nb15-dataset",
    "sard": "https://samate.nist.gov/SARD/", "juliet": "https://samate.nist.gov/SARD/", "owasp": "https://owasp.org/", "gandalf": "https://www.lakera.ai/",
    "hackaprompt": "https://www.hackaprompt.com/", "giskard": "https://www.giskard.ai/", "smartbugs": "https://github.com/smartbugs/smartbugs",
    "defihacklabs": "https://github.com/SunWeb3Sec/DeFiHackLabs", "otrf": "https://github.com/OTRF/Security-Datasets",
}


def first_keyword(haystack: Column, rules: dict[str, tuple[str, ...]], default: str) -> Column:
    """Name of the first rule one of whose keywords occurs in the text."""

    def ladder(text: Column) -> Column:
        steps = F
        for name, keywords in rules.items():
            steps = steps.when(text.rlike("|".join(re.escape(k) for k in keywords)), name)
        return steps.otherwise(default)

    return bind(haystack, ladder)


def domain(*signals: Column | str) -> Column:
    haystack = F.lower(F.concat_ws(" ", *[F.coalesce(known(s), F.lit("")) for s in signals]))
    return first_keyword(haystack, DOMAIN_KEYWORDS, "miscellaneous")


def _lookup(mapping: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair]), key)


def task_type(source_type: Column | str, domain_: Column) -> Column:
    return F.coalesce(_lookup(TASK_BY_SOURCE_TYPE, F.lower(known(source_type))), _lookup(TASK_BY_DOMAIN, domain_), F.lit("classification"))


def source_url(*names: Column | str) -> Column:
    haystack = F.lower(F.concat_ws(" ", *[F.coalesce(as_col(n), F.lit("")) for n in names]))

    def ladder(text: Column) -> Column:
        steps = F
        for key, url in SOURCE_URLS.items():
            steps = steps.when(text.contains(key), url)
        return steps.otherwise("")

    return bind(haystack, ladder)


def head(category: Column | str, source_type: Column | str, label: Column | str) -> Column:
    """Struct (head, task): the first head that lists the category, the source type or the label."""
    c, s, x = filled(category), filled(source_type), filled(label)
    ladder = F
    for name, categories, types, labels, task in HEADS:
        hit = F.coalesce(c.isin(*categories), F.lit(False))
        if types:
            hit = hit | F.coalesce(s.isin(*types), F.lit(False))
        if labels:
            hit = hit | F.coalesce(x.isin(*labels), F.lit(False))
        ladder = ladder.when(hit, F.struct(F.lit(name).alias("head"), F.lit(task).alias("task")))
    return ladder.otherwise(F.struct(F.lit("miscellaneous").alias("head"), F.lit("classification").alias("task")))


def difficulty(technique: Column | str, cve: Column | str, cwe: Column | str, features: Column | str) -> Column:
    return F.when(F.coalesce(filled(technique), filled(cve)).isNotNull(), "hard").when(F.coalesce(filled(cwe), filled(features)).isNotNull(), "medium").otherwise("easy")


def severity_of_score(score: Column) -> Column:
    """critical from 9, high from 7, medium from 4, low above 0, else info; null for null."""
    return F.when(score >= 9, "critical").when(score >= 7, "high").when(score >= 4, "medium").when(score > 0, "low").when(score.isNotNull(), "info")


def severity(vendor: Column | str, *scores: Column) -> Column:
    """Of the first score that is there, else of the vendor's word; ``unknown`` if neither says anything."""
    word = F.lower(strip(F.coalesce(as_col(vendor), F.lit(""))))
    named = (
        F.when(word == "moderate", "medium").when(word == "important", "high").when(word == "none", "info").when(word.isin("critical", "high", "medium", "low", "info"), word).otherwise("unknown")
    )
    return F.coalesce(severity_of_score(F.coalesce(*[F.when(~F.isnan(s), s) for s in scores])), named) if scores else named


# Words for the two classes.
ATTACK_WORDS = ("1", "true", "malicious", "phishing", "jailbreak", "attack", "vulnerable", "yes")
HARMLESS_WORDS = ("0", "false", "benign", "benign_url", "non_vulnerable", "safe", "no")


def binary_label(value: Column | str) -> Column:
    """1 for attacks, 0 for harmless records, null for any other word (a violation where a label is required)."""
    word = F.lower(strip(as_col(value).cast("string")))
    return F.when(word.isin(*ATTACK_WORDS), 1).when(word.isin(*HARMLESS_WORDS), 0).cast("byte")


def strict_binary_label(value: Column | str) -> Column:
    """As ``binary_label``, but any other word, or none, ends the job."""
    found = binary_label(value)
    return F.when(found.isNotNull(), found).otherwise(F.raise_error(F.concat(F.lit("ambiguous label: "), F.coalesce(as_col(value).cast("string"), F.lit("null")))).cast("byte"))


# Label, binary label and family of source labels, and those of all others.
LABEL_MAP = {
    "vulnerable": ("vulnerable", 1, "Software Weakness"), "non-vulnerable": ("non-vulnerable", 0, "Benign Code"), "benign": ("benign", 0, "Benign"), "malicious": ("malicious", 1, "Malicious Activity"),
    "malware": ("malware", 1, "Malware"), "phishing": ("phishing", 1, "Phishing"), "prompt_attack": ("prompt_attack", 1, "AI Security"), "abuse": ("abuse", 1, "Abuse"),
    "cti_reference": ("cti_reference", None, "Threat Intelligence"), "advisory": ("advisory", None, "Vulnerability Advisory"),
}
OTHER_LABEL = ("unknown", None, "Unknown")


def mapped_label(value: Column | str, mapping: dict[str, tuple] = LABEL_MAP, default: tuple = OTHER_LABEL) -> Column:
    """Struct (label, binary_label, attack_family) of a source label, whatever its case and blanks around."""
    make = lambda x: F.struct(F.lit(x[0]).alias("label"), F.lit(x[1]).cast("int").alias("binary_label"), F.lit(x[2]).alias("attack_family"))
    return F.coalesce(_lookup_struct({k: make(v) for k, v in mapping.items()}, F.lower(strip(as_col(value)))), make(default))


def _lookup_struct(entries: dict[str, Column], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[x for k, v in entries.items() for x in (F.lit(k), v)]), key)


def license_class(value: Column | str) -> Column:
    text = F.lower(F.coalesce(as_col(value), F.lit("")))
    return (
        F.when(text.contains("academic") | text.contains("unsw") | text.contains("cic"), "restricted_academic")
        .when(text.startswith("restricted:") | text.contains("tos") | text.contains("gpl"), "restricted_other")
        .when(text.isin("unknown", ""), "unknown")
        .otherwise("permissive")
    )
