"""Text expressions: whitespace, cleaning, identifiers, redaction."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode blanks; Java's own \s knows ASCII only.
WS = r"[\s\x0b\x1c-\x1f\x85\xa0  -     　]"


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip(value: Column | str) -> Column:
    return F.regexp_replace(as_col(value), f"^{WS}+|{WS}+$", "")


def squeeze(value: Column | str) -> Column:
    """Every run of blanks becomes one space, none at the ends."""
    return F.trim(F.regexp_replace(as_col(value), f"{WS}+", " "))


def clean_source(value: Column | str) -> Column:
    """Lower case, each run of other characters than a-z0-9 as one ``_``, none at the ends; empty is null."""
    slug = F.regexp_replace(F.regexp_replace(F.lower(as_col(value)), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.nullif(slug, F.lit(""))


def clean_category(value: Column | str) -> Column:
    """Case and extra blanks do not matter; empty is null."""
    return F.nullif(F.lower(squeeze(value)), F.lit(""))


def clean_split(value: Column | str) -> Column:
    """Lower case without blanks around; ``validation`` is ``val``; empty is null."""
    name = F.nullif(F.lower(strip(value)), F.lit(""))
    return F.when(name == "validation", F.lit("val")).otherwise(name)


def cve_ids(value: Column | str) -> Column:
    """Sorted distinct identifiers ``CVE-yyyy-n`` in any of the notations with other separators; never null."""
    found = F.regexp_extract_all(as_col(value), F.lit(r"(?i)(CVE[^0-9A-Za-z]{1,3}\d{4}[^0-9A-Za-z]{1,3}\d{1,19})(?![0-9])"), F.lit(1))
    tidy = F.transform(found, lambda x: F.regexp_replace(x, r"(?i)CVE[^0-9]+(\d{4})[^0-9]+(\d+)", "CVE-$1-$2"))
    return F.coalesce(F.array_sort(F.array_distinct(tidy)), F.array().cast("array<string>"))


#: Words that stand for a missing value.
NULL_WORDS = ("nan", "none", "<na>", "null")


def known(value: Column | str) -> Column:
    """Without blanks around; empty and words for null are null."""
    plain = F.regexp_replace(strip(as_col(value).cast("string")), f"(?i)^(?:{'|'.join(NULL_WORDS)})$", "")
    return F.nullif(plain, F.lit(""))


def filled(value: Column | str) -> Column:
    """Without blanks around; empty is null. Words for null stay."""
    return F.nullif(strip(as_col(value).cast("string")), F.lit(""))


def clean_text(value: Column | str) -> Column:
    """Known text on one line: NUL and every run of blanks become one space; null if nothing is left."""
    return F.nullif(squeeze(F.replace(known(value), F.lit("\x00"), F.lit(" "))), F.lit(""))


def clean_lines(value: Column | str) -> Column:
    """Text without control and unassigned characters but for line feed and tab; null if nothing is left. NFC is ``nfc``'s part."""
    return F.nullif(strip(F.regexp_replace(as_col(value), r"[\p{C}&&[^\n\t]]", "")), F.lit(""))


def nfc(value: Column | str) -> Column:
    """Composed characters; texts of ASCII only stay in the JVM."""

    @F.pandas_udf("string")
    def compose(texts: pd.Series) -> pd.Series:
        return texts.str.normalize("NFC")

    text = as_col(value)
    return F.when(text.rlike(r"^\p{ASCII}*$"), text).otherwise(compose(text))


def normalised(value: Column | str) -> Column:
    """Lower case, blanks squeezed; never null."""
    return F.coalesce(F.lower(squeeze(as_col(value).cast("string"))), F.lit(""))


def slug(value: Column | str, default: str = "unknown_source") -> Column:
    return F.coalesce(clean_source(known(value)), F.lit(default))


def tokens(value: Column | str) -> Column:
    """Distinct tokens of letters a-z, digits and ``_.:-`` of the normalised text."""
    return F.array_distinct(F.regexp_extract_all(normalised(value), F.lit(r"([a-z0-9_.:-]+)"), F.lit(1)))


def _all(value: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_extract_all(value, F.lit(pattern), F.lit(0)), F.array().cast("array<string>"))


def _with(found: Column, explicit: Column) -> Column:
    extra = F.when(explicit.isNotNull(), F.array(explicit)).otherwise(F.array().cast("array<string>"))
    return F.array_sort(F.array_union(found, extra))


def identifiers(text: Column | str, kind: str, explicit: Column | None = None) -> Column:
    """Sorted distinct identifiers of one kind in a text, with an explicit one: cve, cwe, technique or url (at most 25)."""
    pattern = {"cve": r"(?i)CVE-\d{4}-\d{3,7}", "cwe": r"(?i)CWE-\d{1,5}", "technique": r"\bT\d{4}(?:\.\d{3})?\b", "url": r"(?i)(?:https?|hxxps?)://[^\s\"'<>]+"}[kind]
    found = _all(as_col(text), pattern)
    stated = known(explicit) if explicit is not None else F.lit(None).cast("string")
    if kind == "url":
        return F.slice(_with(found, stated), 1, 25)
    return _with(F.transform(found, F.upper), F.upper(stated))


def host(url: Column | str) -> Column:
    """Lower-case host of a URL, with or without a scheme; null for what has none."""
    text = strip(url)
    rest = F.regexp_replace(text, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    authority = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    bare = F.regexp_replace(authority, r"^.*@", "")
    name = F.when(bare.startswith("["), F.regexp_extract(bare, r"^\[([^\]]*)\]", 1)).otherwise(F.regexp_replace(bare, r":[^:]*$", ""))
    return F.nullif(F.lower(name), F.lit(""))


def defang_for_log(url: Column | str) -> Column:
    """``http`` becomes ``hxxp``, ``https`` ``hxxps``, dots ``[.]``."""
    return F.replace(F.regexp_replace(url if isinstance(url, Column) else F.col(url), r"http(s?)://", "hxxp$1://"), F.lit("."), F.lit("[.]"))


# Patterns of what must not be stored.
SECRETS = (
    r"(?i)-----BEGIN (?:RSA |DSA |EC |OPENSSH )?PRIVATE KEY-----",
    r"AKIA[0-9A-Z]{16}",
    r"(?i)\b(password|passwd|secret|token|api[_-]?key)\s*[:=]\s*['\"]?[^'\"\s]{8,}",
    r"(?i)\b(?:rm\s+-rf\s+/|format\s+c:|powershell\s+-enc)\b",
)


def redact(value: Column | str) -> Column:
    text = as_col(value)
    for pattern in SECRETS:
        text = F.regexp_replace(text, pattern, "[REDACTED]")
    return text


def defang(value: Column | str) -> Column:
    """Both schemes become ``hxxp://`` and every dot ``[.]``, those of numbers too."""
    return F.replace(F.regexp_replace(as_col(value), r"(?i)\bhttps?://", "hxxp://"), F.lit("."), F.lit("[.]"))


def is_safe(value: Column | str) -> Column:
    """No secret in the text; a null is safe."""
    text = F.coalesce(as_col(value), F.lit(""))
    unsafe = F.lit(False)
    for pattern in SECRETS:
        unsafe = unsafe | text.rlike(pattern)
    return ~unsafe


def file_name(value: Column | str, default: str = "model") -> Column:
    """A name for files: runs of other characters than letters, digits, ``._-`` as one ``_``, none of ``._-`` at the ends."""
    tidy = F.regexp_replace(F.regexp_replace(strip(value), "[^A-Za-z0-9._-]+", "_"), "_+", "_")
    return F.coalesce(F.nullif(F.regexp_replace(tidy, "^[._-]+|[._-]+$", ""), F.lit("")), F.lit(default))


def ensure_safe(value: Column | str) -> Column:
    """The text, or an error that ends the job if it holds a secret."""
    text = as_col(value)
    return F.when(is_safe(text), text).otherwise(F.raise_error(F.lit("unsafe text")).cast("string"))


def json_text(value: Column | str) -> Column:
    """A JSON string of ASCII only, as hashes and stored examples need it; ``null`` for null."""
    quoted = F.to_json(F.struct(as_col(value).alias("v")))
    quoted = _inner(quoted)
    return F.when(as_col(value).isNull(), F.lit("null")).otherwise(F.when(as_col(value).rlike(r"[^\x20-\x7e]"), _ascii(quoted)).otherwise(quoted))


def _inner(document: Column) -> Column:
    """What stands between ``{"v":`` and ``}``."""
    return document.substr(F.lit(6), F.length(document) - 6)


def _ascii(text: Column) -> Column:
    unit = lambda n: F.concat(F.lit("\\u"), F.lower(F.lpad(F.hex(n.cast("long")), 4, "0")))

    def one(c: Column) -> Column:
        n = F.ascii(c)
        return F.when(n.between(0x20, 0x7E), c).when(n < 0x10000, unit(n)).otherwise(F.concat(unit(F.floor((n - 0x10000) / 1024) + 0xD800), unit((n - 0x10000) % 1024 + 0xDC00)))

    return F.array_join(F.transform(F.split(text, ""), one), "")


def truncate_middle(value: Column | str, most: int, mark: str = "\n...[truncated]...\n") -> Column:
    """Head and tail of a text longer than ``most``, with a mark between; the head gets the smaller half."""
    text = F.coalesce(as_col(value).cast("string"), F.lit(""))
    room = max(0, most - len(mark))
    head = room // 2
    return F.when(F.length(text) <= most, text).otherwise(F.concat(F.substring(text, 1, head), F.lit(mark), F.right(text, F.lit(room - head))))
