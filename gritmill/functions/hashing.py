"""Identifiers, content keys and the four hash splits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gritmill.functions.text import as_col, squeeze


def bucket(digest: Column) -> Column:
    """The first eight hex digits as a number in [0, 1]."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967295.0)


def _ladder(value: Column, names: tuple[str, str, str], first: float, second: float) -> Column:
    return F.when(value < first, names[0]).when(value < second, names[1]).otherwise(names[2])


def _seeded(identifier: Column | str, seed: int) -> Column:
    return F.concat(F.lit(f"{seed}:"), as_col(identifier))


def unified_split(identifier: Column | str, seed: int = 42) -> Column:
    return _ladder(bucket(F.sha2(_seeded(identifier, seed), 256)), ("train", "val", "test"), 0.8, 0.8 + 0.1)


def benchmark_split(identifier: Column | str, seed: int = 42) -> Column:
    return _ladder(bucket(F.sha1(_seeded(identifier, seed))), ("train", "validation", "test"), 0.7, 0.85)


def legacy_split(identifier: Column | str) -> Column:
    return _ladder(bucket(F.sha2(as_col(identifier), 256)), ("train", "validation", "test"), 0.8, 0.9)


def sft_split(identifier: Column | str, seed: int = 42, train: float = 0.8, evaluation: float = 0.1) -> Column:
    return _ladder(bucket(F.sha1(_seeded(identifier, seed))), ("train", "eval", "test"), train, train + evaluation)


def content_key(text: Column | str) -> Column:
    """Equal for texts that differ in case and blanks only."""
    return F.sha2(squeeze(F.lower(as_col(text))), 256)


def fingerprint(*parts: Column | str) -> Column:
    """First 16 hex digits of the SHA-1 of the parts joined by ``|``."""
    return F.substring(F.sha1(F.concat_ws("|", *[F.coalesce(as_col(p), F.lit("")) for p in parts])), 1, 16)


def module_record_id(module: str, key: Column | str) -> Column:
    return F.concat(F.lit(f"{module}::"), F.substring(F.sha1(as_col(key)), 1, 16))
