"""Mixed timestamp notations to one UTC instant.

Values are parsed into local civil times by JVM expressions. Times with an own offset are done at once; the others meet
the offset intervals of their zone in an as-of join: two matching intervals mean an ambiguous local time, none a
nonexistent one, one gives the offset. The intervals are exploded into blocks of days, so the join is an equi-join.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import UTC, datetime, timedelta
from zoneinfo import ZoneInfo

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gritmill.functions.text import clean_source, strip
from gritmill.operators.bounded import broadcast_below

#: Hours east of UTC of zone abbreviations.
ABBREVIATIONS = {
    "Z": 0, "UTC": 0, "UT": 0, "GMT": 0, "WET": 0, "WEST": 1, "BST": 1, "CET": 1, "CEST": 2, "EET": 2, "EEST": 3, "MSK": 3,
    "IST": 5.5, "SGT": 8, "HKT": 8, "AWST": 8, "JST": 9, "KST": 9, "ACST": 9.5, "ACDT": 10.5, "AEST": 10, "AEDT": 11, "NZST": 12, "NZDT": 13,
    "AST": -4, "ADT": -3, "EST": -5, "EDT": -4, "CST": -6, "CDT": -5, "MST": -7, "MDT": -6, "PST": -8, "PDT": -7,
}
#: English month names by their first three letters.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

DAY = 86_400_000_000
BLOCK_DAYS = 512
#: Zones have no changes before the first year; the calendar and the rules of the last 400 years before the last one repeat after it.
FIRST_YEAR, LAST_YEAR = 1800, 2500
CYCLE = 146_097 * DAY
#: More feeds than that are joined by a shuffle.
MAX_BROADCAST_FEEDS = 100_000

_YEAR_FIRST = r"^(\d{4})([-/.])(\d{1,2})\2(\d{1,2})(?!\d)(.*)$"
_COMPACT = r"^(\d{4})(\d{2})(\d{2})((?:[Tt ].*)?)$"
_YEAR_LAST = r"^(\d{1,2})([-/.])(\d{1,2})\2(\d{4})(?!\d)(.*)$"
_DAY_NAME_YEAR = r"^(?:[A-Za-z]{3,9}\.?,?\s+)?(\d{1,2})(?:st|nd|rd|th)?[\s-]+([A-Za-z]{3})[a-z]*\.?,?[\s-]+(\d{4})(?!\d)(.*)$"
_NAME_DAY_YEAR = r"^(?:[A-Za-z]{3,9}\.?,?\s+)?([A-Za-z]{3})[a-z]*\.?\s+(\d{1,2})(?:st|nd|rd|th)?,?\s+(\d{4})(?!\d)(.*)$"
_REST = (
    r"^(?:(?:\s*[Tt]\s*|[\s,]+)(?:at\s+)?(\d{1,2}):?(\d{2})(?::?(\d{2})(?:[.,](\d{1,18}))?)?(?:\s*([AaPp])\.?[Mm](?![A-Za-z])\.?)?)?"
    r"\s*(?:([Zz])|(?:UTC|GMT)?([+-])(\d{2}):?(\d{2})?|([A-Za-z]{1,5})|([A-Za-z_]+(?:/[A-Za-z0-9_+-]+)+))?(?:\s*\[([^\]]*)\])?\s*$"
)
_NUMBER = r"^(-?\d{1,19})(?:\.(\d{1,18}))?$"
_ZONE_NAME = r"[A-Za-z_]+(?:/[A-Za-z0-9_+-]+)+"


def days_from_civil(year: Column, month: Column, day: Column) -> Column:
    """Days since 1970 of a Gregorian date, by integers only."""
    y = year - F.when(month <= 2, 1).otherwise(0)
    shifted = month + F.when(month > 2, -3).otherwise(9)
    whole = lambda x: F.floor(x).cast("long")
    return 365 * y + whole(y / 4) - whole(y / 100) + whole(y / 400) + whole((153 * shifted + 2) / 5) + day - 1 - 719468


def _days_in_month(year: Column, month: Column) -> Column:
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    return F.when(month == 2, F.when(leap, 29).otherwise(28)).when(month.isin(4, 6, 9, 11), 30).otherwise(31)


def split_date(text: Column, date_order: Column) -> Column:
    """Array (year, month number or name, day, rest) of ``text``; null for numbers, words and anything else."""
    fields = lambda pattern, *to: F.split(F.regexp_replace(text, pattern, "\x01".join(f"${i}" for i in to)), "\x01")
    year_last = F.when(date_order == "MDY", fields(_YEAR_LAST, 4, 1, 3, 5)).otherwise(fields(_YEAR_LAST, 4, 3, 1, 5))
    return (
        F.when(text.rlike(_NUMBER) & ~text.rlike(r"^(?:19|20)\d{6}$"), F.lit(None))
        .when(text.rlike(_YEAR_FIRST), fields(_YEAR_FIRST, 1, 3, 4, 5))
        .when(text.rlike(_COMPACT), fields(_COMPACT, 1, 2, 3, 4))
        .when(text.rlike(_YEAR_LAST), year_last)
        .when(text.rlike(_DAY_NAME_YEAR), fields(_DAY_NAME_YEAR, 3, 2, 1, 4))
        .when(text.rlike(_NAME_DAY_YEAR), fields(_NAME_DAY_YEAR, 3, 1, 2, 4))
    )


def _number(value: Column) -> Column:
    return F.nullif(value, F.lit("")).cast("long")


def with_civil(df: DataFrame, value: str, date_order: str) -> DataFrame:
    """Adds ``__gm_instant``, ``__gm_local`` and ``__gm_zone``, step by step so that each regular expression runs once."""
    df = df.withColumn("__gm_text", strip(value)).withColumn("__gm_date", split_date(F.col("__gm_text"), F.col(date_order)))
    rest = F.get("__gm_date", F.lit(3))
    df = df.withColumn("__gm_rest", F.when(rest.rlike(_REST), F.split(F.regexp_replace(rest, _REST, "\x01".join(f"${i}" for i in range(1, 13))), "\x01")))
    part = lambda i: F.get("__gm_rest", F.lit(i))
    month_text = F.lower(F.get("__gm_date", F.lit(1)))
    month = F.when(month_text.rlike(r"^\d+$"), F.when(month_text.rlike(r"^\d+$"), month_text).cast("long")).otherwise(
        F.nullif(F.array_position(F.array(*[F.lit(m) for m in MONTHS]), month_text), F.lit(0))
    )
    df = df.withColumns({"__gm_y": F.get("__gm_date", F.lit(0)).cast("long"), "__gm_m": month, "__gm_d": F.get("__gm_date", F.lit(2)).cast("long")})
    hour, half = _number(part(0)), F.lower(part(4))
    df = df.withColumns(
        {
            "__gm_h": F.when(half == "", F.coalesce(hour, F.lit(0))).when(hour.between(1, 12), hour % 12 + F.when(half == "p", 12).otherwise(0)),
            "__gm_mi": F.coalesce(_number(part(1)), F.lit(0)),
            "__gm_s": F.coalesce(_number(part(2)), F.lit(0)),
            "__gm_us": F.coalesce(F.rpad(F.substring(F.nullif(part(3), F.lit("")), 1, 6), 6, "0").cast("long"), F.lit(0)),
        }
    )
    y, m, d, h, mi, s = (F.col(f"__gm_{x}") for x in ("y", "m", "d", "h", "mi", "s"))
    valid = F.col("__gm_rest").isNotNull() & y.between(1, 9999) & m.between(1, 12) & (d >= 1) & (d <= _days_in_month(y, m)) & h.between(0, 23) & (mi <= 59) & (s <= 59)
    local = F.when(valid, days_from_civil(y, m, d) * DAY + ((h * 60 + mi) * 60 + s) * 1_000_000 + F.col("__gm_us"))
    names = F.create_map(*[F.lit(x) for k, v in ABBREVIATIONS.items() for x in (k, int(v * 3600))])
    sign = F.when(part(6) == "-", -1).otherwise(1)
    offset = (
        F.when(part(5) != "", 0)
        .when(part(6) != "", sign * (_number(part(7)) * 3600 + F.coalesce(_number(part(8)), F.lit(0)) * 60))
        .when(part(9) != "", F.try_element_at(names, F.upper(part(9))))
    )
    df = df.withColumns({"__gm_local": local, "__gm_offset": offset, "__gm_abbr": part(9), "__gm_zone": F.coalesce(F.nullif(part(10), F.lit("")), F.nullif(part(11), F.lit("")))})
    whole, digits = F.regexp_extract("__gm_text", _NUMBER, 1), F.regexp_extract("__gm_text", _NUMBER, 2)
    # the fraction continues the whole number's unit; what is finer than a microsecond is cut
    df = df.withColumn("__gm_number", F.when(F.col("__gm_text").rlike(_NUMBER) & F.col("__gm_date").isNull(), whole.try_cast("long")))
    number = F.col("__gm_number")
    size = F.abs(number)
    places = F.when(size < 100_000_000_000, 6).when(size < 100_000_000_000_000, 3).otherwise(0)
    fraction = F.coalesce(F.nullif(F.substring(F.rpad(digits, 6, "0"), F.lit(1), places), F.lit("")).cast("long"), F.lit(0))
    # from 17 digits on they are nanoseconds, rounded down like any finer digits
    micros = F.when(size >= 100_000_000_000_000_000, F.expr("__gm_number div 1000 - if(__gm_number % 1000 < 0, 1, 0)")).otherwise(number * F.when(places == 6, 1_000_000).when(places == 3, 1_000).otherwise(1))
    epoch = micros + F.when(whole.startswith("-"), -fraction).otherwise(fraction)
    unknown_word = (F.col("__gm_abbr") != "") & F.col("__gm_offset").isNull()
    df = df.withColumns(
        {
            "__gm_instant": F.coalesce(epoch, F.col("__gm_local") - F.col("__gm_offset") * 1_000_000),
            "__gm_local": F.when(F.col("__gm_offset").isNull() & ~F.coalesce(unknown_word, F.lit(False)), F.col("__gm_local")),
        }
    )
    return df.drop(*[f"__gm_{x}" for x in ("text", "date", "rest", "y", "m", "d", "h", "mi", "s", "us", "offset", "abbr", "number")])


def offset_changes(zone: str) -> list[tuple[int, int]]:
    """(first second since 1970, offset in seconds) of each period of one offset, from FIRST_YEAR to LAST_YEAR."""
    tz = ZoneInfo(zone)
    offset = lambda t: int(datetime.fromtimestamp(t, UTC).astimezone(tz).utcoffset().total_seconds())
    start, end = (int(datetime(y, 1, 1, tzinfo=UTC).timestamp()) for y in (FIRST_YEAR, LAST_YEAR))
    periods, step = [(start, offset(start))], int(timedelta(days=7).total_seconds())
    for low in range(start, end, step):
        high = low + step
        if offset(high) == periods[-1][1]:
            continue
        lo, hi = low, high
        while hi - lo > 1:
            mid = (lo + hi) // 2
            lo, hi = (mid, hi) if offset(mid) == periods[-1][1] else (lo, mid)
        periods.append((hi, offset(hi)))
    return periods


def local_intervals(zone: str) -> list[tuple[int, int, int, bool]]:
    """(first local second, end, offset, is a gap). Gaps carry the offset before the change; the ends are open."""
    periods, out, far = offset_changes(zone), [], 1 << 40
    for i, (start, offset) in enumerate(periods):
        last = i + 1 == len(periods)
        end = far if last else periods[i + 1][0] + offset
        out.append((-far if i == 0 else start + offset, end, offset, False))
        if not last and periods[i + 1][1] > offset:
            out.append((end, periods[i + 1][0] + periods[i + 1][1], offset, True))
    return out


def _block(seconds: int) -> int:
    low, high = (int(datetime(y, 1, 1, tzinfo=UTC).timestamp()) // 86400 // BLOCK_DAYS for y in (FIRST_YEAR, LAST_YEAR))
    return min(max(seconds // 86400 // BLOCK_DAYS, low), high)


def _explode_zones(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for zone in batch["zone"]:
            try:
                intervals = local_intervals(zone)
            except (KeyError, ValueError, OSError):  # no zone of this name
                continue
            for start, end, offset, gap in intervals:
                rows += [(zone, b, start * 1_000_000, end * 1_000_000, offset * 1_000_000, gap) for b in range(_block(start), _block(end - 1) + 1)]
        yield pd.DataFrame(rows, columns=["zone", "block", "from_local", "to_local", "offset", "gap"])


def zone_intervals(zones: DataFrame) -> DataFrame:
    """Exploded offset intervals of the names in ``zones.zone``; names that are no zone have no rows.

    At most about 600 names exist, each with 500 blocks of a few spans: under 400,000 blocks whatever the data.
    """
    return zones.mapInPandas(_explode_zones, "zone string, block long, from_local long, to_local long, offset long, gap boolean")


def normalise_timestamps(df: DataFrame, value: str, source: str, feeds: DataFrame) -> DataFrame:
    """Adds ``utc_micros`` (microseconds since 1970) and ``time_status`` to every row of ``df``.

    ``feeds`` has source_id, zone, date_order: what a source without own zone means; other sources write UTC and year first.
    time_status: ``exact``, ``ambiguous`` (clock time that occurs twice: its first occurrence is taken), ``nonexistent`` (read with
    the offset before the change) or ``none`` (null, blank, words, impossible dates: utc_micros is null). Rows are neither lost nor
    repeated; ties cannot arise. Existing columns utc_micros and time_status are replaced; names with ``__gm_`` are reserved.
    """
    columns = [c for c in df.columns if c not in ("utc_micros", "time_status")]
    known = feeds.select(clean_source("source_id").alias("__gm_source"), F.struct("zone", "date_order").alias("__gm_feed")).where("__gm_source is not null")
    known = broadcast_below(known.groupBy("__gm_source").agg(F.min("__gm_feed").alias("__gm_feed")), MAX_BROADCAST_FEEDS)
    rows = df.select(*columns).withColumn("__gm_source", clean_source(source)).join(known, "__gm_source", "left")
    rows = rows.withColumn("__gm_order", F.coalesce(F.col("__gm_feed.date_order"), F.lit("YMD")))
    named = df.select(F.regexp_extract(value, _ZONE_NAME, 0).alias("zone")).where("zone <> ''").union(feeds.select("zone")).where("zone is not null").distinct()
    intervals = F.broadcast(zone_intervals(named)).withColumnRenamed("zone", "__gm_zone").withColumnRenamed("block", "__gm_block")
    rows = with_civil(rows, value, "__gm_order").withColumn("__gm_zone", F.coalesce("__gm_zone", F.col("__gm_feed.zone"), F.lit("UTC")))
    low, high = _block(-(1 << 40)), _block(1 << 40)
    # a local time after the last year has the offset of the same day whole cycles before
    last = int(datetime(LAST_YEAR, 1, 1, tzinfo=UTC).timestamp()) * 1_000_000
    rows = rows.withColumn("__gm_at", F.col("__gm_local") - F.greatest(F.ceil((F.col("__gm_local") - last) / CYCLE), F.lit(0)) * CYCLE)
    block = F.least(F.greatest(F.floor(F.col("__gm_at") / (DAY * BLOCK_DAYS)).cast("long"), F.lit(low)), F.lit(high))
    is_utc = F.col("__gm_zone") == "UTC"
    rows = rows.withColumn("__gm_block", F.when(~is_utc & F.col("__gm_local").isNotNull(), block))
    # one row per (zone, block) with all its intervals: a row of the data meets one row, so none is repeated
    packed = intervals.groupBy("__gm_zone", "__gm_block").agg(F.sort_array(F.collect_list(F.struct("from_local", "to_local", "offset", "gap"))).alias("__gm_spans"))
    rows = rows.join(F.broadcast(packed), ["__gm_zone", "__gm_block"], "left")
    rows = rows.withColumn("__gm_hits", F.filter("__gm_spans", lambda x: (x.from_local <= F.col("__gm_at")) & (F.col("__gm_at") < x.to_local)))
    rows = rows.withColumn("__gm_first", F.array_max(F.transform("__gm_hits", lambda x: x.offset)))
    utc = F.coalesce("__gm_instant", F.when(is_utc, F.col("__gm_local")).otherwise(F.col("__gm_local") - F.col("__gm_first")))
    status = (
        F.when(utc.isNull(), "none")
        .when(F.col("__gm_instant").isNotNull() | is_utc, "exact")
        .when(F.size("__gm_hits") > 1, "ambiguous")
        .when(F.get("__gm_hits", F.lit(0)).gap, "nonexistent")
        .otherwise("exact")
    )
    return rows.select(*columns, utc.alias("utc_micros"), status.alias("time_status"))


#: The one form that needs no work.
PLAIN_UTC = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\+00:00$"


def feed_times(silver: DataFrame, gold: DataFrame) -> DataFrame:
    """table_name, record_id, source and value of both tables' times."""
    return silver.select(F.lit("silver_records").alias("table_name"), "record_id", F.col("source_dataset").alias("source"), F.col("timestamp").alias("value")).unionByName(
        gold.select(F.lit("gold_unified").alias("table_name"), "record_id", F.col("source_id").alias("source"), F.col("collected_at").alias("value"))
    )
