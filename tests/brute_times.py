"""Plain-Python reading of times to test against."""

import re
from datetime import UTC, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

EPOCH = datetime(1970, 1, 1, tzinfo=UTC)
ABBR = {"Z": 0, "UTC": 0, "GMT": 0, "EST": -5, "EDT": -4, "CET": 1, "CEST": 2, "JST": 9, "IST": 5.5, "AEST": 10, "AEDT": 11}
FORMS = ["%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d", "%Y/%m/%d %H:%M", "%Y.%m.%d %H:%M", "%Y%m%dT%H%M%S", "%d %b %Y %H:%M", "%d %b %Y %H:%M:%S", "%a, %d %b %Y %H:%M:%S", "%b %d, %Y %I:%M %p"]
BY_ORDER = {
    "DMY": ["%d/%m/%Y %H:%M", "%d.%m.%Y %H:%M", "%d/%m/%Y %I:%M %p"],
    "MDY": ["%m/%d/%Y %H:%M", "%m.%d.%Y %H:%M", "%m/%d/%Y %I:%M %p"],
}


def micros(t):
    return (t - EPOCH) // timedelta(microseconds=1)


def in_zone(t, zone):
    tz = ZoneInfo(zone)
    first = t.replace(tzinfo=tz, fold=0)  # the first occurrence; in a gap, the offset before the change
    return micros((t - first.utcoffset()).replace(tzinfo=UTC))


def read(value, zone="UTC", order="YMD"):
    v = (value or "").strip()
    if re.fullmatch(r"-?\d+(\.\d+)?", v):
        if v.startswith("-"):
            return -read(v[1:])
        whole, _, frac = v.partition(".")
        if int(whole) >= 10**17:
            return int(whole) // 1000
        n = int(whole)
        unit = 1_000_000 if n < 10**11 else 1000 if n < 10**14 else 1
        return n * unit + (int((frac + "000000")[:6]) if frac and unit == 1_000_000 else 0)
    v = re.sub(r"(?<=\d)t(?=\d)", "T", v)
    region = re.search(r"\[([^\]]+)\]$", v)
    v = v[: region.start()] if region else v
    own = None
    if m := re.search(r"(?<=[\d ])([+-])(\d\d):?(\d\d)$", v):
        if re.search(r"\d:\d\d", v):
            own, v = (1 if m[1] == "+" else -1) * (int(m[2]) * 60 + int(m[3])), v[: m.start()].strip()
    elif m := re.search(r"(?<=\d)\s*([A-Za-z]{1,5})$", v):
        if m[1].upper() in ABBR:
            own, v = ABBR[m[1].upper()] * 60, v[: m.start()]
    elif m := re.search(r"\s([A-Za-z]+/[A-Za-z_]+)$", v):
        zone, v = m[1], v[: m.start()]
    frac = 0
    if m := re.search(r"(?<=\d\d:\d\d)[.,](\d+)$", v):
        frac, v = int((m[1] + "000000")[:6]), v[: m.start()]
    for form in FORMS + BY_ORDER.get(order, BY_ORDER["DMY"]):
        try:
            t = datetime.strptime(v, form) + timedelta(microseconds=frac)
        except ValueError:
            continue
        return micros(t.replace(tzinfo=timezone(timedelta(minutes=own)))) if own is not None else in_zone(t, zone)
    return None
