"""Feeds over HTTP: a polite client with an injected transport, the feed adapters, and bronze folders."""

from __future__ import annotations

import hashlib
import json
import os
import time
import urllib.robotparser
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gritmill.operators.nested import as_list, member
from gritmill.sources.readers import scalar

#: (url, body, headers, timeout) -> (status, text)
Transport = Callable[[str, bytes | None, dict, float], tuple[int, str]]


class HttpError(RuntimeError):
    pass


@dataclass
class Client:
    """Retries with doubling waits, a pause between requests, a disk cache by URL and body, and robots.txt (open if unreadable)."""

    transport: Transport
    cache: str | None = None
    ttl: float = 86_400
    retries: int = 3
    backoff: float = 0.5
    pause: float = 0.0
    timeout: float = 30
    agent: str = "gritmill"
    sleep: Callable[[float], None] = time.sleep
    clock: Callable[[], float] = time.time
    _last: float = field(default=0.0, init=False)
    _robots: dict = field(default_factory=dict, init=False)

    def fetch(self, url: str, body: bytes | None = None, headers: dict | None = None) -> str:
        path = os.path.join(self.cache, hashlib.sha256(f"{url}|{(body or b'').decode('utf-8', 'replace')}".encode()).hexdigest()) if self.cache else None
        if path and os.path.exists(path) and self.clock() - os.path.getmtime(path) < self.ttl:
            with open(path, encoding="utf-8") as file:
                return file.read()
        problem = ""
        for attempt in range(self.retries + 1):
            if attempt:
                self.sleep(self.backoff * 2 ** (attempt - 1))
            wait = self._last + self.pause - self.clock()
            if self._last and wait > 0:
                self.sleep(wait)
            self._last = self.clock()
            try:
                status, text = self.transport(url, body, headers or {}, self.timeout)
            except OSError as error:
                problem = str(error)
                continue
            if status == 200:
                if path:
                    os.makedirs(self.cache, exist_ok=True)
                    with open(f"{path}.tmp", "w", encoding="utf-8") as file:
                        file.write(text)
                    os.replace(f"{path}.tmp", path)
                return text
            problem = f"status {status}"
            if status < 500 and status != 429:
                break
        raise HttpError(f"{url}: {problem}")

    def allowed(self, url: str) -> bool:
        root = "/".join(url.split("/")[:3])
        if root not in self._robots:
            parser = urllib.robotparser.RobotFileParser()
            try:
                parser.parse(self.fetch(f"{root}/robots.txt").splitlines())
            except HttpError:
                parser = None
            self._robots[root] = parser
        return self._robots[root] is None or self._robots[root].can_fetch(self.agent, url)


@dataclass(frozen=True)
class Feed:
    source_id: str
    url: str
    license: str
    #: One request's body, if it is a POST.
    body: bytes | None
    #: Documents (file, v) to the rows of the feed.
    parse: Callable[[DataFrame], DataFrame]


def kev_rows(d: DataFrame) -> DataFrame:
    v = F.explode(as_list(F.coalesce(member(F.col("v"), "vulnerabilities"), F.col("v")))).alias("v")
    names = ("cveID", "vendorProject", "product", "vulnerabilityName", "dateAdded", "shortDescription", "requiredAction", "dueDate", "knownRansomwareCampaignUse")
    return d.select(v).select(*[scalar(F.col("v"), n).alias(n) for n in names])


def nvd_rows(d: DataFrame) -> DataFrame:
    rows = d.select(F.explode(as_list(member(F.col("v"), "vulnerabilities"))).alias("x")).select(member(F.col("x"), "cve").alias("c"))
    c = F.col("c")
    described = as_list(member(c, "descriptions"))
    english = F.coalesce(F.get(F.filter(described, lambda x: scalar(x, "lang") == "en"), F.lit(0)), F.get(described, F.lit(0)))
    metric = lambda k: F.get(as_list(member(member(c, "metrics"), k)), F.lit(0))
    named = [x for k in ("cvssMetricV31", "cvssMetricV30", "cvssMetricV2") for x in (scalar(metric(k), "cvssData", "baseSeverity"), scalar(metric(k), "baseSeverity"))]
    weak = F.flatten(F.transform(as_list(member(c, "weaknesses")), lambda w: F.transform(as_list(member(w, "description")), lambda x: scalar(x, "value"))))
    return rows.select(
        scalar(c, "id").alias("cve_id"), scalar(c, "published").alias("published"), scalar(c, "lastModified").alias("last_modified"), scalar(c, "vulnStatus").alias("vuln_status"),
        scalar(english, "value").alias("description"), F.coalesce(*named).alias("severity"), F.array_distinct(F.filter(weak, lambda x: x.isNotNull())).alias("weaknesses"),
    )


def osv_rows(d: DataFrame) -> DataFrame:
    v = F.col("v")
    rows = d.select(F.explode(as_list(F.coalesce(member(v, "vulns"), v))).alias("v"))
    alias = F.get(F.filter(F.transform(as_list(member(v, "aliases")), lambda x: scalar(x)), lambda x: F.upper(x).startswith("CVE-")), F.lit(0))
    return rows.select(scalar(v, "id").alias("osv_id"), alias.alias("cve_id"), scalar(v, "summary").alias("summary"), scalar(v, "modified").alias("modified"))


FEEDS = {
    f.source_id: f
    for f in (
        Feed("cisa_kev", "https://www.cisa.gov/sites/default/files/feeds/known_exploited_vulnerabilities.json", "CC0-1.0", None, kev_rows),
        Feed("nvd_cve", "https://services.nvd.nist.gov/rest/json/cves/2.0?resultsPerPage=2000&startIndex=0", "NVD-Public-Domain", None, nvd_rows),
        Feed("osv", "https://api.osv.dev/v1/query", "CC-BY-4.0", b"{}", osv_rows),
    )
}


def fetch_feeds(spark: SparkSession, client: Client, names: list[str], out: str, most: int | None = None, today: date | None = None) -> dict:
    """Fetches feeds to ``out/source_id=.../date=.../`` as JSON lines; errors of one feed are reported and don't stop the others."""
    totals, errors = {}, {}
    for name in names:
        feed = FEEDS[name]
        try:
            if not client.allowed(feed.url):
                raise HttpError(f"{feed.url}: robots.txt forbids it")
            text = client.fetch(feed.url, feed.body)
            json.loads(text)
            d = spark.createDataFrame([(feed.url, text)], "file string, t string").select("file", F.parse_json("t").alias("v"))
            rows = feed.parse(d)
            rows = rows if most is None else rows.limit(most)
            rows = rows.select(F.lit(name).alias("source_id"), F.lit(feed.url).alias("source_url"), F.lit(feed.license).alias("license_note"), F.lit((today or date.today()).isoformat()).alias("date"), F.struct("*").alias("raw"))
            rows.write.mode("append").partitionBy("source_id", "date").option("ignoreNullFields", False).json(f"{out}/{name}")
            totals[name] = rows.count()
            meta = {"source_id": name, "source_url": feed.url, "license_note": feed.license, "rows": totals[name], "date": (today or date.today()).isoformat()}
            spark.createDataFrame([(json.dumps(meta, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{out}/{name}_metadata")
        except (HttpError, ValueError, KeyError, OSError) as error:
            errors[name] = str(error)
    return {"totals": totals, "errors": errors}


def months(first: date, last: date) -> list[tuple[date, date]]:
    """Month by month, the ends included."""
    out, at = [], first
    while at <= last:
        following = (at.replace(day=1) + timedelta(days=32)).replace(day=1)
        out.append((at, min(last, following - timedelta(days=1))))
        at = following
    return out


def fetch_pages(client: Client, url: str, first: date, last: date, page: int = 2000) -> Iterator[str]:
    """The pages of a paged feed, month by month, one at a time."""
    for a, b in months(first, last):
        start, total = 0, 1
        while start < total:
            text = client.fetch(f"{url}?pubStartDate={a}T00:00:00.000&pubEndDate={b}T23:59:59.999&resultsPerPage={page}&startIndex={start}")
            total = json.loads(text).get("totalResults", 0)
            yield text
            start += page


def store_pages(spark: SparkSession, pages: Iterator[str], out: str, at_once: int = 20) -> int:
    """Writes the items of pages as JSON lines below ``out``, some pages at a time, so the driver never holds a whole feed. Returns the items."""
    total, block = 0, []

    def flush() -> int:
        rows = spark.createDataFrame([(t,) for t in block], "t string").select(F.explode(as_list(member(F.parse_json("t"), "vulnerabilities"))).alias("v")).select(F.to_json("v").alias("value"))
        rows.write.mode("append").text(out)
        n = sum(len(json.loads(t).get("vulnerabilities") or []) for t in block)
        block.clear()
        return n

    for text in pages:
        block.append(text)
        if len(block) == at_once:
            total += flush()
    return total + (flush() if block else 0)
