"""Crawl planning on ledgers: url filters, discovery, fetch and extraction queues, host strategies, recorded attempts."""

from __future__ import annotations

import hashlib
import re
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import text as T
from ..session import spread

#: Order in which request profiles are tried (fixed value).
PROFILES = ("bingbot", "googlebot", "desktop-chrome", "desktop-firefox", "desktop-safari", "mobile-safari")


def filter_urls(urls: DataFrame, sources: DataFrame) -> DataFrame:
    """Distinct urls (vendor, url, ...) that match any include pattern of their vendor, or if it has none, and no exclude pattern.

    sources: vendor, url_patterns, exclude_patterns; a configuration of a few rows, whose patterns become part of the plan, so that
    each is compiled once. Patterns are looked for anywhere in the url; vendors that are not configured give nothing."""
    hit = lambda patterns: F.col("url").rlike("|".join(f"(?:{p})" for p in patterns))
    wanted = F.lit(False)
    for s in sources.select("vendor", "url_patterns", "exclude_patterns").collect():  # a configuration file
        mine = F.col("vendor") == s["vendor"]
        if s["url_patterns"]:
            mine = mine & hit(s["url_patterns"])
        if s["exclude_patterns"]:
            mine = mine & ~hit(s["exclude_patterns"])
        wanted = wanted | mine
    return urls.where(wanted).dropDuplicates(["vendor", "url"])


def new_urls(found: DataFrame, ledger: DataFrame) -> DataFrame:
    """found rows whose url the ledger lacks."""
    return found.join(ledger.select("url"), "url", "left_anti")


def newest_first(lastmod: Column) -> list[Column]:
    """Known dates first, the latest before others; an empty text is known but lowest."""
    return [lastmod.isNotNull().desc(), lastmod.desc_nulls_last()]


def discovery_batch(found: DataFrame, ledger: DataFrame, limit_per_vendor: int | None = None, limit_before: bool = False) -> DataFrame:
    """New urls per vendor, newest first up to a limit; limit_before: known urls use up the limit too."""
    rank = F.row_number().over(Window.partitionBy("vendor").orderBy(*newest_first(F.col("lastmod")), "url"))
    rows = found.dropDuplicates(["url"])
    if limit_per_vendor is None:
        return new_urls(rows, ledger)
    if limit_before:
        return new_urls(rows.withColumn("_r", rank).where(F.col("_r") <= limit_per_vendor).drop("_r"), ledger)
    return new_urls(rows, ledger).withColumn("_r", rank).where(F.col("_r") <= limit_per_vendor).drop("_r")


def latest_attempts(manifest: DataFrame, order: Column) -> DataFrame:
    """Per url its last attempt by the given order. Rows without url are left out; one shuffle with partial aggregates."""
    others = [c for c in manifest.columns if c != "url"]
    last = manifest.where("url is not null").withColumn("_o", order).groupBy("url").agg(F.max_by(F.struct(*others), "_o").alias("r"))
    return last.select("url", "r.*")


def is_done() -> Column:
    """An attempt whose page is there: status 200 and no error."""
    return (F.col("status") == 200) & (F.coalesce("error", F.lit("")) == "")


def fetch_queue(discovered: DataFrame, latest: DataFrame, vendor: str | None = None, since: str | None = None, refresh: bool = False) -> DataFrame:
    """Discovered rows to fetch, not made distinct: with url and vendor, not older than since where dated, not done unless refresh."""
    rows = discovered.where("coalesce(url, '') <> '' and coalesce(vendor, '') <> ''")
    if vendor:
        rows = rows.where(F.lower("vendor") == vendor.lower())
    if since:
        rows = rows.where((F.coalesce("lastmod", F.lit("")) == "") | (F.col("lastmod") >= since))
    if not refresh:
        rows = rows.join(latest.where(is_done()).select("url"), "url", "left_anti")
    return rows


def queue_counts(discovered: DataFrame, queue: DataFrame) -> DataFrame:
    """One row: discovered, queued, skipped."""
    d, q = discovered.agg(F.count("*").alias("discovered")), queue.agg(F.count("*").alias("queued"))
    return d.join(F.broadcast(q)).withColumn("skipped", F.col("discovered") - F.col("queued"))  # one row each


def extract_queue(latest: DataFrame, lastmods: DataFrame, extracted: DataFrame) -> DataFrame:
    """Latest attempts with a stored page whose url no record has as source, with their lastmod (null where unlisted)."""
    rows = latest.where("status = 200 and coalesce(raw_path, '') <> ''").join(extracted.select(F.col("source_url").alias("url")), "url", "left_anti")
    return rows.join(lastmods.select("url", "lastmod"), "url", "left")


#: The instruction that a bundle's prompt puts around a page (fixed value).
PROMPT = """You are an extraction agent. Follow the SKILL below exactly and return a single strict JSON object — no markdown fences, no prose.

=== SKILL.md ===
{skill}

=== TAXONOMY (taxonomy.json) ===
{taxonomy}

=== SOURCE URL ===
{source_url}

=== PAGE TITLE ===
{title}

=== PAGE TEXT ===
{body}

Return one JSON object matching the schema in SKILL.md. No other output.
"""
TEXT_LIMIT = 18_000


def full_bundles(queue: DataFrame, content: DataFrame, skill: str, taxonomy: str, least: int = 8, backgrounds: bool = True, embedded: bool = False, done: DataFrame | None = None) -> DataFrame:
    """The thirteen fields of an extraction bundle: vendor, source_url, sha256, title, raw_path, content_type, retrieval_source,
    profile, extraction_method, related_images, published_date, prompt, created_at; one per vendor and digest.

    queue: extract_queue with all columns of the manifest; content: raw_path, body. Attempts without stored content give none.
    done: vendor, sha256 of bundles that are there already and are skipped. One pass over a page gives its text and images."""
    picked = bundle(queue).select("vendor", "url", "sha256", "raw_path").join(queue.drop("vendor", "sha256", "raw_path"), "url")
    if done is not None:
        picked = picked.join(done.select("vendor", "sha256"), ["vendor", "sha256"], "left_anti")
    rows = spread(picked.join(content.select("raw_path", "body"), "raw_path"))
    text = H.page_text(F.col("body"), F.col("content_type"))
    found = H.related_images(F.col("body"), F.col("content_type"), F.coalesce(F.nullif("final_url", F.lit("")), "url"), least, backgrounds, embedded)
    parsed = rows.withColumns({"_text": text, "related_images": found})
    prompt = T.filled_template(PROMPT, skill=F.lit(skill.strip()), taxonomy=F.lit(taxonomy.strip()), source_url=F.col("url"), title=T.titled(F.col("_text.title")), body=T.truncated(F.col("_text.text"), TEXT_LIMIT))
    return parsed.select(
        "vendor", F.col("url").alias("source_url"), "sha256", "_text.title", "raw_path", "content_type", "retrieval_source", "profile", F.col("_text.method").alias("extraction_method"),
        "related_images", F.col("lastmod").alias("published_date"), prompt.alias("prompt"), T.utc_now().alias("created_at"),
    )


def bundle(queue: DataFrame) -> DataFrame:
    """The columns of an extraction bundle without its text: one per vendor and digest, the first url by alphabet."""
    w = Window.partitionBy("vendor", "sha256").orderBy("url")
    rows = queue.withColumn("_n", F.row_number().over(w)).where("_n = 1")
    return rows.select(F.col("vendor"), T.slugify(F.col("vendor")).alias("vendor_slug"), "url", "sha256", "raw_path", "content_type", "fetched_at", F.col("lastmod").alias("published_date"))


def host_keys(url: Column) -> Column:
    """Keys under which a host's strategy is looked up, in order: the host, the host with www toggled, its domain."""
    h = T.host(url)
    return F.filter(F.array(h, T.www_toggled(h), T.registrable_domain(h)), lambda k: k.isNotNull() & (k != ""))


def host_strategies(urls: DataFrame, strategies: DataFrame) -> DataFrame:
    """url, host_key, strategy, kind: each url's strategy by the first key that has one; urls without any keep nulls.

    strategies: host, strategy, kind."""
    keys = urls.select("url").distinct().select("url", F.posexplode(host_keys(F.col("url"))).alias("priority", "host"))
    best = keys.join(strategies, "host").groupBy("url").agg(F.min_by(F.struct(F.col("host").alias("host_key"), "strategy", "kind"), "priority").alias("s")).select("url", "s.*")
    return urls.select("url").distinct().join(best, "url", "left")


def attempt_plan(planned: DataFrame, year: int) -> DataFrame:
    """url, attempts: what to try in order. A known strategy takes the place of the plain attempt; then all profiles, the reader
    service and the archive; nothing twice.

    planned: url, strategy, kind (null: none known)."""
    url = F.col("url")
    attempt = lambda u, profile, source: F.struct(u.alias("url"), profile.alias("profile"), F.lit(source).alias("source"))
    reader, archive = attempt(T.reader_url(url), F.lit("default"), "reader"), attempt(T.archive_url(url, F.lit(year)), F.lit("default"), "wayback")
    known = (
        F.when((F.col("kind") == "origin") & F.col("strategy").isin(*PROFILES), attempt(url, F.col("strategy"), "origin"))
        .when(F.col("kind") == "reader", reader).when(F.col("kind") == "wayback", archive).otherwise(attempt(url, F.lit("default"), "origin"))
    )
    return planned.select("url", F.array_distinct(F.array(known, *[attempt(url, F.lit(p), "origin") for p in PROFILES], reader, archive)).alias("attempts"))


def outcome(attempts: DataFrame) -> DataFrame:
    """url, attempt_no, outcome of recorded attempts (url, attempt_no, status, body, transport_error), folded as a fetch would:

    a transport error or a block leads to the next attempt, a success or any other failure ends it. outcome: ok, failed (ended
    by a failure) or exhausted (nothing left to try; the last attempt counts)."""
    blocked = T.looks_blocked(F.col("status"), F.col("body"))
    ok = T.fetch_succeeded(F.col("status"), F.col("body")) & F.col("transport_error").isNull()
    ends = F.col("transport_error").isNull() & ~blocked
    tried = attempts.select("url", "attempt_no", F.when(ok, "ok").when(ends, "failed").otherwise("next").alias("o"))
    stop = F.min(F.when(F.col("o") != "next", F.struct("attempt_no", "o")))
    return tried.groupBy("url").agg(stop.alias("s"), F.max("attempt_no").alias("last")).select("url", F.coalesce("s.attempt_no", "last").alias("attempt_no"), F.coalesce("s.o", F.lit("exhausted")).alias("outcome"))


def probe(attempts: DataFrame) -> DataFrame:
    """host, url, strategy, kind of the first recorded attempt that worked with a body; one row per url, nulls if none did."""
    ok = T.fetch_succeeded(F.col("status"), F.col("body")) & F.col("transport_error").isNull() & (F.coalesce("body", F.lit("")) != "")
    label = F.when(F.col("source") == "origin", F.col("profile")).otherwise(F.col("source"))
    first = F.min(F.when(ok, F.struct("attempt_no", label.alias("strategy"), F.col("source").alias("kind"))))
    return attempts.groupBy("url").agg(first.alias("s")).select(T.host(F.col("url")).alias("host"), "url", "s.strategy", "s.kind")


FETCHED = "url string, status int, body binary, content_type string, sha256 string, from_cache boolean, final_url string, retrieval_source string, profile string, error string"


def tried(url: str, attempts: list, transport, wait=lambda url: None) -> tuple:
    """The row of FETCHED that trying a url's attempts in order ends with; transport: (url, profile) -> (status, bytes, content
    type, final url). Blocked answers and errors of the transport lead to the next attempt, other failures end it."""
    failed = "RuntimeError: nothing to try"
    for a in attempts:
        wait(a["url"])
        try:
            status, body, kind, final = transport(a["url"], a["profile"])
        except Exception as e:  # noqa: BLE001 - an attempt that fails leads to the next
            failed = f"{type(e).__name__}: {e}"
            continue
        blocked = T.is_blocked(status, body)
        if 200 <= status < 400 and not blocked:
            return (url, status, body, kind, hashlib.sha256(body).hexdigest(), False, final or a["url"], a["source"], a["profile"], None)
        if blocked:
            failed = f"PermissionError: blocked response while fetching {url} via {a['source']}/{a['profile']}: status {status}"
        else:
            failed = f"HTTPError: HTTP Error {status}: HTTP status {status}"
            if status >= 400:
                break
    return (url, 0, None, None, None, False, None, None, None, failed)


def fetch_with(planned: DataFrame, transport, delay_seconds: float = 1.0, partitions: int | None = None) -> DataFrame:
    """The columns of FETCHED, one row per url, of trying each url's plan (url, attempts: see attempt_plan) with a transport.

    A host's urls are fetched by one task with a pause between requests to one host: being polite to a host is what bounds it.
    The transport is given by the caller; tests use a recorded one."""

    def run(batches):
        import time

        import pandas as pd

        last: dict[str, float] = {}

        def wait(url: str) -> None:
            host = urlsplit(url).netloc
            left = last.get(host, -1e9) + delay_seconds - time.monotonic()
            if left > 0:
                time.sleep(left)
            last[host] = time.monotonic()

        for pdf in batches:
            rows = [tried(url, attempts, transport, wait) for url, attempts in zip(pdf["url"], pdf["attempts"])]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in FETCHED.split(", ")])

    hosted = planned.select("url", "attempts", T.host(F.col("url")).alias("host")).dropDuplicates(["url"])
    return (hosted.repartition(partitions, "host") if partitions else hosted.repartition("host")).mapInPandas(run, FETCHED)


def manifest_rows(queue: DataFrame, fetched: DataFrame, root: str, now: Column | None = None) -> DataFrame:
    """Manifest rows of a fetch: the queue's vendor and url with what came of it; a success with an empty body is a failure.

    Content is named by its digest below root; a failed attempt has status 0, its error and no content."""
    rows = queue.select("vendor", "url").join(fetched, "url")
    ok = F.col("error").isNull() & (F.coalesce(F.length("body"), F.lit(0)) > 0)
    path = F.concat(F.lit(root.rstrip("/") + "/"), T.slugify(F.col("vendor")), F.lit("/"), F.col("sha256"), T.raw_suffix(F.col("content_type")))
    kept = {c: F.when(ok, F.col(c)) for c in ("sha256", "content_type", "final_url", "retrieval_source", "profile")}
    return rows.select(
        "vendor", "url", F.when(ok, path).alias("raw_path"), F.when(ok, F.col("status")).otherwise(0).alias("status"), kept["sha256"].alias("sha256"), kept["content_type"].alias("content_type"),
        (T.utc_now() if now is None else now).alias("fetched_at"), F.col("from_cache"), F.when(~ok, F.coalesce("error", F.lit("ValueError: empty response body"))).alias("error"),
        *[kept[c].alias(c) for c in ("final_url", "retrieval_source", "profile")],
    )


def caching(transport, read, write):
    """A transport (url -> (status, bytes, content type)) that answers from a cache where it can: read(key) gives bytes or None,
    write(key, bytes) keeps them; key: SHA-256 of the url. Only answers of the origin are kept, not those of a reader or archive."""

    def get(url: str) -> tuple:
        key = hashlib.sha256(url.encode()).hexdigest()
        body = read(key)
        if body is not None:
            return 200, body, "application/octet-stream"
        status, body, kind, *source = transport(url)
        if 200 <= status < 400 and not T.is_blocked(status, body) and (source or ["origin"])[0] == "origin":
            write(key, body)
        return status, body, kind

    return get


def cached(urls: DataFrame, cache: DataFrame) -> DataFrame:
    """urls (url) with what a cache keyed by the SHA-256 of the address (key, body) holds for them.

    A hit counts as status 200 of unknown type; a miss keeps nulls and from_cache false."""
    hit = urls.withColumn("key", F.sha2("url", 256)).join(cache.select("key", "body"), "key", "left").drop("key")
    there = F.col("body").isNotNull()
    return hit.select(*hit.columns, F.when(there, 200).alias("status"), F.when(there, "application/octet-stream").alias("content_type"), there.alias("from_cache"))


def walk_sitemaps(roots: list[str], transport, wanted=lambda url: True, most: int = 20, enough: int | None = None) -> list[tuple[str, str | None]]:
    """(url, lastmod) found breadth first from sitemaps on the driver: one site's index, not a data set.

    Only sitemaps that could be read count towards `most`; the walk ends early once `enough` wanted pages are found, and known
    pages count as found. transport: url -> (status, bytes, content type); its errors are passed over."""
    from ..functions.html import sitemap

    queue, seen, read, found = list(roots), set(roots), 0, []
    while queue and read < most and (enough is None or len(found) < enough):
        try:
            status, body, _ = transport(queue.pop(0))
        except Exception:  # noqa: BLE001 - a sitemap that can't be had is passed over
            continue
        if not 200 <= status < 400:
            continue
        read += 1
        nested, pages = sitemap(body)
        found += [p for p in pages if wanted(p[0])]
        fresh = [n for n in nested if n not in seen]
        seen.update(fresh)
        queue += fresh
    return found if enough is None else found[:enough]


def discovered(sources: list, known: DataFrame, transport, most: int = 20, limit: int | None = None, sitemaps: bool = True, index_pages: bool = True) -> DataFrame:
    """New ledger rows (vendor, url, discovered_at, source, lastmod) of walking each source's sitemaps and index pages.

    sources: rows of read_sources. Pages are filtered by the source's patterns as they are found; those of sitemaps come before
    links of index pages, each url counts once. Urls that the ledger (known) has are left out, then the newest up to limit stay
    per vendor. A site's pages are listed on the driver: one site's index, not a data set."""
    spark = known.sparkSession
    rows = []
    for at, s in enumerate(sources):
        include, exclude = ([re.compile(p) for p in s[c] or ()] for c in ("url_patterns", "exclude_patterns"))
        wanted = lambda u: (not include or any(p.search(u) for p in include)) and not any(p.search(u) for p in exclude)  # noqa: B023, E731
        found: dict[str, tuple] = {}
        for root in (s["sitemaps"] or ()) if sitemaps else ():
            for url, lastmod in walk_sitemaps([root], transport, wanted, most, limit):
                found.setdefault(url, ("sitemap", lastmod))
            if limit is not None and len(found) >= limit:
                break
        for page in (s["index_pages"] or ()) if index_pages else ():
            try:
                body = transport(page)[1]
            except Exception:  # noqa: BLE001 - an index that can't be had is passed over
                continue
            for url in H.links(H.decode(body, None), page):
                if wanted(url):
                    found.setdefault(url, ("index", None))
        rows += [(s["vendor"], url, kind, lastmod, at) for url, (kind, lastmod) in found.items()]
    all_ = spark.createDataFrame(rows, "vendor string, url string, source string, lastmod string, at int")
    first = all_.groupBy("url").agg(F.min_by(F.struct("vendor", "source", "lastmod"), "at").alias("r")).select("url", "r.*")  # the first source that lists it
    return discovery_batch(first, known, limit).select("vendor", "url", T.utc_now().alias("discovered_at"), "source", "lastmod")


def checked_limits(assets: int, timeout_seconds: float, least_score: int) -> tuple[int, float, int]:
    """The limits of an extraction as given, or a ValueError: assets from 0, a positive timeout, a score from 1."""
    if assets < 0 or timeout_seconds <= 0 or least_score < 1:
        raise ValueError("assets must be 0 or more, the timeout above 0 and the least score 1 or more")
    return assets, timeout_seconds, least_score
