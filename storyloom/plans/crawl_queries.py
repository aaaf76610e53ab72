"""Queries over the ledgers and stored pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import text as T
from ..operators import crawl as C
from ..operators.analytics import ranked
from ..operators.records import last_by_key
from ..session import spread, table
from .registry import query

#: A configuration as the sources file holds it.
SOURCES = [
    ("Nimbral", ["/customers/", "/blog/"], ["featured", r"\?"]),
    ("Quantrel", [r"/view\?id=\d+$"], []),
    ("Stratolyn", [], ["/press/"]),
]
SOURCES_DDL = "vendor string, url_patterns array<string>, exclude_patterns array<string>"
INCLUDED = """select distinct vendor, url from discovered_urls where
(vendor = 'Nimbral' and regexp_matches(url, '/customers/|/blog/') and not regexp_matches(url, 'featured|\\?'))
or (vendor = 'Quantrel' and regexp_matches(url, '/view\\?id=\\d+$')) or (vendor = 'Stratolyn' and not regexp_matches(url, '/press/'))"""


def du(spark, d):
    return table(spark, d, "discovered_urls")


def fm(spark, d):
    return table(spark, d, "fetch_manifest")


def order():
    """Attempts by time as written, then by what else tells them apart: the files have no order of their own."""
    c = lambda x: F.coalesce(F.col(x).cast("string"), F.lit(""))
    return F.struct("fetched_at", F.lpad(F.col("status").cast("string"), 3, "0"), c("error"), c("raw_path"))


LATEST = """(select * from fetch_manifest where url is not null qualify row_number() over (partition by url
order by fetched_at desc, lpad(status::varchar, 3, '0') desc, coalesce(error, '') desc, coalesce(raw_path, '') desc) = 1)"""
DONE = "status = 200 and coalesce(error, '') = ''"
LASTMODS = "(select url, max(lastmod) lastmod from discovered_urls group by url)"


def latest(spark, d):
    return C.latest_attempts(fm(spark, d), order())


def lastmods(spark, d):
    return du(spark, d).groupBy("url").agg(F.max("lastmod").alias("lastmod"))


@query("crawl_filtered_urls", INCLUDED)
def crawl_filtered_urls(spark, d):
    sources = spark.createDataFrame(SOURCES, SOURCES_DDL)
    return C.filter_urls(du(spark, d).select("vendor", "url"), sources)


@query("crawl_new_urls", "select distinct url from discovered_urls d where not exists (select 1 from fetch_manifest m where m.url = d.url)")
def crawl_new_urls(spark, d):
    return C.new_urls(du(spark, d).select("url").distinct(), fm(spark, d))


@query("crawl_new_per_vendor", "select vendor, count(distinct url) new_urls from discovered_urls d where not exists (select 1 from fetch_manifest m where m.url = d.url) group by vendor")
def crawl_new_per_vendor(spark, d):
    return C.new_urls(du(spark, d), fm(spark, d)).groupBy("vendor").agg(F.count_distinct("url").alias("new_urls"))


BATCH = """select vendor, url, lastmod from (select vendor, url, max(lastmod) lastmod from discovered_urls d group by 1, 2) d
where not exists (select 1 from fetch_manifest m where m.url = d.url) qualify row_number() over (partition by vendor order by (lastmod is not null) desc, lastmod desc nulls last, url) <= 5"""


@query("crawl_discovery_batch", BATCH)
def crawl_discovery_batch(spark, d):
    found = du(spark, d).groupBy("vendor", "url").agg(F.max("lastmod").alias("lastmod"))
    return C.discovery_batch(found, fm(spark, d), limit_per_vendor=5).select("vendor", "url", "lastmod")


@query("crawl_latest_attempts", f"select url, status, fetched_at, coalesce(error, '') error from {LATEST}")
def crawl_latest_attempts(spark, d):
    return latest(spark, d).select("url", "status", "fetched_at", F.coalesce("error", F.lit("")).alias("error"))


@query("crawl_fetch_queue", f"select url, vendor, lastmod, count(*) listings from discovered_urls d where coalesce(url, '') <> '' and coalesce(vendor, '') <> '' and (coalesce(lastmod, '') = '' or lastmod >= '2026-01-20') and not exists (select 1 from {LATEST} m where m.url = d.url and {DONE}) group by all")
def crawl_fetch_queue(spark, d):
    queue = C.fetch_queue(du(spark, d), latest(spark, d), since="2026-01-20")
    return queue.groupBy("url", "vendor", "lastmod").agg(F.count("*").alias("listings"))


@query("crawl_vendor_queue", f"select count(*) queued from discovered_urls d where lower(vendor) = 'nimbral' and coalesce(url, '') <> '' and not exists (select 1 from {LATEST} m where m.url = d.url and {DONE})")
def crawl_vendor_queue(spark, d):
    return C.fetch_queue(du(spark, d), latest(spark, d), vendor="NIMBRAL").agg(F.count("*").alias("queued"))


@query("crawl_queue_counts", f"select discovered, queued, discovered - queued skipped from (select count(*) discovered, count(*) filter (where coalesce(vendor, '') <> '' and coalesce(url, '') <> '' and url not in (select url from {LATEST} where {DONE})) queued from discovered_urls)")
def crawl_queue_counts(spark, d):
    rows = du(spark, d)
    return C.queue_counts(rows, C.fetch_queue(rows, latest(spark, d)))


@query("crawl_newest_first", f"select url, lastmod from {LASTMODS} where url is not null order by (lastmod is not null) desc, lastmod desc nulls last, url limit 25")
def crawl_newest_first(spark, d):
    return lastmods(spark, d).where("url is not null").orderBy(*C.newest_first(F.col("lastmod")), "url").limit(25)


EXTRACT = f"""select m.url, m.sha256, l.lastmod from {LATEST} m left join {LASTMODS} l on l.url = m.url
where m.status = 200 and coalesce(m.raw_path, '') <> '' and not exists (select 1 from case_studies c where c.source_url = m.url)"""


@query("crawl_extract_queue", EXTRACT)
def crawl_extract_queue(spark, d):
    return C.extract_queue(latest(spark, d), lastmods(spark, d), table(spark, d, "case_studies").select("source_url")).select("url", "sha256", "lastmod")


@query("crawl_bundles", f"select vendor, regexp_replace(lower(vendor), '[^a-z0-9]+', '-', 'g') vendor_slug, sha256, url, lastmod published_date from (select e.url, m.vendor, m.sha256, e.lastmod from ({EXTRACT}) e join {LATEST} m using (url)) qualify row_number() over (partition by vendor, sha256 order by url) = 1")
def crawl_bundles(spark, d):
    queue = C.extract_queue(latest(spark, d), lastmods(spark, d), table(spark, d, "case_studies").select("source_url"))
    return C.bundle(queue).select("vendor", "vendor_slug", "sha256", "url", "published_date")


SKIPS = f"""with m as (select url, raw_path from {LATEST} where {DONE} and coalesce(raw_path, '') <> ''),
f as (select m.url in (select source_url from case_studies where source_url is not null) extracted, m.raw_path in (select raw_path from raw_pages) stored from m)
select count(*) filter (where extracted) extracted, count(*) filter (where not extracted and not stored) missing_raw, count(*) filter (where not extracted and stored) ready from f"""


@query("crawl_skip_counts", SKIPS)
def crawl_skip_counts(spark, d):
    extracted = table(spark, d, "case_studies").select(F.col("source_url").alias("url"), F.lit(True).alias("extracted")).where("url is not null").distinct()
    stored = table(spark, d, "raw_pages").select("raw_path", F.lit(True).alias("stored"))
    rows = latest(spark, d).where(C.is_done() & (F.coalesce("raw_path", F.lit("")) != "")).join(extracted, "url", "left").join(stored, "raw_path", "left")
    e, s = F.coalesce("extracted", F.lit(False)), F.coalesce("stored", F.lit(False))
    return rows.agg(F.count_if(e).alias("extracted"), F.count_if(~e & ~s).alias("missing_raw"), F.count_if(~e & s).alias("ready"))


@query("crawl_missing_content", "select distinct raw_path from fetch_manifest m where raw_path is not null and not exists (select 1 from raw_pages r where r.raw_path = m.raw_path)")
def crawl_missing_content(spark, d):
    return fm(spark, d).where("raw_path is not null").select("raw_path").join(table(spark, d, "raw_pages").select("raw_path"), "raw_path", "left_anti").distinct()


@query("crawl_attempt_counts", f"select vendor, count(*) filter (where {DONE}) ok, count(*) filter (where not ({DONE})) failed, count(*) filter (where from_cache) cached from fetch_manifest group by vendor")
def crawl_attempt_counts(spark, d):
    return fm(spark, d).groupBy("vendor").agg(F.count_if(C.is_done()).alias("ok"), F.count_if(~C.is_done()).alias("failed"), F.count_if("from_cache").alias("cached"))


@query("crawl_first_listing", "select url, min(discovered_at) first_seen, count(*) listings from discovered_urls where url is not null group by url")
def crawl_first_listing(spark, d):
    return du(spark, d).where("url is not null").groupBy("url").agg(F.min("discovered_at").alias("first_seen"), F.count("*").alias("listings"))


@query("crawl_last_lastmod", "select url, arg_max(substr(trim(lastmod), 1, 10), discovered_at || lastmod) lastmod from discovered_urls where lastmod is not null and url is not null group by url")
def crawl_last_lastmod(spark, d):
    rows = du(spark, d).where("lastmod is not null and url is not null")
    return rows.groupBy("url").agg(F.max_by(T.lastmod_text(F.col("lastmod")), F.concat("discovered_at", "lastmod")).alias("lastmod"))


HOST = "lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]*)', 1))"


@query("crawl_hosts", f"select {HOST} host, count(distinct url) urls from discovered_urls group by 1")
def crawl_hosts(spark, d):
    return du(spark, d).groupBy(T.host(F.col("url")).alias("host")).agg(F.count_distinct("url").alias("urls"))


@query("crawl_domains", f"select array_to_string(list_slice(string_split({HOST}, '.'), -2, -1), '.') \"domain\", count(*) listings from discovered_urls where url is not null group by 1")
def crawl_domains(spark, d):
    return du(spark, d).where("url is not null").groupBy(T.registrable_domain(T.host(F.col("url"))).alias("domain")).agg(F.count("*").alias("listings"))


STRATEGIES = [("www.corvexa.example", "googlebot", "origin"), ("nimbral.example", "reader", "reader"), ("www.okulent.example", "wayback", "wayback")]


@query("crawl_host_strategies", f"""with s(host, strategy, kind) as (values {', '.join(map(str, STRATEGIES))}),
u as (select distinct url, {HOST} h from discovered_urls where url is not null),
k as (select url, 0 p, h k from u union all select url, 1, case when h like 'www.%' then substr(h, 5) else 'www.' || h end from u union all select url, 2, array_to_string(list_slice(string_split(h, '.'), -2, -1), '.') from u),
b as (select url, arg_min(strategy, p) strategy, arg_min(kind, p) kind from k join s on s.host = k.k group by url)
select u.url, b.strategy, b.kind from u left join b using (url)""")
def crawl_host_strategies(spark, d):
    known = spark.createDataFrame(STRATEGIES, "host string, strategy string, kind string")
    return C.host_strategies(du(spark, d).where("url is not null"), known).select("url", "strategy", "kind")


@query("crawl_blocked_pages", "select raw_path from raw_pages where " + " or ".join("contains(lower(substr(body, 1, 4000)), '{}')".format(m.replace("'", "''")) for m in T.BLOCKED_MARKERS))
def crawl_blocked_pages(spark, d):
    return spread(table(spark, d, "raw_pages").select("raw_path", "body")).where(T.looks_blocked(F.lit(200), F.col("body"))).select("raw_path")


@query("crawl_content_kinds", "select case when contains(lower(content_type), 'pdf') or contains(substr(body, 1, 1024), '%PDF-') then 'pdf' when contains(lower(content_type), 'html') or contains(lower(content_type), 'xml') or regexp_matches(lower(substr(body, 1, 2048)), '<html|<!doctype html|<article|<main|<body') then 'html' else 'text' end kind, case when contains(lower(content_type), 'pdf') then '.pdf' when contains(lower(content_type), 'json') then '.json' when starts_with(lower(content_type), 'text/plain') then '.txt' else '.html' end suffix, count(*) pages from raw_pages group by 1, 2")
def crawl_content_kinds(spark, d):
    kind = F.when(T.looks_like_pdf(F.col("body"), F.col("content_type")), "pdf").when(T.looks_like_html(F.col("body"), F.col("content_type")), "html").otherwise("text")
    return table(spark, d, "raw_pages").groupBy(kind.alias("kind"), T.raw_suffix(F.col("content_type")).alias("suffix")).agg(F.count("*").alias("pages"))


@query("crawl_digests", "select raw_path, sha256(body) = sha256 intact, substr(sha256(raw_path), 1, 16) \"key\" from raw_pages")
def crawl_digests(spark, d):
    return table(spark, d, "raw_pages").select("raw_path", (F.sha2("body", 256) == F.col("sha256")).alias("intact"), T.digest16(F.col("raw_path")).alias("key"))


@query("crawl_shared_pages", "select raw_path, count(distinct url) urls from fetch_manifest where raw_path is not null group by raw_path having count(distinct url) > 1")
def crawl_shared_pages(spark, d):
    return fm(spark, d).where("raw_path is not null").groupBy("raw_path").agg(F.count_distinct("url").alias("urls")).where("urls > 1")


@query("crawl_known_both", "select distinct url from discovered_urls intersect select distinct url from fetch_manifest")
def crawl_known_both(spark, d):
    return du(spark, d).select("url").intersect(fm(spark, d).select("url"))


@query("crawl_all_urls", "select url, 'listed' origin from discovered_urls union select url, 'fetched' from fetch_manifest")
def crawl_all_urls(spark, d):
    return du(spark, d).select("url", F.lit("listed").alias("origin")).unionByName(fm(spark, d).select("url", F.lit("fetched").alias("origin"))).distinct()


@query("crawl_attempt_numbers", "select url, fetched_at, row_number() over (partition by url order by fetched_at) attempt from (select distinct url, fetched_at from fetch_manifest where status = 0)")
def crawl_attempt_numbers(spark, d):
    failed = fm(spark, d).where("status = 0").select("url", "fetched_at").distinct()
    return ranked(failed, "url", ["fetched_at"], "attempt")


@query("crawl_first_places", "select url, nullif(arg_max(coalesce(lastmod, ''), discovered_at || coalesce(lastmod, '')), '') lastmod, min(discovered_at || coalesce(lastmod, '')) place from discovered_urls where url is not null group by url")
def crawl_first_places(spark, d):
    rows = du(spark, d).select("url", F.coalesce("lastmod", F.lit("")).alias("lastmod"), F.concat("discovered_at", F.coalesce("lastmod", F.lit(""))).alias("at"))
    return last_by_key(rows, "url", "at", "place").select("url", F.nullif("lastmod", F.lit("")).alias("lastmod"), "place")


def _base():
    return F.concat(F.lit("https://"), F.lower(F.regexp_replace("vendor", " ", "")), F.lit(".example/"))


def pages(spark, d):
    return spread(table(spark, d, "raw_pages"))


@query("page_texts")
def page_texts(spark, d):
    """Read as a tree; the rules are checked on page_tree_fixtures."""
    return pages(spark, d).select("raw_path", H.page_text(F.col("body"), F.col("content_type")).alias("t")).select("raw_path", "t.title", "t.text", "t.method")


@query("page_texts_by_tags")
def page_texts_by_tags(spark, d):
    """Read by tags alone; the rules are checked on page_tag_fixtures."""
    return pages(spark, d).select("raw_path", H.page_text(F.col("body"), F.col("content_type"), by_tree=False).alias("t")).select("raw_path", "t.title", "t.text", "t.method")


LINKS = """with a as (select raw_path, 'https://' || replace(lower(vendor), ' ', '') || '.example' site, unnest(regexp_extract_all(body, '(?i)<a\\s[^>]*?href\\s*=\\s*("[^"]*"|''[^'']*''|[^\\s>]+)', 1)) h,
  generate_subscripts(regexp_extract_all(body, '(?i)<a\\s[^>]*?href\\s*=\\s*("[^"]*"|''[^'']*''|[^\\s>]+)', 1), 1) - 1 as position from raw_pages),
b as (select raw_path, site, position::int as position, trim(h, chr(34) || chr(39)) h from a where trim(h, chr(34) || chr(39)) <> '')
select raw_path, position, case when h = '#' then site || '/' when starts_with(h, '/') then site || h when contains(h, '://') then h else site || '/' || h end url from b"""


@query("page_links", LINKS)
def page_links(spark, d):
    return pages(spark, d).select("raw_path", F.posexplode(H.page_links("body", _base())).alias("position", "url"))


@query("page_images")
def page_images(spark, d):
    return pages(spark, d).select("raw_path", F.explode(H.page_images("body", "content_type", _base())).alias("image")).select("raw_path", "image.*")


CLEAN_LINES = """with l as (select raw_path, unnest(string_split_regex(body, '\r\n|[\n\r\x0B\f\x1c\x1d\x1e]')) line, generate_subscripts(string_split_regex(body, '\r\n|[\n\r\x0B\f\x1c\x1d\x1e]'), 1) i from raw_pages),
t as (select raw_path, i, trim(regexp_replace(line, '[ \\t]+', ' ', 'g')) line from l),
k as (select *, trim(regexp_replace(lower(line), '[^\\p{L}\\p{N}_]+', ' ', 'g')) key from t where line <> '' and not regexp_matches(line, '(?i)""" + "|".join(f"(?:{p})" for p in T.BOILERPLATE).replace("'", "''") + """')),
kept as (select *, row_number() over (partition by raw_path, case when length(key) <= 80 then key else i::varchar || chr(10) end order by i) n from k)
select r.raw_path, coalesce(c.lines, 0) as lines, coalesce(c.chars, 0) chars from raw_pages r left join (select raw_path, count(*) as lines, sum(length(line))::bigint chars from kept where n = 1 group by raw_path) c using (raw_path)"""


@query("page_clean_lengths", CLEAN_LINES)
def page_clean_lengths(spark, d):
    """Lines and their characters that clean_text leaves of every stored body, tags and all."""
    lines = F.filter(F.split(T.clean_text(F.col("body")), "\n"), lambda x: x != "")
    return table(spark, d, "raw_pages").select("raw_path", F.size(lines).cast("bigint").alias("lines"), F.length(F.array_join(lines, "")).cast("bigint").alias("chars"))


@query("page_plain_text", "select raw_path, length(regexp_replace(regexp_replace(regexp_replace(body, '[ \\t\\f\\x0B]+', ' ', 'g'), ' *\\n *', chr(10), 'g'), '\\n{3,}', chr(10) || chr(10), 'g')) chars from raw_pages")
def page_plain_text(spark, d):
    return table(spark, d, "raw_pages").select("raw_path", F.length(T.white_space(F.col("body"))).cast("bigint").alias("chars"))


@query("page_boilerplate_lines", "select raw_path, count(*) n from (select raw_path, trim(unnest(string_split(body, chr(10)))) line from raw_pages) where regexp_matches(line, '(?i)" + "|".join(f"(?:{p})" for p in T.BOILERPLATE).replace("'", "''") + "') group by raw_path")
def page_boilerplate_lines(spark, d):
    rows = table(spark, d, "raw_pages").select("raw_path", F.explode(F.split("body", "\n")).alias("line"))
    return rows.where(T.is_boilerplate(F.trim("line"))).groupBy("raw_path").agg(F.count("*").alias("n"))


@query("page_headlines", "select raw_path, trim(regexp_extract(body, '<title>([^<]*)</title>', 1)) title from raw_pages where contains(body, '<title>')")
def page_headlines(spark, d):
    return table(spark, d, "raw_pages").where(F.col("body").contains("<title>")).select("raw_path", F.trim(F.regexp_extract("body", "<title>([^<]*)</title>", 1)).alias("title"))


@query("page_prompts", "select raw_path, 'Page ' || raw_path || chr(10) || 'Title ' || coalesce(nullif(vendor, ''), '(no title)') || chr(10) || case when length(body) > 18000 then substr(body, 1, 18000) || chr(10) || '...[truncated]' else body end prompt from raw_pages")
def page_prompts(spark, d):
    text = T.filled_template("Page {path}\nTitle {title}\n{body}", path=F.col("raw_path"), title=T.titled(F.col("vendor")), body=T.truncated(F.col("body")))
    return table(spark, d, "raw_pages").select("raw_path", text.alias("prompt"))


@query("rec_banner", "select r || case when r = 1 then ' record' else ' records' end || case when s > 0 then ': ' || (r - s) || ' extracted and ' || s || ' sample' else '' end banner from (select count(*) r, count(*) filter (is_sample) s from case_studies)")
def rec_banner(spark, d):
    counts = table(spark, d, "case_studies").agg(F.count("*").alias("r"), F.count_if("is_sample").alias("s"))
    return counts.select(T.banner(F.col("r"), F.col("s")).alias("banner"))


@query("rec_json", "select id, products from (select id, to_json(products_used)::varchar products from case_studies where products_used is not null)")
def rec_json(spark, d):
    return table(spark, d, "case_studies").where("products_used is not null").select("id", F.to_json("products_used").alias("products"))


@query("crawl_cached", f"""with c as (select m.url, r.body from {LATEST} m join raw_pages r using (raw_path) where {DONE})
select u.url, case when c.body is not null then 200 else 0 end status, c.body is not null from_cache, coalesce(length(c.body), 0) chars from (select distinct url from discovered_urls where url is not null) u left join c using (url)""")
def crawl_cached(spark, d):
    """The cache holds the page of each url whose last attempt is done, under the digest of the url."""
    urls = du(spark, d).where("url is not null").select("url").distinct()
    held = latest(spark, d).where(C.is_done()).select("url", "raw_path").join(table(spark, d, "raw_pages").select("raw_path", "body"), "raw_path")
    out = C.cached(urls, held.select(F.sha2("url", 256).alias("key"), "body"))
    return out.select("url", F.coalesce("status", F.lit(0)).alias("status"), "from_cache", F.coalesce(F.length("body"), F.lit(0)).cast("bigint").alias("chars"))


@query("crawl_bundle_prompts", f"""select vendor, sha256, url source_url, raw_path, content_type, retrieval_source, profile, lastmod published_date, 'html-beautifulsoup' extraction_method
from (select e.url, m.vendor, m.sha256, e.lastmod, m.raw_path, m.content_type, m.retrieval_source, m.profile from ({EXTRACT}) e join {LATEST} m using (url))
join (select raw_path, body from raw_pages) using (raw_path) qualify row_number() over (partition by vendor, sha256 order by url) = 1""".replace("'html-beautifulsoup' extraction_method", "case when regexp_matches(lower(content_type), 'html|xml') or regexp_matches(lower(substr(body, 1, 2048)), '<html|<!doctype html|<article|<main|<body') then 'html-beautifulsoup' else 'text' end extraction_method"))
def crawl_bundle_prompts(spark, d):
    """Full bundles; texts, images and prompts are checked on fixtures."""
    queue = C.extract_queue(latest(spark, d), lastmods(spark, d), table(spark, d, "case_studies").select("source_url"))
    out = C.full_bundles(queue, table(spark, d, "raw_pages"), "skill", "taxonomy")
    return out.select("vendor", "sha256", "source_url", "raw_path", "content_type", "retrieval_source", "profile", "published_date", "extraction_method")


@query("crawl_listings_per_day", "select cast(try_cast(discovered_at as timestamptz) at time zone 'UTC' as date)::varchar \"day\", vendor, count(*) listings from discovered_urls where try_cast(discovered_at as timestamptz) is not null group by 1, 2")
def crawl_listings_per_day(spark, d):
    timed = du(spark, d).withColumn("seen_at", F.try_to_timestamp("discovered_at")).where("seen_at is not null")
    return timed.groupBy(F.window("seen_at", "1 day").alias("w"), "vendor").agg(F.count("*").alias("listings")).select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "vendor", "listings")
