"""Operators on literal inputs, each with the rows it must give: what no SQL over the tables can express."""

from __future__ import annotations

import gzip
import json
import uuid

from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import text as T
from ..operators import analytics as A
from ..operators import assets
from ..operators import crawl as C
from ..operators import records as R
from ..session import shared_dir
from .registry import query


def sql_value(v) -> str:
    if v is None:
        return "null"
    if isinstance(v, bool):
        return str(v).lower()
    return f"{v}::bigint" if isinstance(v, int) else "'" + v.replace("'", "''") + "'"


def rows_sql(columns: str, rows: list[tuple]) -> str:
    """A query that gives these rows."""
    values = ", ".join("(" + ", ".join(map(sql_value, r)) + ")" for r in rows)
    names = columns.split()
    return f"select {', '.join(f'{c} as {chr(34)}{c}{chr(34)}' for c in names)} from (values {values}) t({', '.join(names)})"


LONG = " ".join(["word"] * 60)
#: Pages, and (title, text) by tags and as a tree.
PAGES = [
    ("empty", "<body><article></article><p>outside</p></body>", "", "", "outside"),
    ("unclosed", "<body><form><p>lost</p></body>", "", "", ""),
    ("header", "<body><article><header><h1>Gone</h1></header><p>Kept</p></article></body>", "", "Kept", "Kept"),
    ("repeats", "<body><p>Same</p><p>same</p><p>!!</p><p>??</p></body>", "", "Same\n\n!!", "Same\n\n!!"),
    ("marks", "<head><title>A  b</title></head><body><h2>Two</h2><ul><li>x</li><li>y</li></ul></body>", "A b", "## Two\n\n- x\n\n- y", "##\nTwo\n\nx\n\ny"),
    ("noise", "<body><nav>Menu</nav><div class='cookie-banner'>We ask</div><main><h1>Head</h1><p>One <b>two</b> three.</p></main><footer>F</footer></body>", "", "# Head\n\nOne two three.", "#\nHead\n\nOne\ntwo\nthree."),
    ("root", f"<body><div>aside</div><article><p>{LONG}</p></article></body>", "", LONG, LONG),
    ("comment", "<body>a<!-- b -->c<br>d<p aria-hidden='true'>e</p></body>", "", "ac\nd\ne", "a\nc\n\nd"),
    ("entities", "<body><p>&Eacute;t&eacute; &amp; co</p><p>été &amp; CO</p><p>Read more</p></body>", "", "Été & co", "Été & co"),
]


def _pages(spark):
    return spark.createDataFrame([(name, body) for name, body, *_ in PAGES], "name string, body string")


@query("page_tag_fixtures", rows_sql("name title text method", [(name, title, text, "html-stdlib") for name, _, title, text, _ in PAGES]))
def page_tag_fixtures(spark, d):
    return _pages(spark).select("name", H.page_text(F.col("body"), F.lit("text/html"), by_tree=False).alias("t")).select("name", "t.title", "t.text", "t.method")


@query("page_tree_fixtures", rows_sql("name title text method", [(name, title, text, "html-beautifulsoup") for name, _, title, _, text in PAGES]).replace("'A b'", "'A  b'"))
def page_tree_fixtures(spark, d):
    return _pages(spark).select("name", H.page_text(F.col("body"), F.lit("text/html")).alias("t")).select("name", "t.title", "t.text", "t.method")


LATIN, GZIP = "é".encode("latin-1"), gzip.compress(b"packed", mtime=0)
PDF = b"%PDF-1.4\n1 0 obj <</Type /Catalog /Pages 2 0 R>> endobj\n2 0 obj <</Type /Pages /Kids [3 0 R] /Count 1>> endobj\n3 0 obj <</Type /Page /Contents 4 0 R>> endobj\n4 0 obj <<>> stream\nBT (Hello) Tj 0 -12 Td [(Wor) 20 (ld) -300 (again)] TJ ET\nendstream endobj\n5 0 obj <</Title (A title)>> endobj\ntrailer <</Root 1 0 R /Info 5 0 R>>"


@query("page_body_fixtures", rows_sql("name title text method", [("latin", "", "é", "text"), ("unknown charset", "", "a", "text"), ("pdf", "A title", "--- Page 1 ---\nHello\nWorld again", "pdf"), ("empty", "", "", "text"), ("packed", "", "packed", "text"), ("not packed", "", "x", "text")]))
def page_body_fixtures(spark, d):
    rows = [("latin", LATIN, "text/plain; charset=latin-1", None, None), ("unknown charset", b"a", "text/plain; charset=nonsense", None, None), ("pdf", PDF, "", None, None), ("empty", None, None, None, None), ("packed", GZIP, "text/plain", None, "u.gz"), ("not packed", b"x", "text/plain", "gzip", None)]
    bodies = spark.createDataFrame([(n, None if b is None else bytearray(b), *r) for n, b, *r in rows], "name string, body binary, content_type string, encoding string, url string")
    return bodies.select("name", H.page_text(H.page_unpacked("body", "encoding", "url"), F.col("content_type")).alias("t")).select("name", "t.title", "t.text", "t.method")


@query("link_fixtures", rows_sql("position url", [(0, "https://h.example/x#y"), (1, "https://h.example/p/b"), (2, "https://o.example/"), (3, "https://h.example/p/b")]))
def link_fixtures(spark, d):
    body = "<a href=''>none</a><a href='/x#y'>1</a><a href='b'>2</a><A HREF=https://o.example/>3</A><a name=q>no</a><a title=t href='b'>again</a>"
    return spark.createDataFrame([(body,)], "body string").select(F.posexplode(H.page_links("body", F.lit("https://h.example/p/"))).alias("position", "url")).select(F.col("position").cast("bigint").alias("position"), "url")


NS = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'


@query("sitemap_fixtures", rows_sql("name nested url lastmod", [("pages", None, "u", "2025-01-02"), ("pages", None, "v", None), ("pages", None, "w", "2025"), ("index", "s", None, None)]))
def sitemap_fixtures(spark, d):
    rows = [("pages", f"<urlset {NS}><url><loc> u </loc><lastmod>2025-01-02T03:04</lastmod></url><url><loc>v</loc></url><url><loc>w</loc><lastmod> 2025 </lastmod></url><url/></urlset>"), ("index", f"<sitemapindex {NS}><sitemap><loc>s</loc></sitemap></sitemapindex>"), ("other", "<urlset><url><loc>u</loc></url></urlset>"), ("broken", "broken<")]
    parsed = spark.createDataFrame(rows, "name string, body string").select("name", H.sitemap_entries("body").alias("s"))
    pages = parsed.select("name", F.lit(None).cast("string").alias("nested"), F.inline("s.pages"))
    return pages.unionByName(parsed.select("name", F.explode("s.nested").alias("nested"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("lastmod")))


IMAGES = "<head><title>Story</title><meta property='og:image' content='/og-pipeline.png'><meta name='twitter:image' content='/plain.png'></head><body><article>" + LONG + (
    "<figure><img srcset='/s.png 1x, /architecture.png 2x' src='/z.png' width='800' height='400' alt='System architecture'><figcaption>Flow</figcaption></figure>"
    "<nav><img src='/pipeline.png'></nav><div class='share-bar'><img src='/topology.png'></div><img src='data:image/png;base64,x'><img src='/logo.png'><img src='/tiny-diagram.png' width='80' alt='d'>"
    "<div style=\"background:url('/data-flow.png')\"></div><img src='/architecture.png'><svg aria-label='workflow' width='640'><path d='M0'/></svg></article></body>"
)


@query("image_fixtures", rows_sql("url source score is_diagram_like caption confidence embedded", [
    ("https://a.example/architecture.png", "html-img", 29, True, "Flow", None, None), ("https://a.example/data-flow.png", "css-background", 11, True, None, "medium", None),
    ("https://a.example/tiny-diagram.png", "html-img", 7, True, None, None, None), ("https://a.example/og-pipeline.png", "og:image", 10, True, None, None, None),
    (None, "inline-svg", 15, True, None, None, '<svg aria-label="workflow" width="640"><path d="M0"></path></svg>'),
]))
def image_fixtures(spark, d):
    found = H.related_images(F.col("body"), F.lit("text/html"), F.lit("https://a.example/p"), embedded=True)
    rows = spark.createDataFrame([(IMAGES,)], "body string").select(F.explode(found).alias("i")).select("i.*")
    return rows.select("url", "source", F.col("score").cast("bigint").alias("score"), "is_diagram_like", "caption", "confidence", "embedded")


SIGNED = [("png", b"\x89PNG\r\n\x1a\n..", "", "u"), ("webp", b"RIFF....WEBP", "", "u"), ("avi", b"RIFF....AVI ", "", "u"), ("svg", b" <?xml version='1.0'?><svg></svg>", "", "u"), ("page", b"\n<!DOCTYPE html><svg>", "image/png", "u.png"), ("json", b'{"a": 1}', "image/png", "u"), ("typed", b"??", "image/gif; q=1", "u"), ("ending", b"??", "text/plain", "https://h/a.JPEG?x=1"), ("unknown", b"??", "image/tiff", "u"), ("none", b"??", "text/plain", "u")]


@query("image_type_fixtures", rows_sql("name is_image suffix error_document", [("png", True, ".png", False), ("webp", True, ".webp", False), ("avi", False, ".bin", False), ("svg", True, ".svg", False), ("page", False, ".png", True), ("json", False, ".png", True), ("typed", True, ".gif", False), ("ending", True, ".jpeg", False), ("unknown", True, ".bin", False), ("none", False, ".bin", False)]))
def image_type_fixtures(spark, d):
    rows = spark.createDataFrame([(n, bytearray(b), t, u) for n, b, t, u in SIGNED], "name string, body binary, type string, url string")
    args = F.col("body"), F.col("type"), F.col("url")
    return rows.select("name", T.is_image(*args).alias("is_image"), T.image_suffix(*args).alias("suffix"), T.is_error_document(F.col("body")).alias("error_document"))


def _recorded(url, profile="default"):
    """A recorded transport: what each address answers."""
    answers = {
        "https://h.example/ok": (200, b"<p>fine</p>", "text/html", ""), "https://h.example/gone": (404, b"x", "text/html", ""), "https://h.example/blank": (200, b"", "text/plain", "https://h.example/blank2"),
        "https://h.example/map.xml": (200, f"<urlset {NS}><url><loc>https://h.example/blog/1</loc><lastmod>2025-02-03</lastmod></url><url><loc>https://h.example/blog/2</loc></url><url><loc>https://h.example/about</loc></url></urlset>".encode(), "text/xml", ""),
        "https://h.example/index": (200, b"<a href='/blog/3'>3</a><a href='/blog/1'>1</a><a href='/press'>p</a>", "text/html", ""), "https://h.example/arch.png": (200, b"\x89PNG\r\n\x1a\n1", "image/png", "https://h.example/arch.png"),
    }
    if url == "https://h.example/wall":
        return (200, b"in", "text/plain", "") if profile == "desktop-chrome" else (403, b"no", "text/html", "")
    if url not in answers:
        raise OSError("no answer")
    return answers[url]


FETCHES = [("https://h.example/ok", None, None), ("https://h.example/gone", None, None), ("https://h.example/blank", None, None), ("https://h.example/wall", "desktop-chrome", "origin"), ("https://h.example/none", None, None)]


@query("fetch_fixtures", rows_sql("url vendor status raw_path error retrieval_source profile", [
    ("https://h.example/ok", "A b", 200, "raw/a-b/7a1c57d4c1d6ef9e7c1ed4dca1f3fb2b.html", None, "origin", "default"), ("https://h.example/gone", "A b", 0, None, "HTTPError: HTTP Error 404: HTTP status 404", None, None),
    ("https://h.example/blank", "A b", 0, None, "ValueError: empty response body", None, None), ("https://h.example/wall", "A b", 200, "raw/a-b/x.txt", None, "origin", "desktop-chrome"), ("https://h.example/none", "A b", 0, None, "OSError: no answer", None, None),
]).replace("'raw/a-b/7a1c57d4c1d6ef9e7c1ed4dca1f3fb2b.html'", "'raw/a-b/' || sha256('<p>fine</p>') || '.html'").replace("'raw/a-b/x.txt'", "'raw/a-b/' || sha256('in') || '.txt'"))
def fetch_fixtures(spark, d):
    """Planned, fetched by a recorded transport and written down as a manifest."""
    planned = C.attempt_plan(spark.createDataFrame(FETCHES, "url string, strategy string, kind string"), 2025)
    queue = planned.select(F.lit("A b").alias("vendor"), "url")
    rows = C.manifest_rows(queue, C.fetch_with(planned, _recorded, 0.0), "raw")
    return rows.select("url", "vendor", F.col("status").cast("bigint").alias("status"), "raw_path", "error", "retrieval_source", "profile")


@query("discover_fixtures", rows_sql("vendor url source lastmod", [("V", "https://h.example/blog/1", "sitemap", "2025-02-03"), ("V", "https://h.example/blog/3", "index", None)]))
def discover_fixtures(spark, d):
    sources = [{"vendor": "V", "sitemaps": ["https://h.example/map.xml", "https://h.example/lost.xml"], "index_pages": ["https://h.example/index"], "url_patterns": ["/blog/"], "exclude_patterns": ["/blog/9"]}]
    ledger = spark.createDataFrame([("https://h.example/blog/2",)], "url string")
    return C.discovered(sources, ledger, lambda u: _recorded(u)[:3]).select("vendor", "url", "source", "lastmod")


@query("plan_fixtures", rows_sql("url n first_profile first_source last_source", [("https://h.example/a", 8, "googlebot", "origin", "wayback"), ("https://h.example/b", 9, "default", "origin", "wayback"), ("https://h.example/c", 8, "default", "reader", "wayback"), ("https://h.example/d", 9, "default", "origin", "wayback")]))
def plan_fixtures(spark, d):
    known = [("https://h.example/a", "googlebot", "origin"), ("https://h.example/b", None, None), ("https://h.example/c", "reader", "reader"), ("https://h.example/d", "unheard-of", "origin")]
    plans = C.attempt_plan(spark.createDataFrame(known, "url string, strategy string, kind string"), 2025)
    return plans.select("url", F.size("attempts").cast("bigint").alias("n"), F.col("attempts")[0]["profile"].alias("first_profile"), F.col("attempts")[0]["source"].alias("first_source"), F.element_at("attempts", -1)["source"].alias("last_source"))


TRIED = [("u", 1, 403, "x", None, "default", "origin"), ("u", 2, 200, "fine", None, "googlebot", "origin"), ("v", 1, 0, None, "reset", "default", "origin"), ("v", 2, 404, "x", None, "bingbot", "origin"), ("w", 1, 200, "captcha", None, "default", "origin"), ("w", 2, 200, "", None, "default", "reader"), ("w", 3, 301, "y", None, "default", "wayback")]
TRIED_DDL = "url string, attempt_no int, status int, body string, transport_error string, profile string, source string"


@query("attempt_fixtures", rows_sql("url attempt_no outcome strategy kind", [("u", 2, "ok", "googlebot", "origin"), ("v", 2, "failed", None, None), ("w", 2, "ok", "wayback", "wayback")]))
def attempt_fixtures(spark, d):
    rows = spark.createDataFrame(TRIED, TRIED_DDL)
    return C.outcome(rows).join(C.probe(rows).drop("host"), "url").select("url", F.col("attempt_no").cast("bigint").alias("attempt_no"), "outcome", "strategy", "kind")


@query("order_fixtures", rows_sql("label place", [("a", 1), ("A", 2), ("Ä", 3), ("b", 4), ("B", 5), ("z", 6)]))
def order_fixtures(spark, d):
    rows = spark.createDataFrame([(1, x) for x in "zBÄAba"], "k int, label string").withColumn("label", A.locale_order(F.col("label")))
    return A.ranked(rows, "k", ["label"], "place").select(F.collate("label", "UTF8_BINARY").alias("label"), F.col("place").cast("bigint").alias("place"))


@query("text_fixtures", rows_sql("name value", [("first integer", "320"), ("no integer", None), ("css", "a.png|b.png"), ("reader", "https://r.jina.ai/http://https://h/"), ("archive", "https://web.archive.org/web/2025/https://h/"), ("inline", "a b c"), ("succeeded", "true"), ("blocked", "false"), ("dash", "—")]))
def text_fixtures(spark, d):
    x = F.lit
    rows = [
        ("first integer", T.first_integer(x("w 320px of 640")).cast("string")), ("no integer", T.first_integer(x("none")).cast("string")), ("css", F.array_join(T.css_urls(x("background: URL('a.png'), url( b.png )")), "|")),
        ("reader", T.reader_url(x("https://h/"))), ("archive", T.archive_url(x("https://h/"), x(2025))), ("inline", T.inline_text(x(" a\n b\t c "))), ("succeeded", T.fetch_succeeded(x(301), x("ok")).cast("string")),
        ("blocked", T.fetch_succeeded(x(200), x("please enable JS")).cast("string")), ("dash", T.date_label(x(""))),
    ]
    return spark.range(1).select(F.explode(F.array(*[F.struct(x(n).alias("name"), v.alias("value")) for n, v in rows])).alias("r")).select("r.*")


CANDIDATES = [{"url": "https://h.example/arch.png", "source": "html-img", "score": 20, "is_diagram_like": True}, {"url": "https://h.example/lost.png", "source": "html-img", "score": 9, "is_diagram_like": False}, {"url": "https://h.example/ok", "source": "css-background", "score": 8, "is_diagram_like": False}, {"source": "inline-svg", "score": 5, "is_diagram_like": False, "embedded": "<svg></svg>"}]


@query("asset_fixtures", rows_sql("source url kind bytes error stored", [
    ("html-img", "https://h.example/arch.png", "image/png", 9, None, True), ("html-img", "https://h.example/lost.png", None, 0, "OSError: no answer", False),
    ("css-background", "https://h.example/ok", None, 0, "non-image response: text/html", False), ("inline-svg", None, "image/svg+xml", 11, None, True),
]))
def asset_fixtures(spark, d):
    rows = spark.createDataFrame([("A b", "s" * 64, CANDIDATES)], f"vendor string, sha256 string, related_images array<{H.IMAGE.simpleString()}>")
    plan = lambda urls: C.fetch_with(urls.withColumn("attempts", F.array(F.struct("url", F.lit("default").alias("profile"), F.lit("origin").alias("source")))), _recorded, 0.0)
    out = assets.with_assets(rows, f"{shared_dir(spark)}/assets-{uuid.uuid4().hex}", plan, most=3)
    images = out.select(F.explode("related_images").alias("i")).select("i.*")
    return images.select("source", "url", F.col("asset_content_type").alias("kind"), F.coalesce("asset_bytes", F.lit(0)).alias("bytes"), F.col("asset_error").alias("error"), F.col("local_path").isNotNull().alias("stored"))


RECORD = {f: "x" for f in R.TEXT_FIELDS} | {f: ["t"] for f in R.LIST_FIELDS}


@query("record_fixtures", rows_sql("id confidence maturity sample violations", [("a", 1, 6, False, ""), ("b", 1, 5, True, "text:vendor, list:metrics, optional:data_flow, optional:integration_points, component:name, component:layer")]))
def record_fixtures(spark, d):
    rows = [RECORD | {"id": "a"}, RECORD | {"id": "b", "vendor": " ", "metrics": None, "data_flow": "", "integration_points": ["a", None], "solution_components": [{"name": "", "role": "r", "layer": " "}], "is_sample": True}]
    out = R.fill_scores(R.normalise(spark.createDataFrame([{c: r.get(c) for c in (x.split()[0] for x in FIELDS)} for r in rows], R.RECORD_DDL)))
    return out.select("id", F.col("confidence_score").cast("bigint").alias("confidence"), F.col("maturity_score").cast("bigint").alias("maturity"), F.col("is_sample").alias("sample"), F.array_join("violations", ", ").alias("violations"))


FIELDS = [*R.TEXT_FIELDS, *R.LIST_FIELDS, "solution_components", "data_flow", "integration_points", "confidence_score", "maturity_score", "is_sample"]


@query("json_fixtures", rows_sql("json", [(json.dumps({"a": None, "b": [{"layer": "ö", "name": "n"}], "c": 1}, ensure_ascii=False, separators=(",", ":")),)]))
def json_fixtures(spark, d):
    rows = spark.createDataFrame([(1, [("n", "ö")], None)], "c int, b array<struct<name:string,layer:string>>, a string")
    return rows.select(R.sorted_json(rows).alias("json"))
