import datetime
import json
import os
import pathlib
import random
import re
import shutil
import subprocess
import sys

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from storyloom.functions import html as H
from storyloom.functions import text as T
from storyloom.operators import analytics as A
from storyloom.operators import crawl as C
from storyloom.operators import records as R
from storyloom.operators.incremental import IncrementalRun, lastmod_day
from storyloom.sinks import writers as W
from storyloom.sources import readers as S


def one(spark, value, f, ddl="x string"):
    return spark.createDataFrame([(value,)], ddl).select(f(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("value, slug", [("A & B", "a-b"), ("  ", "untitled"), ("", "untitled"), ("É1", "1"), (None, None)])
def test_slugify(spark, value, slug):
    assert one(spark, value, T.slugify) == slug


@pytest.mark.parametrize("value, label", [("2025-03-04", "Mar 4, 2025"), ("2025-03", "Mar 1, 2025"), ("unknown", "unknown"), ("2025-13-40", "2025-13-40"), (None, "—"), ("", "—")])
def test_date_label(spark, value, label):
    assert one(spark, value, T.date_label) == label


@pytest.mark.parametrize("value, day", [("2025-03-04T10:00:00Z", "2025-03-04"), ("2025-03", "2025-03-01"), ("2025", "2025-01-01"), ("9", None), ("last week", None), ("2025-02-30", None), ("", None), (None, None)])
def test_lastmod_day(spark, value, day):
    got = one(spark, value, lastmod_day)
    assert (str(got) if got else None) == day


def test_registrable_domain(spark):
    for value, want in (("www.shop.co.uk", "shop.co.uk"), ("a.b.example", "b.example"), ("localhost", None), ("co.uk", "co.uk")):
        assert one(spark, value, T.registrable_domain) == want


def test_percent_rounds_halves_up(spark):
    assert [one(spark, v, T.percent, "x double") for v in (0.125, 0.5, 0.994)] == ["13%", "50%", "99%"]


def reference_clean(text):
    """clean_text over again in plain Python: white space, boilerplate, first of each short key, blank runs."""
    lines = [x.strip() for x in re.sub(r" *\n *", "\n", re.sub(r"[ \t\f\v]+", " ", text)).splitlines()]
    lines = [x for x in lines if not x or not any(re.search(p, x, re.I) for p in T.BOILERPLATE)]
    keys = [re.sub(r"\W+", " ", x.lower()).strip() for x in lines]
    first = {k: i for i, k in reversed(list(enumerate(keys))) if lines[i]}
    kept = [x for i, (x, k) in enumerate(zip(lines, keys)) if not x or len(k) > 80 or first[k] == i]
    return re.sub(r"\n{3,}", "\n\n", "\n".join(kept)).strip()


TEXTS = [
    "<p>x</p>", "a\x1cb\x85c d", "", " \n \n", "a\n\n\n\nb\na", "Menu\nRead more\n\n\n\nText", "long " * 40 + "\n" + "long " * 40, "Été\nété\n!!\n??", "\u00a0x\u00a0\ny", "a\u2028b\r\nc\rA",
    "Advertisement\nwe use cookies to serve you\nWe use cookieses\n½\n²", "_x_\n x \n-x-",
]


def cleaned(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, x string").select("i", T.clean_text(F.col("x")).alias("y")).orderBy("i").collect()
    return [r["y"] for r in rows]


def test_clean_text_equals_plain_python(spark):
    assert cleaned(spark, [*TEXTS, None]) == [*map(reference_clean, TEXTS), None]
    rng = random.Random(3)
    many = ["\n".join(rng.choice(["Same", "same!", "", "x " * 50, "Menu", f"line {rng.randrange(9)}"]) for _ in range(rng.randrange(40))) for _ in range(40)]
    assert cleaned(spark, many) == [*map(reference_clean, many)]


def test_clean_text_of_a_long_text(spark):
    text = "\n".join(f"line number {i % 15000}" for i in range(30000))
    assert len(cleaned(spark, [text])[0].split("\n")) == 15000


def test_texts_of_bodies(spark):
    rows = [("<p>a</p><p>b</p>", "text/html"), ("plain", "text/plain"), (None, None), ("<div>" * 4000 + "deep", "text/html")]
    for by_tree, method in ((True, "html-beautifulsoup"), (False, "html-stdlib")):
        got = spark.createDataFrame(rows, "b string, t string").select(H.page_text(F.col("b"), F.col("t"), by_tree).alias("t")).select("t.*").collect()
        assert [(r["text"], r["method"]) for r in got] == [("a\n\nb", method), ("plain", "text"), ("", "text"), ("deep", method)]
    assert H.decode("é".encode("latin-1"), "text/html; charset=latin-1") == "é" and H.decode(b"a", "charset=nonsense") == "a"


def test_tree_rules():
    text = lambda body: [x.strip() for x in H.tree_parts(body)[1].split("\n") if x.strip()]
    assert text("<body>a</b>b<ruby>漢<rt>kan</rt></ruby></body>") == ["a", "b", "漢"]
    assert text("<body><div class='x' class='modal'>gone</div><p id=ad-slot>gone</p><article class='modal'>kept</article>") == ["kept"]
    two = "<body><article>" + "a " * 120 + "</article><main>" + "b " * 120 + "</main></body>"
    assert set(" ".join(text(two)).split()) == {"a"}  # of equals the first
    assert H.markup(H.tree("<svg a='1\"2'><br><p>&lt;</p></svg>").items[0]) == '<svg a="1&quot;2"><br/><p>&lt;</p></svg>'


def test_pdf_text():
    import zlib

    from storyloom.functions.pdf import pdf_parts

    content = zlib.compress(b"BT /F1 12 Tf <00410042> Tj T* (x) Tj ET")
    cmap = b"1 beginbfchar <0041> <0048> endbfchar 1 beginbfrange <0042> <0043> <0069> endbfrange"
    body = b"%PDF-1.5\n1 0 obj <</Type/Catalog/Pages 2 0 R>> endobj 2 0 obj <</Type/Pages/Kids[3 0 R 9 0 R]/Resources<</Font<</F1 5 0 R>>>>>> endobj 3 0 obj <</Type/Page/Contents 4 0 R>> endobj\n"
    body += b"4 0 obj <</Filter/FlateDecode>> stream\n" + content + b"\nendstream endobj 5 0 obj <</Subtype/Type0/ToUnicode 6 0 R>> endobj 6 0 obj <<>> stream\n" + cmap + b"\nendstream endobj 9 0 obj <</Type/Page>> endobj"
    assert pdf_parts(body)[1].startswith("--- Page 1 ---\nHi")
    assert pdf_parts(b"%PDF-1.4") == ("", "") == pdf_parts(None)


@given(st.binary(max_size=300))
@settings(max_examples=60, deadline=None)
def test_pdf_reader_survives(noise):
    from storyloom.functions.pdf import pdf_parts

    pdf_parts(b"%PDF 1 0 obj <</Type/Catalog/Pages 1 0 R/Kids[1 0 R]>> endobj 2 0 obj <</Type/ObjStm/First 4>> stream\n" + noise + b"\nendstream endobj" + noise)


@given(st.text(alphabet="<>/abp hi1=\"'\n&;#", max_size=200))
@settings(max_examples=60, deadline=None)
def test_parsers_survive_any_text(body):
    H.to_text(body, "text/html")
    H.to_text(body, "text/html", False)
    H.images(body, "text/html", "https://a.example/")
    H.sitemap(body)


def test_links_and_sitemap():
    assert H.links("<a href=''></a><a href='/x#y'>1</a><a href='b'>", "https://h.example/p/") == ["https://h.example/x#y", "https://h.example/p/b"]
    ns = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'
    assert H.sitemap(f"<urlset {ns}><url><loc> u </loc><lastmod>2025-01-02T03:04</lastmod></url><url><loc>v</loc></url></urlset>") == ([], [("u", "2025-01-02"), ("v", None)])
    assert H.sitemap(f"<sitemapindex {ns}><sitemap><loc>s</loc></sitemap></sitemapindex>") == (["s"], [])
    assert H.sitemap("<urlset><url><loc>u</loc></url></urlset>") == ([], []) == H.sitemap("broken<")


def test_images():
    page = "<article>" + "word " * 60 + (
        "<figure><img srcset='/s.png 1x, /architecture.png 2x' src='/z.png' width='800' height='400' alt='System architecture'><figcaption>Flow</figcaption></figure>"
        "<nav><img src='/pipeline.png'></nav><img src='data:image/png;base64,x'><img src='/logo.png'><div style=\"background:url('/data-flow.png')\"></div></article>"
    )
    found = H.images(page, "text/html", "https://a.example/p")
    assert [(x["url"], x["source"], x["is_diagram_like"]) for x in found] == [("https://a.example/architecture.png", "html-img", True), ("https://a.example/data-flow.png", "css-background", True)]
    assert found[0]["caption"] == "Flow" and found[0]["alternate_urls"] == ["https://a.example/s.png", "https://a.example/z.png"]
    assert H.asset_plan([{"source": "html-img", "score": 1}, {"source": "og:image", "score": 3}, {"is_diagram_like": True, "source": "x"}], 1) == [2, 0, 1]
    assert H.ranked_srcset("a 1x, b 2x, c 300w, d") == ["b", "a", "c", "d"]


def test_image_kind(spark):
    svg = b"<?xml version='1.0'?><svg></svg>"
    for body, want in ((b"\x89PNG\r\n\x1a\n..", ".png"), (b"RIFF....WEBP", ".webp"), (b"RIFF....AVI ", None), (svg, ".svg"), (b"", None), (None, None)):
        assert one(spark, body, T.image_kind, "x binary") == want


def record(**more):
    base = {f: "x" for f in R.TEXT_FIELDS} | {f: ["t"] for f in R.LIST_FIELDS}
    return base | {"data_flow": None, "integration_points": None, "solution_components": None, "confidence_score": None, "maturity_score": None, "is_sample": None} | more


def records(spark, *rows):
    return spark.createDataFrame(list(rows), R.RECORD_DDL)


def test_validation_and_scores(spark):
    bad = record(id="b", vendor=" ", metrics=None, data_flow="", integration_points=["a", None], solution_components=[{"name": "", "role": "r", "layer": " "}])
    rows = {r["id"]: r for r in R.fill_scores(R.normalise(records(spark, record(id="a"), bad))).collect()}
    assert rows["a"]["violations"] == [] and rows["a"]["maturity_score"] == 6 and rows["a"]["confidence_score"] == 1.0
    assert rows["b"]["violations"] == ["text:vendor", "list:metrics", "optional:data_flow", "optional:integration_points", "component:name", "component:layer"]
    assert rows["b"]["maturity_score"] == 5 and rows["b"]["confidence_score"] == 1.0  # a blank text still counts as one
    with pytest.raises(Exception, match="invalid record"):
        R.normalise(records(spark, bad), strict=True).collect()


def test_merge_upsert_children(spark):
    old = records(spark, record(id="a", metrics=["m", "m"]), record(id="b"))
    new = records(spark, record(id="b", vendor="v2", metrics=["z", "y"], integration_points=None), record(id="c"))
    assert {r["id"]: r["vendor"] for r in R.upsert(old, new).collect()} == {"a": "x", "b": "v2", "c": "x"}
    kids = R.replace_children(R.child_rows(old), new)
    assert sorted(r["value"] for r in kids.where("case_study_id = 'a' and kind = 'metric'").collect()) == ["m", "m"]
    back = {r["id"]: r for r in R.restore_lists(R.upsert(old, new), kids).collect()}
    assert back["b"]["metrics"] == ["y", "z"] and back["b"]["integration_points"] == []
    assert R.duplicate_slugs(old).first()["ids"] == 2
    rows = spark.createDataFrame([("k", 3, "late"), ("k", 1, "early"), (None, 2, "x")], "key string, n int, v string")
    assert R.last_by_key(rows, "key", "n", "place").collect()[0].asDict() == {"key": "k", "n": 3, "v": "late", "place": 1}


def test_counts_and_matrix(spark):
    values = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "label string")
    assert {r["label"]: (r["count"], round(r["share"], 3)) for r in A.count_values(values).collect()} == {"a": (2, 0.667), "b": (1, 0.333)}
    assert A.count_values(values, denominator=0).agg(F.max("share")).first()[0] == 0.0
    assert A.count_values(values.where("false")).count() == 0
    rows = spark.createDataFrame([("r", ["x", "x", "y"]), ("r", None), ("s", [])], "row string, tags array<string>")
    cells = {(c["label"], c["column"]): c["count"] for c in A.matrix_cells(rows, "row", "tags", spark.createDataFrame([("x",), ("z",)], "label string")).collect()}
    assert cells == {("r", "x"): 1, ("r", "z"): 0, ("s", "x"): 0, ("s", "z"): 0}


def test_queue_rules(spark):
    manifest = spark.createDataFrame([("u", 200, None, 1), ("u", 0, "boom", 2), ("v", 200, "", 1), (None, 200, None, 1)], "url string, status int, error string, n int")
    latest = C.latest_attempts(manifest, F.col("n"))
    assert {r["url"]: r["status"] for r in latest.collect()} == {"u": 0, "v": 200}
    found = spark.createDataFrame([("u", "V", "2025-01-01"), ("v", "V", None), ("w", "V", ""), ("x", "V", None), ("u", "V", "2024-01-01"), ("y", "", None)], "url string, vendor string, lastmod string")
    assert sorted(r["url"] for r in C.fetch_queue(found, latest, vendor="v", since="2025-01-01").collect()) == ["u", "w", "x"]
    order = [r["url"] for r in found.where("vendor = 'V'").orderBy(*C.newest_first(F.col("lastmod")), "url").collect()]
    assert order == ["u", "u", "w", "v", "x"]
    two = spark.createDataFrame([("a", "V", "3"), ("b", "V", "2"), ("c", "V", "1")], "url string, vendor string, lastmod string")
    ledger = spark.createDataFrame([("a",)], "url string")
    assert sorted(r["url"] for r in C.discovery_batch(two, ledger, 1).collect()) == ["b"]
    assert C.discovery_batch(two, ledger, 1, limit_before=True).count() == 0


def test_attempts(spark):
    rows = [("u", 1, 403, "x", None), ("u", 2, 200, "fine", None), ("v", 1, 0, None, "reset"), ("v", 2, 404, "x", None), ("w", 1, 200, "captcha", None)]
    tried = spark.createDataFrame(rows, "url string, attempt_no int, status int, body string, transport_error string")
    assert {r["url"]: (r["attempt_no"], r["outcome"]) for r in C.outcome(tried).collect()} == {"u": (2, "ok"), "v": (2, "failed"), "w": (1, "exhausted")}
    planned = spark.createDataFrame([("https://h.example/", "googlebot", "origin"), ("https://i.example/", None, None)], "url string, strategy string, kind string")
    plans = {r["url"]: [(a["profile"], a["source"]) for a in r["attempts"]] for r in C.attempt_plan(planned, 2025).collect()}
    assert plans["https://h.example/"][0] == ("googlebot", "origin") and len(plans["https://h.example/"]) == 8
    assert plans["https://i.example/"][0] == ("default", "origin") and len(plans["https://i.example/"]) == 9
    urls = C.attempt_plan(spark.createDataFrame([("https://h.example/a", None, None), ("https://h.example/b", None, None)], "url string, strategy string, kind string"), 2025)
    got = C.fetch_with(urls, lambda u, profile: (200, b"x", "t", u) if u.endswith("a") else 1 / 0, 0.0)
    assert {r["url"][-1]: (r["status"], r["error"]) for r in got.collect()} == {"a": (200, None), "b": (0, "ZeroDivisionError: division by zero")}
    answers = {"default": (403, b"", "", ""), "bingbot": (500, b"x", "", "")}
    plan = [{"url": "u", "profile": p, "source": "origin"} for p in ("default", "bingbot", "googlebot")]
    assert C.tried("u", plan, lambda u, p: answers[p])[-1] == "HTTPError: HTTP Error 500: HTTP status 500"  # ends without the third
    assert "blocked" in C.tried("u", plan[:1], lambda u, p: answers[p])[-1] and C.tried("u", [], None)[-1].startswith("RuntimeError")
    kept = {}
    get = C.caching(lambda u: (200, b"body", "t", "reader" if "r" in u else "origin"), kept.get, kept.__setitem__)
    assert get("a")[1] == b"body" and get("a")[2] == "application/octet-stream" and get("r")[2] == "t" and get("r")[2] == "t" and len(kept) == 1


def test_readers(spark, tmp_path):
    (tmp_path / "l.jsonl").write_text('{"url": "u", "vendor": "v"}\n\n[1]\n{broken\n"text"\n{"url": "w", "lastmod": "2025"}\n')
    rows = S.read_jsonl(spark, str(tmp_path / "l.jsonl"), S.LEDGER_DDL).orderBy("line_no").collect()
    assert [(r["url"], r["lastmod"]) for r in rows] == [("u", None), ("w", "2025")]
    assert S.read_jsonl(spark, str(tmp_path / "none.jsonl"), S.LEDGER_DDL).count() == 0
    (tmp_path / "bad.json").write_text("{")
    assert S.read_json(spark, str(tmp_path / "bad.json"), S.CONFIG_DDL).count() == 0 == S.read_json(spark, str(tmp_path / "no.json"), S.CONFIG_DDL).count()
    (tmp_path / "c.json").write_text(json.dumps({"default_delay_seconds": 0, "sources": [{"vendor": "Aa", "sitemaps": ["s"]}]}))
    assert S.fetch_options(spark, str(tmp_path / "c.json")) == ("storyloom/1.0", 1.0)
    assert S.read_sources(spark, str(tmp_path / "c.json"), "AA").count() == 1
    (tmp_path / "t.json").write_text(json.dumps({"vendors": ["a", "b"], "industries": []}))
    assert [(r["kind"], r["value"], r["ordinal"]) for r in S.read_taxonomy(spark, str(tmp_path / "t.json")).collect()] == [("vendors", "a", 0), ("vendors", "b", 1)]
    (tmp_path / "r/x").mkdir(parents=True)
    (tmp_path / "r/x/a.json").write_text(json.dumps(record(id="a")))
    (tmp_path / "r/b.json").write_text("{")
    assert [r["id"] for r in S.read_records(spark, str(tmp_path / "r")).collect()] == ["a"]


def test_writers(spark, tmp_path):
    pages = spark.createDataFrame([("A b", "text/plain", b"1"), ("A b", "text/plain", b"1"), ("A b", "application/pdf", b"2")], "vendor string, content_type string, body binary")
    assert sorted(r["written"] for r in W.write_content(pages, str(tmp_path / "raw")).collect()) == [True, True]
    assert sorted(r["written"] for r in W.write_content(pages, str(tmp_path / "raw")).collect()) == [False, False]
    assert sorted(p.suffix for p in (tmp_path / "raw/a-b").iterdir() if not p.name.startswith(".")) == [".pdf", ".txt"]
    assert W.export_array(records(spark, record(id="b"), record(id="a")), str(tmp_path / "e.json")) == 2
    assert [r["id"] for r in json.loads((tmp_path / "e.json").read_text())] == ["a", "b"]
    W.append_jsonl(spark.createDataFrame([("u", None)], "url string, lastmod string"), str(tmp_path / "j"))
    assert S.read_jsonl(spark, str(tmp_path / "j"), S.LEDGER_DDL).first()["url"] == "u"


def test_incremental_run(spark, tmp_path):
    source, state = tmp_path / "in", tmp_path / "state"
    write = lambda name, n: spark.range(n).withColumn("input_path", F.lit("clash")).coalesce(1).write.mode("overwrite").parquet(str(source / name))
    write("a", 3)
    run = IncrementalRun(spark, f"file://{source}", f"file://{state}")
    keep = lambda rows: rows.select("id", "input_path")
    with pytest.raises(Exception):
        run.run(lambda rows: rows.select(F.raise_error(F.lit("died"))), "one")
    assert run.manifest().count() == 0  # nothing of a failed batch counts
    assert run.run(keep, "one") == ["one"] and run.output().count() == 3
    assert run.run(keep) == [] and run.output().count() == 3  # nothing new, nothing twice
    write("b", 2)
    run.run(keep)
    assert run.output().count() == 5
    path = next((source / "b").glob("*.parquet"))
    before = path.stat()
    spark.range(7, 9).coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "other"))
    other = next((tmp_path / "other").glob("*.parquet")).read_bytes()
    path.write_bytes(other)  # a file changed in place, its time as before
    os.utime(path, ns=(before.st_atime_ns, before.st_mtime_ns))
    for crc in (source / "b").glob(".*.crc"):
        crc.unlink()
    run.run(keep)
    assert sorted(r["id"] for r in run.output().collect()) == [0, 1, 2, 7, 8]
    path.unlink()
    assert run.output().count() == 3  # a file that is gone counts no more, unless asked for
    run.keep_vanished = True
    assert run.output().count() == 5


def test_incremental_runs_at_once_and_in_batches(spark, tmp_path, monkeypatch):
    from storyloom.operators import incremental as I

    for n in "abc":
        spark.range(2).coalesce(1).write.parquet(str(tmp_path / "in" / n))
    run = I.IncrementalRun(spark, f"file://{tmp_path}/in", f"file://{tmp_path}/state")
    keep = lambda rows: rows.select("id", "input_path")
    monkeypatch.setattr(I, "FILES_PER_BATCH", 2)
    assert len(run.run(keep)) == 2 and run.output().count() == 6 and run.manifest().select("batch_no").distinct().count() == 2
    spark.range(1).coalesce(1).write.parquet(str(tmp_path / "in" / "d"))
    seen = []

    def beaten(rows):  # another run commits the same file while this one works
        if not seen:
            seen.append(1)
            I.IncrementalRun(spark, run.inputs, run.state).run(keep)
        return keep(rows)

    assert run.run(beaten) == [] and run.output().count() == 7


def test_a_run_that_ends_later_counts(spark, tmp_path):
    """An attempt read while its run goes on is done once the run has succeeded, though its file is not read again."""
    from storyloom.operators.incremental import plan_fetch

    def table(name, rows, ddl):
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("overwrite").parquet(str(tmp_path / f"{name}.parquet"))

    table("discovered_urls", [("u", None)], "url string, lastmod string")
    table("fetch_manifest", [("u", 200, None, "2026-01-02T00:00:00Z")], "url string, status int, error string, fetched_at string")
    at = lambda d: datetime.datetime(2026, 1, d)
    runs = "run_id int, stage string, started_at timestamp, status string"
    table("run_log", [(1, "fetch", at(1), "running")], runs)
    state = f"file://{tmp_path}/state"
    assert [r["url"] for r in plan_fetch(spark, f"file://{tmp_path}", state).collect()] == ["u"]
    table("run_log", [(1, "fetch", at(1), "success")], runs)
    assert plan_fetch(spark, f"file://{tmp_path}", state).count() == 0


def test_sitemap_walk_counts_only_read_ones():
    ns = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'
    site = {
        "i": f"<sitemapindex {ns}><sitemap><loc>gone</loc></sitemap><sitemap><loc>a</loc></sitemap><sitemap><loc>i</loc></sitemap><sitemap><loc>b</loc></sitemap></sitemapindex>",
        "a": f"<urlset {ns}><url><loc>a1</loc></url><url><loc>x</loc></url></urlset>", "b": f"<urlset {ns}><url><loc>b1</loc></url></urlset>",
    }
    get = lambda u: (200, site[u], "") if u in site else (404, "", "")
    assert C.walk_sitemaps(["i"], get, lambda u: u != "x") == [("a1", None), ("b1", None)]
    assert C.walk_sitemaps(["i"], get, most=2) == [("a1", None), ("x", None)]
    assert C.walk_sitemaps(["i"], get, enough=1) == [("a1", None)]


def test_unpacked():
    import gzip

    assert H.unpacked(gzip.compress(b"a"), "gzip", "u") == b"a" == H.unpacked(gzip.compress(b"a"), None, "u.gz")
    assert H.unpacked(b"plain", "gzip", "u") == b"plain" and H.unpacked(None, "gzip", "u") is None


def test_cli(spark, tmp_path, sf, capsys):
    from storyloom.cli import main

    (tmp_path / "raw/v").mkdir(parents=True)
    raw = tmp_path / "raw/v/p.html"
    raw.write_text("<title>T</title><body><p>x</p><svg aria-label='workflow'></svg></body>")
    (tmp_path / "d.jsonl").write_text("\n".join(json.dumps({"vendor": "V", "url": u, "lastmod": m}) for u, m in (("a", "2025-01-01"), ("b", None), ("c", "2025-02-01"))))
    (tmp_path / "m.jsonl").write_text(json.dumps({"vendor": "V", "url": "a", "status": 200, "raw_path": str(raw), "sha256": "s", "content_type": "text/html"}) + "\n" + json.dumps({"vendor": "V", "url": "c", "status": 0, "error": "x"}) + "\n")
    ledgers = ["--discovered", str(tmp_path / "d.jsonl"), "--manifest", str(tmp_path / "m.jsonl")]
    main(["fetch-queue", *ledgers, "--out", str(tmp_path / "q")])
    assert sorted(r["url"] for r in spark.read.json(str(tmp_path / "q")).collect()) == ["b", "c"]
    (tmp_path / "r/v").mkdir(parents=True)
    (tmp_path / "r/v/a.json").write_text(json.dumps([record(id="a", vendor=""), record(id="b", slug="b")]))
    main(["extract-queue", *ledgers, "--records", str(tmp_path / "r"), "--out", str(tmp_path / "x")])
    assert [(r["url"], r["published_date"]) for r in spark.read.json(str(tmp_path / "x")).collect()] == [("a", "2025-01-01")]
    (tmp_path / "skill").write_text("SKILL")
    extract = ["extract", *ledgers, "--records", str(tmp_path / "r"), "--skill", str(tmp_path / "skill"), "--taxonomy", str(tmp_path / "skill"), "--out", str(tmp_path / "jobs")]
    main(extract)
    main(extract)
    main([*extract, "--rebuild", "--image-assets-limit", "0"])
    assert [json.loads(x) for x in capsys.readouterr().out.split("\n") if x.startswith("{")] == [{"jobs": 1, "image_assets": 1}, {"jobs": 0, "image_assets": 0}, {"jobs": 1, "image_assets": 0}]
    made = json.loads((tmp_path / "jobs/v/s.json").read_text())
    assert list(made) == "vendor source_url sha256 title raw_path content_type retrieval_source profile extraction_method related_images published_date prompt created_at".split()
    assert made["title"] == "T" and "=== PAGE TEXT ===\nx\n" in made["prompt"] and len(list((tmp_path / "jobs/v/s.assets").glob("*.svg"))) == 1
    main(["validate", "--records", str(tmp_path / "r"), "--out", str(tmp_path / "v")])
    assert [r["id"] for r in spark.read.json(str(tmp_path / "v")).collect()] == ["a"]
    (tmp_path / "r/v/z.json").write_text(json.dumps(record(id="a", vendor="late")))
    main(["merge", "--samples", str(tmp_path / "r/v"), "--records", str(tmp_path / "r"), "--out", str(tmp_path / "all.json")])
    assert [(r["id"], r["vendor"]) for r in json.loads((tmp_path / "all.json").read_text())] == [("a", "late"), ("b", "x")]
    assert json.loads([x for x in capsys.readouterr().out.split("\n") if x.startswith("{")][-1]) == {"samples": 3, "extracted": 3, "total": 2}
    main(["seed", "--records", str(tmp_path / "good"), "--out", str(tmp_path / "store")])
    (tmp_path / "good/v").mkdir(parents=True)
    (tmp_path / "good/v/b.json").write_text(json.dumps(record(id="b", metrics=["z", "y"])))
    main(["seed", "--records", str(tmp_path / "good"), "--out", str(tmp_path / "store")])
    main(["export", "--store", str(tmp_path / "store"), "--out", str(tmp_path / "e.json")])
    assert [(r["id"], r["metrics"], r["maturity_score"]) for r in json.loads((tmp_path / "e.json").read_text())] == [("b", ["y", "z"], 6)]
    main(["clean", "--input", str(raw), "--out", str(tmp_path / "p.txt")])
    assert (tmp_path / "p.txt").read_text() == "# T\n\nx\n"
    main(["run", "a09_unique_vendors", "--tables", sf, "--out", str(tmp_path / "o")])
    assert spark.read.parquet(str(tmp_path / "o")).count() > 0


def test_commands_that_fetch(spark, tmp_path):
    """discover, fetch and probe against a server of our own."""
    import gzip
    import http.server
    import threading

    from storyloom.cli import main

    class Site(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            site = f"http://127.0.0.1:{self.server.server_port}"
            ns = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'
            pages = {"/map.xml": f"<urlset {ns}><url><loc>{site}/blog/1</loc><lastmod>2025-01-01</lastmod></url><url><loc>{site}/about</loc></url></urlset>", "/index": "<a href='/blog/2'>2</a>", "/blog/1": "<p>one</p>", "/blog/2": "<p>two</p>"}
            plain = "bot" not in self.headers["User-Agent"]
            body = gzip.compress(pages.get(self.path, "none").encode())
            self.send_response(403 if self.path == "/blog/2" and plain else 200 if self.path in pages else 404)
            self.send_header("Content-Encoding", "gzip")
            self.send_header("Content-Type", "text/html")
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Site)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        site = f"http://127.0.0.1:{server.server_port}"
        config = {"default_delay_seconds": 0.001, "sources": [{"vendor": "V", "sitemaps": [f"{site}/map.xml"], "index_pages": [f"{site}/index"], "url_patterns": ["/blog/"]}]}
        (tmp_path / "c.json").write_text(json.dumps(config))
        discover = ["discover", "--sources", str(tmp_path / "c.json"), "--out", str(tmp_path / "d"), "--cache-dir", str(tmp_path / "cache")]
        main(discover)
        main(discover)  # known urls are not listed again
        rows = S.read_jsonl(spark, str(tmp_path / "d"), S.LEDGER_DDL)
        assert sorted((r["url"].removeprefix(site), r["source"], r["lastmod"]) for r in rows.collect()) == [("/blog/1", "sitemap", "2025-01-01"), ("/blog/2", "index", None)]
        assert len(list((tmp_path / "cache").iterdir())) == 2
        fetch = ["fetch", "--discovered", str(tmp_path / "d"), "--manifest", str(tmp_path / "m"), "--raw-root", str(tmp_path / "raw"), "--sources", str(tmp_path / "c.json")]
        main(fetch)
        main(fetch)
        got = {r["url"].removeprefix(site): r for r in S.read_jsonl(spark, str(tmp_path / "m"), S.MANIFEST_DDL).collect()}
        assert {u: (r["status"], r["profile"]) for u, r in got.items()} == {"/blog/1": (200, "default"), "/blog/2": (200, "bingbot")}
        with open(got["/blog/2"]["raw_path"]) as f:
            assert f.read() == "<p>two</p>"
        (tmp_path / "s.json").write_text(json.dumps({"hosts": [{"host": "z.example", "strategy": "reader", "kind": "reader"}]}))
        main(["probe", f"{site}/blog/2", "--out", str(tmp_path / "s.json")])
        assert [h["strategy"] for h in json.loads((tmp_path / "s.json").read_text())["hosts"]] == ["bingbot", "reader"]
    finally:
        server.shutdown()


def test_checked_limits():
    assert C.checked_limits(0, 4.0, 8) == (0, 4.0, 8)
    for bad in ((-1, 4, 8), (0, 0, 8), (0, 4, 0)):
        with pytest.raises(ValueError):
            C.checked_limits(*bad)


def test_stream(spark, tmp_path):
    from storyloom.streaming import ledger as L

    rows = [("v", "u", "2026-01-01T00:00:00+00:00", "index", None), ("v", "u", "2026-01-01T00:01:00+00:00", "index", None), ("v", "w", "bad", "index", None), ("v", "x", "2026-01-01T00:01:00+00:00", "index", None)]
    spark.createDataFrame(rows, S.LEDGER_DDL).coalesce(1).write.parquet(str(tmp_path / "in"))
    q = L.append_batches(L.first_seen(L.ledger_stream(spark, str(tmp_path / "in"))), str(tmp_path / "out"), str(tmp_path / "check"))
    q.awaitTermination(120)
    assert sorted(r["url"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["u", "x"]


def test_locale_order_decides_ties(spark):
    values = spark.createDataFrame([(x,) for x in "Zebra apple Äpfel Apple".split()], "label string")
    assert [r["label"] for r in A.top_values(values, 3, locale=True).collect()] == ["Äpfel", "apple", "Apple"]
    assert [r["label"] for r in A.top_values(values, 3).collect()] == ["Apple", "Zebra", "apple"]
    tags = values.groupBy().agg(F.collect_list("label").alias("t"))
    assert [r["label"] for r in A.matrix_columns(tags, "t", 2, locale=True).collect()] == ["Äpfel", "apple"]


def test_ranked_over_ranges(spark):
    rows = spark.createDataFrame([("hot", i) for i in range(500)] + [("b", 1), (None, 2), (None, 1)], "k string, n int").repartition(5)
    got = {(r["k"], r["n"]): r["rank"] for r in A.ranked(rows, "k", ["n"]).collect()}
    assert all(got[("hot", i)] == i + 1 for i in range(500)) and got[("b", 1)] == 1 and got[(None, 2)] == 2


def test_store_refuses_slugs_of_two_ids(spark, tmp_path):
    store = W.RecordStore(spark, str(tmp_path / "s"))
    store.create()
    with pytest.raises(ValueError, match="claimed"):
        store.seed(records(spark, record(id="a"), record(id="b")))
    assert store.parents().count() == 0 and store.seed(records(spark, record(id="a"))) == 1 and store.children().count() == 7


def test_writers_replace_or_keep(spark, tmp_path):
    rows = spark.createDataFrame([("A b", "s1", "x")], "vendor string, sha256 string, title string")
    assert [r["written"] for _ in range(2) for r in W.write_bundles(rows, str(tmp_path / "b")).collect()] == [True, False]
    assert W.write_bundles(rows.withColumn("title", F.lit("y")), str(tmp_path / "b"), rebuild=True).first()["written"]
    assert json.loads((tmp_path / "b/a-b/s1.json").read_text())["title"] == "y"


def test_work_is_cleared(spark):
    from storyloom.session import clear_work, materialize

    kept = materialize(spark.range(3), "cleared")
    assert kept.count() == 3
    clear_work(spark)
    assert not os.path.exists(kept.inputFiles()[0].removeprefix("file://"))


def test_library_does_not_need_llm(tmp_path):
    """A copy without the subpackage imports and has its queries."""
    root = pathlib.Path(__file__).parent.parent
    shutil.copytree(root / "storyloom", tmp_path / "storyloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; assert e.llm is None and len(e.queries()) > 90 and not any(q.startswith(('p1_', 'p2_')) for q in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
