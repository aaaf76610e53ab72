"""Scalar text, date, url and byte functions as Column expressions: all run inside the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: markers, patterns and suffixes that results must agree on ---
BLOCKED_STATUSES = (401, 403, 429, 451, 503)
BLOCKED_MARKERS = (
    "datadome", "please enable js", "cf-browser-verification", "just a moment...", "access denied", "attention required! | cloudflare",
    "checking your browser before accessing", "enable cookies", "bot detection", "captcha", "perimeterx", "px-captcha", "incapsula", "imperva",
)
HTML_MARKERS = ("<html", "<!doctype html", "<article", "<main", "<body")
BOILERPLATE = (
    r"^skip to (main )?content$", r"^(menu|open menu|close menu)$", r"^(sign in|log in)$", r"^(accept|reject|allow|deny)( all)? cookies?$",
    r"^(manage|customize|change|set) (cookies?|preferences|privacy settings)$", r"^we use cookies\b.{0,220}$", r"^this (site|website) uses cookies\b.{0,220}$",
    r"^(subscribe|sign up) (to|for) (our|the) newsletter\.?$", r"^share this (article|post|page)$", r"^advertisement$", r"^sponsored( content)?$",
    r"^(related|recommended) (articles|posts|content)$", r"^(read more|learn more)$", r"^all rights reserved\.?$",
)
TWO_PART_SUFFIXES = (
    "co.uk org.uk gov.uk ac.uk plc.uk co.jp or.jp ne.jp ac.jp go.jp com.au org.au gov.au edu.au net.au co.in org.in gov.in ac.in net.in "
    "com.cn org.cn gov.cn edu.cn net.cn com.hk org.hk gov.hk com.sg org.sg com.br gov.br co.kr or.kr go.kr co.nz govt.nz org.nz"
).split()
IMAGE_TYPES = {
    "image/avif": ".avif", "image/gif": ".gif", "image/jpeg": ".jpg", "image/jpg": ".jpg", "image/png": ".png", "image/svg+xml": ".svg", "image/webp": ".webp",
}
IMAGE_ENDINGS = (".avif", ".gif", ".jpg", ".jpeg", ".png", ".svg", ".webp")
EDGE_BLANKS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
READER_PREFIX, ARCHIVE_PREFIX = "https://r.jina.ai/http://", "https://web.archive.org/web/"
# --- end of fixed values ---


def slugify(c: Column) -> Column:
    """Lower case, runs of anything but a-z and 0-9 as one dash, no dash at the ends; untitled if nothing is left. Null stays null."""
    slug = F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(slug == "", F.lit("untitled")).otherwise(slug)


def lastmod_text(c: Column) -> Column:
    """The first ten characters of a trimmed lastmod; shorter ones stay as they are."""
    return F.substring(F.trim(c), 1, 10)


def truthy(c: Column) -> Column:
    """A text that is not empty. Null is not."""
    return F.coalesce(c != "", F.lit(False))


def filled(c: Column) -> Column:
    """An array that is not empty. Null is not."""
    return F.coalesce(F.size(c) > 0, F.lit(False))


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def inline_text(c: Column, limit: int = 360) -> Column:
    """White space collapsed; cut at limit, without blanks at the cut, followed by three dots."""
    text = F.coalesce(collapse(c), F.lit(""))
    return F.when(F.length(text) > limit, F.concat(F.rtrim(F.substring(text, 1, limit)), F.lit("..."))).otherwise(text)


def truncated(c: Column, limit: int = 18000, marker: str = "\n...[truncated]") -> Column:
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit), F.lit(marker))).otherwise(c)


def line_key(c: Column) -> Column:
    """Lower case, runs of anything but letters, numbers and underscores of any script as one blank."""
    return F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}_]+", " "))


def white_space(c: Column) -> Column:
    """Blanks collapsed, none around line breaks, at most one empty line in a row."""
    c = F.regexp_replace(c, r"[ \t\f\x0B]+", " ")
    c = F.regexp_replace(c, r" *\n *", "\n")
    return F.regexp_replace(c, r"\n{3,}", "\n\n")


def lines(c: Column) -> Column:
    """Lines as Python's splitlines cuts them."""
    return F.split(c, r"\r\n|[\n\r\x0B\f\x1c\x1d\x1e\x85  ]")


def is_boilerplate(line: Column) -> Column:
    return line.rlike("(?iu)" + "|".join(f"(?:{p})" for p in BOILERPLATE))


def clean_text(c: Column) -> Column:
    """White space normalised, boilerplate lines dropped, short lines kept once, runs of blank lines as one.

    A line is short if its key has at most 80 characters. Of lines with one short key the first stays: lines are sorted by key
    and place, each is compared with the one before it, and what is left is put back in order, so a text of n lines takes
    n log n steps inside the JVM. Null stays null."""
    rows = F.transform(lines(white_space(c)), lambda x, i: F.struct(F.regexp_replace(x, EDGE_BLANKS, "").alias("line"), i.alias("i")))
    kept = F.filter(rows, lambda r: (r["line"] == "") | ~is_boilerplate(r["line"]))

    keyed = F.transform(kept, lambda r: F.struct(line_key(r["line"]).alias("key"), r["i"].alias("i"), r["line"].alias("line")))

    def own_key(r: Column) -> Column:
        once = (r["line"] == "") | (F.length(r["key"]) > 80)  # never compared: a key of its own
        return F.struct(F.when(once, F.concat(F.lit("\n"), r["i"].cast("string"))).otherwise(r["key"]).alias("key"), r["i"].alias("i"), r["line"].alias("line"))

    ordered = F.array_sort(F.transform(keyed, own_key))
    before = F.concat(F.array(F.lit(None).cast("string")), F.transform(ordered, lambda r: r["key"]))
    paired = F.zip_with(ordered, before, lambda r, k: F.struct(r["i"].alias("i"), r["line"].alias("line"), (~r["key"].eqNullSafe(k)).alias("first")))
    first = F.array_sort(F.filter(paired, lambda r: r["i"].isNotNull() & r["first"]))
    text = F.array_join(F.transform(first, lambda r: r["line"]), "\n")
    return F.regexp_replace(F.regexp_replace(text, r"\n{3,}", "\n\n"), EDGE_BLANKS, "")


def first_integer(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"\d+", 0), F.lit("")).try_cast("int")


def css_urls(style: Column) -> Column:
    """The addresses in a style text's url(...) in their order."""
    return F.transform(F.regexp_extract_all(style, F.lit(r"(?i)url\((['\"]?)(.*?)\1\)"), 2), lambda x: F.trim(x))


def percent(c: Column) -> Column:
    """A share as a whole percentage, halves rounded up."""
    return F.concat(F.floor(c * 100 + 0.5).cast("string"), F.lit("%"))


def iso_date(c: Column) -> Column:
    """The timestamp of an ISO date text that exists in the calendar, else null."""
    ok = c.rlike(r"^\d{4}(-\d{2}(-\d{2}.*)?)?$")
    return F.when(ok, F.coalesce(F.try_to_timestamp(F.substring(c, 1, 10), F.lit("yyyy-MM-dd")), F.try_to_timestamp(c, F.lit("yyyy-MM")), F.try_to_timestamp(c, F.lit("yyyy"))))


def date_label(c: Column) -> Column:
    """Mon D, YYYY of an ISO date; other texts as they are; a dash for none."""
    d = iso_date(c)
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit("—")).when(d.isNotNull(), F.date_format(d, "MMM d, yyyy")).otherwise(c)


def host(url: Column) -> Column:
    """Host of an address in lower case, with its port; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))


def registrable_domain(h: Column) -> Column:
    parts = F.filter(F.split(F.lower(h), r"\."), lambda x: x != "")
    n = F.size(parts)
    two = F.array_join(F.slice(parts, F.greatest(n - 1, F.lit(1)), F.lit(2)), ".")
    three = F.array_join(F.slice(parts, F.greatest(n - 2, F.lit(1)), F.lit(3)), ".")
    return F.when(n < 2, F.lit(None).cast("string")).when((n >= 3) & two.isin(TWO_PART_SUFFIXES), three).otherwise(two)


def www_toggled(h: Column) -> Column:
    return F.when(h.startswith("www."), F.substring(h, 5, 10_000)).otherwise(F.concat(F.lit("www."), h))


def reader_url(url: Column) -> Column:
    return F.concat(F.lit(READER_PREFIX), url)


def archive_url(url: Column, year: Column) -> Column:
    return F.concat(F.lit(ARCHIVE_PREFIX), year.cast("string"), F.lit("/"), url)


def raw_suffix(content_type: Column) -> Column:
    t = F.lower(F.coalesce(content_type, F.lit("")))
    return F.when(t.contains("pdf"), ".pdf").when(t.contains("json"), ".json").when(t.startswith("text/plain"), ".txt").otherwise(".html")


def looks_like_pdf(body: Column, content_type: Column) -> Column:
    """body: text or bytes."""
    return F.lower(F.coalesce(content_type, F.lit(""))).contains("pdf") | F.coalesce(F.substring(body, 1, 1024).cast("string").contains("%PDF-"), F.lit(False))


def looks_like_html(text: Column, content_type: Column) -> Column:
    t = F.lower(F.coalesce(content_type, F.lit("")))
    head = F.lower(F.substring(F.coalesce(text, F.lit("")), 1, 2048))
    hit = F.lit(False)
    for m in HTML_MARKERS:
        hit = hit | head.contains(m)
    return t.contains("html") | t.contains("xml") | hit


def looks_blocked(status: Column, body: Column) -> Column:
    head = F.lower(F.substring(F.coalesce(body, F.lit("")), 1, 4000))
    any_marker = "|".join(re.sub(r"([.|])", r"\\\1", m) for m in BLOCKED_MARKERS)  # one pass over one lowered text
    return F.coalesce(status.isin(*BLOCKED_STATUSES), F.lit(False)) | head.rlike(any_marker)


def is_blocked(status: int, body: bytes | None) -> bool:
    """looks_blocked of an answer on its way in."""
    head = bytes(body or b"")[:4000].decode("utf-8", "ignore").lower()
    return status in BLOCKED_STATUSES or any(m in head for m in BLOCKED_MARKERS)


def fetch_succeeded(status: Column, body: Column) -> Column:
    return F.coalesce(status.between(200, 399), F.lit(False)) & ~looks_blocked(status, body)


def digest16(c: Column) -> Column:
    return F.substring(F.sha2(c, 256), 1, 16)


def has_any(c: Column, words) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | c.contains(w)
    return out


def image_kind(body: Column) -> Column:
    """Suffix by signature of binary data: png, jpg, gif, webp, avif or svg; null if none fits."""
    h = F.hex(F.substring(body, 1, 32))
    head = F.lower(F.ltrim(F.substring(body, 1, 1024).cast("string")))
    svg = (head.startswith("<svg") | head.startswith("<?xml")) & head.contains("<svg")
    return (
        F.when(h.startswith("89504E470D0A1A0A"), ".png").when(h.startswith("FFD8FF"), ".jpg").when(h.startswith("474946383761") | h.startswith("474946383961"), ".gif")
        .when(h.startswith("52494646") & F.substring(h, 1, 32).contains("57454250"), ".webp").when(h.contains("6674797061766966"), ".avif").when(svg, ".svg")
    )


def _bare_type(content_type: Column) -> Column:
    return F.lower(F.trim(F.substring_index(F.coalesce(content_type, F.lit("")), ";", 1)))


def _head(body: Column) -> Column:
    """The first characters of a body in lower case, without blanks in front."""
    return F.lower(F.regexp_replace(F.substring(body, 1, 4096).cast("string"), r"^\s+", ""))


def is_error_document(body: Column) -> Column:
    """A page or JSON text in place of what was asked for."""
    return F.coalesce(_head(body).rlike(r"^(?:<!doctype|<html|<head|<body|\{|\[)"), F.lit(False))


def url_image_suffix(url: Column) -> Column:
    """The ending of an address's path if images have it, else null."""
    ending = F.lower(F.regexp_extract(F.regexp_extract(F.coalesce(url, F.lit("")), r"^([^?#]*)", 1), r"(\.[A-Za-z0-9]+)$", 1))
    return F.when(ending.isin(*IMAGE_ENDINGS), ending)


def is_image(body: Column, content_type: Column, url: Column) -> Column:
    """Whether an answer is an image: no error document, and one by its type, its signature, as svg or by its address."""
    by_body = image_kind(body).isNotNull() | F.coalesce(F.substring(_head(body), 1, 512).contains("<svg"), F.lit(False))
    return ~is_error_document(body) & (_bare_type(content_type).startswith("image/") | by_body | url_image_suffix(url).isNotNull())


def image_suffix(body: Column, content_type: Column, url: Column) -> Column:
    """Suffix of an image by signature, svg text, type, address; .bin if none tells."""
    by_type = F.lit(None).cast("string")
    for kind, suffix in IMAGE_TYPES.items():
        by_type = F.when(_bare_type(content_type) == kind, suffix).otherwise(by_type)
    return F.coalesce(image_kind(body), by_type, url_image_suffix(url), F.lit(".bin"))


def filled_template(template: str, **values: Column) -> Column:
    """A template with its {name} parts replaced; empty and null values leave nothing."""
    parts = [F.coalesce(values[x], F.lit("")) if i % 2 else F.lit(x) for i, x in enumerate(re.split(r"\{(\w+)\}", template))]
    return F.concat(*parts)


def titled(title: Column) -> Column:
    return F.coalesce(F.nullif(title, F.lit("")), F.lit("(no title)"))


def banner(records: Column, samples: Column) -> Column:
    """How many records there are, and how many of them are samples."""
    noun = lambda n: F.when(n == 1, "record").otherwise("records")
    real = F.concat((records - samples).cast("string"), F.lit(" extracted and "), samples.cast("string"), F.lit(" sample"))
    return F.concat(records.cast("string"), F.lit(" "), noun(records), F.when(samples > 0, F.concat(F.lit(": "), real)).otherwise(F.lit("")))


def utc_now() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
