"""Main text of stored pages by consensus host paths.

Pass 1 parses every page into text lines with the tag-class path of their container, scores each page's containers by
link-free prose and lets every page vote for its best one; votes and line statistics are added up per host in Spark.
Pass 2 parses the pages again and keeps the lines that stand in the winning container, without the leaves that the host's
pages fill with the same few texts (share bars, calls to action). Class names lose their digits, so that numbered classes
of one template fall together. Pages delivered as plain text by a reader service carry no tags and are cut by layout.

A container is a story path where it wins on a share of its host's pages, or on most of the pages that hold it, however few
these are: rare designs have their own paths. A page with none of these is read by its own best container,
leaving aside those whose innermost tag and class mostly hold prose beside a better one: furniture is no story, however nested.

Null or empty bodies give no line. A host of which too few lines are known falls back to the statistics of all hosts.
"""

from __future__ import annotations

import html
import math
import pickle
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, spread
from . import residue

TAG = re.compile(r"<!--.*?-->|<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:\"[^\"]*\"|'[^']*'|[^<>\"'])*)>")
#: One element with bare text, one with only a link: most lines of most pages.
PLAIN = re.compile(r"<(p|li|h[1-6]|span|blockquote|div|td)((?: [^<>]*)?)>([^<]*)</\1>$")
LINK = re.compile(r"<(li|span|div|td|p)((?: [^<>]*)?)><a [^<>]*>([^<]*)</a></\1>$")
ANCHOR = re.compile(r"<a [^<>]*>([^<]*)</a>$")
CLASS = re.compile(r"\bclass\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
DIGITS = re.compile(r"\d+")
NUMBER = re.compile(r"\d[\d.,:]*")
MARKUP = re.compile(r"<(?:html|!doctype|body)\b", re.I)
FRAGMENT = re.compile(r"^\s*</?(?:div|section|article|main|p|ul|ol|li|h[1-6]|table|tr|td|nav|header|footer|figure)\b[^<>]*>", re.I | re.M)
INLINE = frozenset("a abbr b big cite code em font i img input br hr small strong sub sup u wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset(("script", "style", "title", "template"))
CLOSES = {"li": ("li",), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr", "td", "th"), "dt": ("dt", "dd"), "dd": ("dt", "dd")}
READER_LINK = re.compile(r"!?\[([^\]]*)\]\((?:[^()\s]|\([^()]*\))*\)")
READER_MARK = re.compile(r"^(?:#{1,6}|[-*+]|>|\||\d+[.)])\s+")
WORD = re.compile(r"\w+")

BITS = 512
N_LONGS = BITS // 64
#: A leaf that holds at most so many different texts, each several times, is a fixed part of the site.
FEW_TEXTS, REPEATS = 11, 5
#: Below so many lines a host's own statistics of a leaf are not trusted.
ENOUGH_LINES = 50
#: A leaf that comes after the story in this share of its lines is no part of it; its own lines count from so many on.
TAIL_SHARE, ENOUGH_TAIL = 0.9, 8
#: A container must win on this share of a host's pages to count as one of its story paths, or on so many and on this share
#: of the pages where it holds prose (those of its own design).
WIN_SHARE = 0.05
ENOUGH_WINS, OWN_SHARE = 5, 0.5
#: Statistics that are turned into rules on the driver and sent to all executors; beyond it hosts get their rules in Spark and
#: pages meet them in a join. The rules are the same.
MAX_RULES = 200_000


def generalise(tag: str, attrs: str) -> str:
    """tag.class with digits as #: the step of a tag-class path."""
    m = CLASS.search(attrs) if attrs else None
    if not m:
        return tag
    name = " ".join((m[1] or m[2] or m[3] or "").lower().split())
    return f"{tag}.{DIGITS.sub('#', name)}" if name else tag


def is_markup(body: str) -> bool:
    """Whether a page is written in tags: not begun as the reader service begins, it says so anywhere (comments may come first)
    or is a fragment with lines that start with block elements."""
    if body.lstrip().startswith(("Title:", "# ")):
        return False
    return bool(MARKUP.search(body)) or len(FRAGMENT.findall(body)) >= 2


def parse_markup(body: str) -> list[tuple[int, str, str, str, bool]]:
    """(line number, container path, leaf, text, only a link) of every line with text after the head.

    A leaf is what the line itself opens before its text; the container is what was open before the line."""
    out: list[tuple[int, str, str, str, bool]] = []
    stack: list[str] = []
    tags: list[str] = []
    path, hidden, in_head, links = "", "", "<body" in body.lower(), 0
    unescape = html.unescape
    for no, line in enumerate(body.split("\n"), 1):
        line = line.strip()
        if not line:
            continue
        if in_head:
            if "<body" not in line.lower():
                continue
            in_head = False
            line = line[line.lower().index("<body") :]
        if not hidden and not links:
            kind, m = (False, PLAIN.match(line)) if line[0] == "<" else (False, None)
            if m is None and line[0] == "<":
                kind, m = True, LINK.match(line)
                if m is None and (m := ANCHOR.match(line)) and (not tags or tags[-1] != "p"):
                    if text := unescape(m[1]).strip():
                        out.append((no, path, "a", text, True))
                    continue
            if m is not None and m.lastindex == 3:
                if tags and tags[-1] == "p":
                    tags.pop(), stack.pop()
                    path = "/".join(stack)
                if text := unescape(m[3]).strip():
                    out.append((no, path, generalise(m[1], m[2]), text, kind))
                continue
        if tags and tags[-1] == "p" and (m := TAG.match(line)) and m[2] and m[2].lower() not in INLINE:
            tags.pop(), stack.pop()
            path = "/".join(stack)
        container, leaf, pieces, linked, changed, opened = path, None, [], 0, False, 0
        pos = 0
        for m in TAG.finditer(line):
            piece = line[pos : m.start()]
            pos = m.end()
            if piece and not hidden and piece.strip():
                if leaf is None:
                    leaf = "/".join(stack[len(stack) - opened :]) if opened else "a" if links else "#text"
                pieces.append(piece)
                if links:
                    linked += len(piece.strip())
            if not m[2]:
                continue
            tag = m[2].lower()
            if hidden:
                if m[1] and tag == hidden:
                    hidden = ""
                continue
            if tag in HIDDEN:
                hidden = "" if m[1] else tag
                continue
            if tag == "a":
                links = max(0, links - 1) if m[1] else 1
                continue
            if tag in VOID or tag in INLINE or tag in ("html", "body"):
                continue
            if m[1]:
                if tag in tags:
                    while True:
                        last = tags.pop()
                        stack.pop()
                        opened = max(0, opened - 1)
                        if last == tag:
                            break
                    changed = True
                continue
            for shut in CLOSES.get(tag, ()):
                if tags and tags[-1] == shut:
                    tags.pop(), stack.pop()
                    opened = max(0, opened - 1)
            tags.append(tag)
            stack.append(generalise(tag, m[3]))
            opened += 1
            changed = True
        piece = line[pos:]
        if piece.strip() and not hidden:
            if leaf is None:
                leaf = "/".join(stack[len(stack) - opened :]) if opened else "a" if links else "#text"
            pieces.append(piece)
            if links:
                linked += len(piece.strip())
        links = 0
        if changed:
            path = "/".join(stack)
        if pieces:
            text = unescape("".join(pieces)).strip()
            if text:
                out.append((no, container, leaf or "#text", text, linked >= 0.9 * len(text)))
    return out


def reader_story(body: str) -> list[tuple[int, str]]:
    """(line number, text) of the story in a page delivered as plain text.

    The reader service writes a header, the site's lines one below the other, and the story's blocks each followed by a
    blank line; lists stand without blanks. The story begins at its headline; later lines that neither end a block nor
    belong to a list are the site's."""
    lines = body.split("\n")
    start = next((i for i, x in enumerate(lines) if x.startswith("# ")), None)
    if start is None:
        return []
    out = []
    for i in range(start, len(lines)):
        line = lines[i].strip()
        if not line:
            continue
        listed = line.startswith(("-   ", "- ", "| ")) and not READER_LINK.fullmatch(line[2:].strip())
        ends = i + 1 < len(lines) and not lines[i + 1].strip() and any(x.strip() for x in lines[i + 1 :])
        if not (listed or ends):
            continue
        if not listed and READER_LINK.fullmatch(line):
            continue
        text = READER_MARK.sub("", READER_LINK.sub(r"\1", line)).strip()
        if WORD.search(text):
            out.append((i + 1, text))
    return out


def prose_words(text: str) -> int:
    n = text.count(" ") + 1
    return n if n >= 6 else 0


def page_scores(lines: list[tuple[int, str, str, str, bool]]) -> dict[str, float]:
    """Score of each container of a page: words of link-free prose directly in it, lowered by its share of link lines."""
    words: dict[str, int] = defaultdict(int)
    count: dict[str, int] = defaultdict(int)
    linked: dict[str, int] = defaultdict(int)
    for _, container, leaf, text, link in lines:
        if leaf == "noscript":
            continue
        count[container] += 1
        if link:
            linked[container] += 1
        else:
            words[container] += prose_words(text)
    return {c: w * (1 - linked[c] / count[c]) ** 2 for c, w in words.items()}


def best_container(scores: dict[str, float]) -> str | None:
    best = max(scores.items(), key=lambda x: (x[1], x[0]), default=(None, 0))
    return best[0] if best[1] > 0 else None


def trailing(lines: list[tuple[int, str, str, str, bool]]) -> list[tuple[int, str, str, str, bool]]:
    """Lines after the last line of the leaf that holds most of their container's words."""
    words: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(int))
    last: dict[tuple[str, str], int] = {}
    for i, (_, c, leaf, text, _) in enumerate(lines):
        words[c][leaf] += text.count(" ") + 1
        last[(c, leaf)] = i
    end = {c: last[(c, max(w.items(), key=lambda x: (x[1], x[0]))[0])] for c, w in words.items()}
    return [x for i, x in enumerate(lines) if i > end[x[1]]]


def masked(text: str, host: str) -> str:
    return NUMBER.sub("0", text.replace(host, "\0") if host else text)


COUNTS = ("n", "links", "digits", "tail", "wins")
STATS = ["host", "container", "leaf", "n", "links", "digits", "tail", "wins"] + [f"b{i}" for i in range(N_LONGS)]
STATS_DDL = "host string, container string, leaf string, n bigint, links bigint, digits bigint, tail bigint, wins bigint, " + ", ".join(f"b{i} bigint" for i in range(N_LONGS))
#: The container under which pages per exemplar word are counted; all pages are counted under the word ''.
WORDS = "\1words"
FLUSH = 100_000


def _stat_rows(acc: dict, wins: dict) -> pd.DataFrame:
    rows = []
    mask = (1 << 64) - 1
    for (host, container, leaf), v in acc.items():
        longs = [(v[4] >> (64 * i)) & mask for i in range(N_LONGS)]
        rows.append([host, container, leaf, v[0], v[1], v[2], v[3], 0, *(x - (1 << 64) if x >> 63 else x for x in longs)])
    rows += [[host, container, "", held, 0, 0, 0, n, *[0] * N_LONGS] for (host, container), (held, n) in wins.items()]
    return pd.DataFrame(rows, columns=STATS)


def _gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    acc: dict = {}
    wins: dict = defaultdict(lambda: [0, 0])  # pages with prose in the container, votes
    counts: dict = defaultdict(int)
    spelled = residue.vocabulary()
    known = frozenset(spelled)
    for pdf in batches:
        for host, body in zip(pdf["host"], pdf["body"]):
            if not body:
                continue
            counts[""] += 1
            if not is_markup(body):
                for w in {spelled[w] for w in known.intersection(body.lower().split())}:
                    counts[w] += 1
                continue
            lines = parse_markup(body)
            seen: set[str] = set()
            for line in lines:
                seen.update(line[3].lower().split())
            for w in {spelled[w] for w in known & seen}:
                counts[w] += 1
            for _, container, leaf, text, link in lines:
                key = (host, container, leaf)
                v = acc.get(key)
                if v is None:
                    v = acc[key] = [0, 0, 0, 0, 0]
                v[0] += 1
                v[1] += link
                template = masked(text, host)
                v[2] += template != text and "0" in template
                v[4] |= 1 << (zlib.crc32(template.encode()) % BITS)
            for _, container, leaf, _, _ in trailing(lines):
                acc[(host, container, leaf)][3] += 1
            scores = page_scores(lines)
            for container, score in scores.items():
                if score > 0:
                    wins[(host, container)][0] += 1
            if best := best_container(scores):
                wins[(host, best)][1] += 1
        if len(acc) + len(wins) > FLUSH:
            yield _stat_rows(acc, wins)
            acc, wins = {}, defaultdict(lambda: [0, 0])
    if acc or wins:
        yield _stat_rows(acc, wins)
    if counts:
        rows = [["", WORDS, w, n, 0, 0, 0, 0, *[0] * N_LONGS] for w, n in counts.items()]
        yield pd.DataFrame(rows, columns=STATS)


def path_statistics(pages: DataFrame) -> DataFrame:
    """Per host, container and leaf: lines, link lines, lines with numbers, lines after the container's main text, page votes
    (leaf '': n is the pages with prose in the container) and a bitmap of the texts seen.

    pages: host, body. Summed inside each partition first, so what is shuffled grows with hosts and paths, not pages."""
    sums = [F.sum(c).alias(c) for c in COUNTS]
    return pages.select("host", "body").mapInPandas(_gather, STATS_DDL).groupBy("host", "container", "leaf").agg(*sums, *[F.expr(f"bit_or(b{i})").alias(f"b{i}") for i in range(N_LONGS)])


def different(bitmap: int) -> float:
    """Estimate of the different texts behind a bitmap (linear counting)."""
    empty = BITS - bitmap.bit_count()
    return BITS * math.log(BITS / empty) if empty else float(BITS) * 10


def signature(leaf: str) -> str:
    return re.sub(r"\.[^/]*", ".*", leaf)


def step(container: str) -> str:
    return container.rpartition("/")[2]


def host_votes(stats: list) -> tuple[dict, dict, dict]:
    """(host -> votes and leaves, host -> story containers with their votes, host -> steps a page may fall back to)."""
    by_host: dict = defaultdict(lambda: [defaultdict(lambda: [0, 0]), {}])
    for r in stats:
        if r["leaf"] == "":
            v = by_host[r["host"]][0][r["container"]]
            v[0] += r["n"]
            v[1] += r["wins"]
        else:
            bitmap = 0
            for i in range(N_LONGS):
                bitmap |= (r[f"b{i}"] & ((1 << 64) - 1)) << (64 * i)
            by_host[r["host"]][1][(r["container"], r["leaf"])] = (r["n"], r["links"], r["digits"], r["tail"], bitmap)
    winners: dict = {}
    fallback: dict = {}
    for host, (votes, leaves) in by_host.items():
        total = sum(n for _, n in votes.values())
        won = {c: n for c, (held, n) in votes.items() if n and (n >= WIN_SHARE * total or (n >= ENOUGH_WINS and n >= OWN_SHARE * held))}
        winners[host] = won
        by_step: dict = defaultdict(lambda: [0, 0])
        for c, (held, n) in votes.items():
            by_step[step(c)][0] += held
            by_step[step(c)][1] += n
        fallback[host] = {c for c, (held, n) in by_step.items() if n and n >= OWN_SHARE * held}
    return by_host, winners, fallback


def leaf_sums(by_host: dict, winners: dict, into: dict | None = None) -> dict:
    """Leaf signature -> statistics over the story containers of all hosts, added to those of other hosts."""
    everywhere: dict = defaultdict(lambda: [0, 0, 0, 0, 0]) if into is None else into
    for host, (_, leaves) in by_host.items():
        for (container, leaf), v in leaves.items():
            if container in winners[host]:
                e = everywhere[signature(leaf)]
                for i in range(4):
                    e[i] += v[i]
                e[4] |= v[4]
    return everywhere


def make_rules(stats: list, whole: dict | None = None) -> dict:
    """host -> (story containers with their votes, (container, leaf) kept or not, steps a page may fall back to).

    whole: leaf_sums over all hosts, where these are a part of them. Under the host None: whether a leaf signature is kept where a page is read by its own best container."""
    by_host, winners, fallback = host_votes(stats)
    everywhere = leaf_sums(by_host, winners) if whole is None else whole
    rules: dict = {None: {leaf: kept(leaf, v, v) for leaf, v in everywhere.items()}}
    for host, (_, leaves) in by_host.items():
        keep = {(c, leaf): kept(signature(leaf), v, everywhere[signature(leaf)]) for (c, leaf), v in leaves.items() if c in winners[host]}
        rules[host] = (winners[host], keep, fallback[host])
    return rules


def kept(leaf: str, own: tuple | list, all_hosts: tuple | list) -> bool:
    """Whether lines of a leaf signature are story: by its own statistics, or those of all hosts where it has few lines."""
    last = leaf.rpartition("/")[2]
    if re.fullmatch("h[1-6]", last):
        return True
    n, links, digits, _, bitmap = own if own[0] >= ENOUGH_LINES else all_hosts
    few = different(bitmap)
    fixed = few < FEW_TEXTS and n >= REPEATS * few and digits < 0.5 * n
    after = own[3] >= TAIL_SHARE * own[0] if own[0] >= ENOUGH_TAIL else all_hosts[3] >= TAIL_SHARE * all_hosts[0]
    return last != "noscript" and not fixed and not after and links < 0.5 * n


def story_lines(host: str, body: str | None, rules: dict, known: residue.Index) -> list[tuple[int, str]]:
    """(line number, text) of the page's own story; nothing for error pages and calls for scripts."""
    lines = raw_story(host, body, rules)
    return [] if lines and residue.is_notice_page([t for _, t in lines], known) else lines


def raw_story(host: str, body: str | None, rules: dict) -> list[tuple[int, str]]:
    if not body:
        return []
    if not is_markup(body):
        return reader_story(body)
    winners, keep, fallback = rules.get(host, ({}, {}, set()))
    lines = parse_markup(body)
    here = {c for _, c, _, _, _ in lines if c in winners}
    scores = page_scores(lines) if len(here) != 1 else {}
    if not here:
        best, by_leaf = best_container({c: x for c, x in scores.items() if step(c) in fallback}), rules.get(None, {})
        return [(no, text) for no, c, leaf, text, link in lines if c == best and not link and leaf != "noscript" and by_leaf.get(signature(leaf), True) and WORD.search(text)]
    if len(here) > 1:
        here = {max(here, key=lambda c: (scores.get(c, 0), winners[c], c))}
    return [(no, text) for no, c, leaf, text, link in lines if c in here and not link and keep.get((c, leaf), False) and WORD.search(text)]


def host_of(vendor: Column, raw_path: Column) -> Column:
    """The site of a page: its vendor, else the folder its content lies in."""
    return F.coalesce(F.nullif(F.trim(vendor), F.lit("")), F.try_element_at(F.split(raw_path, "/"), F.lit(-2)), F.lit(""))


def host_pages(raw_pages: DataFrame) -> DataFrame:
    return spread(raw_pages.select("raw_path", host_of(F.col("vendor"), F.col("raw_path")).alias("host"), "body"))


LEAF_SUMS = "signature string, n bigint, links bigint, digits bigint, tail bigint, " + ", ".join(f"b{i} bigint" for i in range(N_LONGS))


def _host_leaves(pdf: pd.DataFrame) -> pd.DataFrame:
    """The leaf_sums of one host's statistics as rows."""
    by_host, winners, _ = host_votes(pdf.to_dict("records"))
    mask = (1 << 64) - 1
    rows = []
    for leaf, v in leaf_sums(by_host, winners).items():
        longs = [(v[4] >> (64 * i)) & mask for i in range(N_LONGS)]
        rows.append([leaf, *v[:4], *(x - (1 << 64) if x >> 63 else x for x in longs)])
    return pd.DataFrame(rows, columns=["signature", "n", "links", "digits", "tail", *(f"b{i}" for i in range(N_LONGS))])


def _host_rules(pdf: pd.DataFrame) -> pd.DataFrame:
    """host, rules: make_rules of one host, whose rows also carry the sums of their leaf signature over all hosts."""
    whole = {}
    for r in pdf[pdf["signature"].notna() & pdf["all_n"].notna()].drop_duplicates("signature").to_dict("records"):
        bitmap = sum((int(r[f"all_b{i}"]) & ((1 << 64) - 1)) << (64 * i) for i in range(N_LONGS))
        whole[r["signature"]] = [*(int(r[f"all_{c}"]) for c in ("n", "links", "digits", "tail")), bitmap]
    rules = make_rules(pdf.to_dict("records"), whole)
    return pd.DataFrame({"host": [pdf["host"].iloc[0]], "rules": [pickle.dumps(rules)]})


def spark_rules(stats: DataFrame) -> DataFrame:
    """host, rules (make_rules of the host, pickled) for any number of hosts: a host's statistics are one group, its templates."""
    sums = stats.groupBy("host").applyInPandas(_host_leaves, LEAF_SUMS).groupBy("signature")
    columns = ["n", "links", "digits", "tail"]
    bits = [f"b{i}" for i in range(N_LONGS)]
    whole = sums.agg(*[F.sum(c).alias(f"all_{c}") for c in columns], *[F.expr(f"bit_or({b})").alias(f"all_{b}") for b in bits])
    signed = stats.withColumn("signature", F.when(F.col("leaf") != "", F.regexp_replace("leaf", r"\.[^/]*", ".*")))
    return signed.join(whole, "signature", "left").groupBy("host").applyInPandas(_host_rules, "host string, rules binary")


def apply_rules(pages: DataFrame, work, ddl: str, stats: DataFrame | None = None) -> DataFrame:
    """Run work(host, body, rules, index) over all pages (columns raw_path, host, body) with the rules of their hosts.

    work yields rows without raw_path. stats: the path_statistics to read pages by; without it, those of these pages."""
    sc = pages.sparkSession.sparkContext
    stats = materialize(path_statistics(pages), "host-paths") if stats is None else stats
    counts = {r["leaf"]: r["n"] for r in stats.where(F.col("container") == WORDS).collect()}  # the exemplars' words
    index = residue.Index(residue.EXEMPLARS, counts)
    stats = stats.where(F.col("container") != WORDS)
    names = [x.split()[0] for x in ddl.split(", ")]
    few = stats.count() <= MAX_RULES
    shared = sc.broadcast((make_rules(stats.collect()) if few else None, index))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rules, known = shared.value
        last: tuple[str | None, dict] = (None, {})
        for pdf in batches:
            rows = []
            for k, (raw_path, host, body) in enumerate(zip(pdf["raw_path"], pdf["host"], pdf["body"])):
                if not few and host != last[0]:
                    packed = pdf["rules"].iloc[k]
                    last = (host, pickle.loads(packed) if packed is not None else {})
                rows += [(raw_path, *row) for row in work(host, body, rules if few else last[1], known)]
            yield pd.DataFrame(rows, columns=names)

    return (pages if few else pages.join(spark_rules(stats), "host", "left")).mapInPandas(run, ddl)


def extract_stories(raw_pages: DataFrame) -> DataFrame:
    """raw_path, line_no, text of every story line of raw_pages (raw_path, vendor, body)."""
    def work(host, body, rules, known):
        return story_lines(host, body, rules, known)

    return apply_rules(host_pages(raw_pages), work, "raw_path string, line_no int, text string")


def story_line_numbers(raw_pages: DataFrame) -> DataFrame:
    """raw_path, line_no of every story line: the columns of p3_found. raw_path is the key of raw_pages; a row given twice comes out twice."""
    def work(host, body, rules, known):
        return [(no,) for no, _ in story_lines(host, body, rules, known)]

    return apply_rules(host_pages(raw_pages), work, "raw_path string, line_no int")
