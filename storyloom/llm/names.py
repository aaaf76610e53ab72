"""Spellings of one customer or product linked: MinHash banding, Monge-Elkan verification, star clustering.

A spelling is read as name words plus the kind (line of business, kind of product). Spellings that read the same fall together
at once. The rest meets in MinHash bands over padded 2-grams, whose number is taken from the collision curve for the wanted
recall; candidates are verified word by word (Monge-Elkan over edit distance with transpositions, initials, nicknames), and
linked readings are clustered into stars around the most frequent reading. Kinds must agree; a reading without a kind, or
with a name word missing, is linked only where a single centre fits.

Null and blank values are no names. Ties between centres of equal fit leave the reading alone.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .canonical import edit_distance, fold

#: Words without meaning for a name (fixed values): legal forms, articles, sales words.
LEGAL = frozenset("ltd limited inc incorporated llc llp plc corp corporation co company gmbh ag kg se sa sas sarl srl spa bv nv ab oy as aps pty pte kk holding holdings group".split())
DROPPED = frozenset("the of de du des la le der die das von and und et y by a an managed service services platform edition".split())
#: Words for the same kind (fixed values).
SAME_KIND = {
    "universitat": "university", "universite": "university", "universidad": "university", "uni": "university", "univ": "university", "hochschule": "university",
    "stadt": "city", "municipality": "city", "ville": "city", "ciudad": "city", "town": "city", "stadtverwaltung": "city", "cityof": "city", "universityof": "university",
}
KINDS = {
    "customer_name": "airways architects bank chemicals city clinics consulting dairy energy foods furniture hotels insurance logistics media mining motors office optics partners practice railways robotics software telecom textiles university".split(),
    "products_used": "cache catalog engine forge functions gateway graph hub insight lake mesh monitor notebook pipelines queue registry search store stream studio vault warehouse".split(),
}
SECOND = {"office": "law", "practice": "dental", "city": "council"}
#: Short and full forms of first names (fixed values).
NICKNAMES = (
    "alexander alex sandy alec; andrew andy drew; anthony tony; benjamin ben; catherine katharine katherine kate kathy katie cathy kat; charles charlie chuck; christopher chris; "
    "christine christina chris tina; daniel dan danny; david dave; deborah debbie deb; edward ed eddie ted ned; elisabeth elizabeth liz lisa beth betty lizzy eliza; frederick frederic fred freddy fritz; "
    "george georg; gregory greg; henry harry hank; james jim jimmy; jennifer jen jenny; johanna hanna hannah jo joan; john jack johnny; jonathan jon; joseph joe; joshua josh; kenneth ken; "
    "lawrence larry; margaret maggie meg peggy greta margo; matthew matt; michael mike mick; nicholas nick nico klaus nicolas; patricia pat patty trish; patrick pat; peter pete; philip phil; "
    "rebecca becky; richard rick dick rich; robert bob rob bobby bert robbie; ronald ron; samantha sam; samuel sam; stephen steve steven; susanne susan sue susi susie suzanne; theodore ted theo teddy; "
    "thomas tom tommy; timothy tim; victoria vicky tori; vincent vince; walter walt; william bill will billy liam willy"
)
NICK: dict[str, set[int]] = {}
for _i, _group in enumerate(NICKNAMES.split(";")):
    for _name in _group.split():
        NICK.setdefault(_name, set()).add(_i)

#: A last word of so many different names is a kind, at any number of spellings; so many of a field's are used at most.
KIND_LEAST, MOST_KINDS = 8, 2000
#: Readings of this similarity are to meet in a band with this probability; strangers of one kind are about so similar.
WANTED_SIMILARITY, WANTED_RECALL, STRANGERS = 0.35, 0.93, 0.12
#: Open links that one task finishes the clustering of; above, it goes on round by round with the same result.
FEW_LINKS = 200_000
#: Readings of a part of a kind: what one task compares are two of them at most. Pairs it holds at once, and tasks a core.
PART, PAIRS_AT_ONCE, GROUPS_A_CORE = 50_000, 2_000_000, 8
LINK, WORD_LINK = 0.8, 0.62
PAREN = re.compile(r"\([^)]*\)")
CAMEL = re.compile(r"(?<=[a-zà-ÿ])(?=[A-Z])")


def bands(rows: int, similarity: float = WANTED_SIMILARITY, recall: float = WANTED_RECALL) -> int:
    """Fewest bands with which a pair of this similarity meets with this probability: 1 - (1 - s^rows)^bands."""
    return int(np.ceil(np.log(1 - recall) / np.log(1 - similarity**rows)))


def band_shape(n: int) -> tuple[int, int]:
    """(rows, bands) for n readings of one kind: the recall is that of the collision curve whatever the rows; more rows keep
    strangers apart, at the price of more bands, so that pairs grow with about the root of n a reading and not with n."""
    rows = min(range(2, 8), key=lambda r: bands(r) * (1 + n * STRANGERS**r))
    return rows, bands(rows)


def raw_words(name: str) -> list[str]:
    """Words of a spelling; a full stop stays on abbreviations, legal forms are gone."""
    text = " ".join(w if fold(w).strip(".,") in LEGAL else CAMEL.sub(" ", w) for w in PAREN.sub(" ", name).split())
    text = fold(re.sub(r"\b([A-Z])\.\s?([A-Z])\.(\s?([A-Z])\.)?", lambda m: (m[1] + m[2] + (m[4] or "")), text) if re.search(r"\b[A-Z]\.\s?[A-Z]\.$", text.strip()) else text)
    words = re.findall(r"[^\W_]+\.?", text)
    kept = [w for w in words if w.rstrip(".") not in LEGAL and w not in DROPPED]
    return kept or words


def kind_of(word: str, kinds: dict[str, str]) -> str | None:
    """The kind that a word names: as it stands, abbreviated or misspelt."""
    w = word.rstrip(".")
    w = SAME_KIND.get(w, w)
    if w in kinds:
        return kinds[w]
    if word.endswith(".") and len(w) >= 2:
        full = [k for k in kinds if k.startswith(w)]
        if len(full) == 1:
            return full[0]
    if 2 <= len(w) <= 5 and not re.search("[aeiou]", w[1:]):
        full = [k for k in kinds if k[0] == w[0] and len(k) > len(w) and k[-1] == w[-1] and subsequence(w, k)]
        if not full and len(w) == 2:
            full = [k for k in kinds if k[0] == w[0] and subsequence(w, k) and halves(w, k)]
        if len(full) == 1:
            return full[0]
    if len(w) >= 4:
        near = [(edit_distance(w, k), k) for k in kinds if abs(len(k) - len(w)) <= 2 and len(set(k) & set(w)) >= len(k) // 2]
        near = sorted(x for x in near if x[0] <= (1 if len(x[1]) < 6 else 2))
        if near and (len(near) == 1 or near[0][0] < near[1][0]):
            return near[0][1]
    return None


def subsequence(short: str, word: str) -> bool:
    it = iter(word)
    return all(c in it for c in short)


def halves(short: str, word: str) -> bool:
    """soft-ware -> sw, gate-way -> gw, ware-house -> wh: the second letter opens the second half."""
    return short[1] in word[3:-2]


def read_name(name: str, kinds: dict[str, str], vendors: frozenset[str]) -> tuple[str, str]:
    """(kind or '', name words in order of the alphabet) of a spelling."""
    words = raw_words(name)
    if len(words) >= 3 and vendors:
        rest = [w for w in words if w.rstrip(".") not in vendors]
        words = rest if len(rest) >= 2 else words
    kind, at = "", None
    order = [len(words) - 1, 0, *range(len(words) - 2, 0, -1)] if len(words) > 1 else []
    for exact in (True, False):
        for i in order:
            w = words[i].rstrip(".")
            hit = kinds.get(SAME_KIND.get(w, w)) if exact else kind_of(words[i], kinds)
            if hit:
                kind, at = hit, i
                break
        if kind:
            break
    rest = [w.rstrip(".") for i, w in enumerate(words) if i != at]
    if not kind and len(words) > 2 and words[0] == "u." and "university" in kinds:  # U. Name Name
        kind, rest = "university", [w for w in rest if w != "u"]
    if not kind and len(words) == 2 and len(rest[-1]) == 1 and len(full := [k for k in kinds if k[0] == words[-1][0]]) == 1:  # Name Q
        kind, rest = full[0], rest[:-1]
    second = SECOND.get(kind)
    if second and len(rest) > 1:
        rest = [w for w in rest if not (w == second or (len(w) > 2 and edit_distance(w, second) <= 1))] or rest
    return kind, " ".join(sorted(rest))


def word_similarity(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if len(a) == 1 or len(b) == 1:
        return 0.9 if a[0] == b[0] else 0.0
    if NICK.get(a, set()) & NICK.get(b, set()):
        return 1.0
    return 1 - edit_distance(a, b) / max(len(a), len(b))


def similarity(a: str, b: str) -> float:
    """Monge-Elkan of two readings: mean over the shorter one's words of the best word of the other, each used once;
    0 where a word finds none, a little less for each word the other has beyond."""
    x, y = a.split(), b.split()
    if len(x) > len(y):
        x, y = y, x
    if not x or len(y) - len(x) > 1:
        return 0.0
    left = list(y)
    total = 0.0
    for w in sorted(x, key=lambda w: (-len(w), w)):
        s, best = max((word_similarity(w, v), v) for v in left)
        if s < WORD_LINK:
            joined = ("".join(x), "".join(y))
            return 1 - edit_distance(*joined) / max(map(len, joined)) if len(x) != len(y) and "".join(sorted(joined[0])) == "".join(sorted(joined[1])) else 0.0
        left.remove(best)
        total += s
    whole = total / len(x)
    if left and max(map(len, x)) < 4:
        return 0.0
    return whole * 0.9 if left else whole


def grams_of(readings: Iterable[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """CRC of each different padded 2-gram, the grams of all readings by number one after the other, and where each begins."""
    number: dict[str, int] = {}
    ids, starts = [], []
    for text in readings:
        starts.append(len(ids))
        ids += [number.setdefault(f"#{w}#"[k : k + 2], len(number)) for w in text.split() for k in range(len(w) + 1)] or [number.setdefault("", len(number))]
    return np.array([zlib.crc32(g.encode()) for g in number], dtype=np.uint64), np.array(ids, dtype=np.int64), np.array(starts, dtype=np.int64)


def minhash(grams: tuple[np.ndarray, np.ndarray, np.ndarray], n: int, columns: range) -> Iterator[np.ndarray]:
    """These columns of the n MinHash values of each reading, one after the other: each gram is hashed once, not once a reading."""
    rng = np.random.default_rng(20240501)
    a = rng.integers(1, 1 << 31, n, dtype=np.uint64) | np.uint64(1)
    b = rng.integers(0, 1 << 31, n, dtype=np.uint64)
    crc, ids, starts = grams
    for c in columns:
        yield np.minimum.reduceat((((crc * a[c] + b[c]) >> np.uint64(13)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)[ids], starts)


def signatures(readings: pd.Series, n: int) -> np.ndarray:
    """n MinHash values per reading over the padded 2-grams of its words."""
    return np.stack(list(minhash(grams_of(readings), n, range(n))), axis=1)


def kind_words(names: DataFrame) -> dict[str, dict[str, str]]:
    """field -> words for its kinds: last words of at least KIND_LEAST different names, with the fixed ones.

    Taken from the most frequent down; one that reads as a short or misspelt form of another is no kind of its own."""
    words = F.split(F.lower(F.trim("name")), r"\s+")
    rest = F.array_join(F.slice(words, 1, F.size(words) - 1), " ")
    ends = names.where(F.size(words) > 1).select("field", F.element_at(words, -1).alias("w"), rest.alias("rest")).where(F.col("w").rlike("^[a-z]{4,}$")).distinct()
    often = ends.groupBy("field", "w").agg(F.count("*").alias("n")).where(F.col("n") >= KIND_LEAST)
    first = F.row_number().over(Window.partitionBy("field").orderBy(F.desc("n"), "w"))
    rows = often.withColumn("i", first).where(F.col("i") <= MOST_KINDS).orderBy("field", "i").select("field", "w").collect()
    out = {field: {w: w for w in words} for field, words in KINDS.items()}
    for r in rows:
        kinds = out.setdefault(r["field"], {})
        if r["w"] not in LEGAL and r["w"] not in DROPPED and r["w"] not in SECOND.values() and kind_of(r["w"], kinds) is None:
            kinds[r["w"]] = r["w"]
    return out


def readings(names: DataFrame, vendors: list[str]) -> DataFrame:
    """field, name, n, kind, words of distinct names (field, name, n)."""
    kinds = kind_words(names)
    drop = frozenset(fold(w) for v in vendors for w in v.split())

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [read_name(name, kinds.get(field, {}), drop if field == "products_used" else frozenset()) for field, name in zip(pdf["field"], pdf["name"])]
            yield pdf.assign(kind=[k for k, _ in got], words=[w for _, w in got])

    return names.mapInPandas(read, "field string, name string, n bigint, kind string, words string")


def sharing(left: np.ndarray, right: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of equal hashes of left and right, or of left alone, some PAIRS_AT_ONCE pairs at a time."""
    order = np.argsort(left, kind="stable")
    if right is None:
        to, hashes = order, left[order]
        lo = np.arange(1, len(left) + 1)
    else:
        to = np.argsort(right, kind="stable")
        hashes = right[to]
        lo = np.searchsorted(hashes, left[order], "left")
    hi = np.searchsorted(hashes, left[order], "right")
    some = np.flatnonzero(hi > lo)
    order, lo, n = order[some], lo[some], (hi - lo)[some]
    ends = np.cumsum(n)
    i = 0
    while i < len(n):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + PAIRS_AT_ONCE, "right")))
        m = n[i:j]
        yield np.repeat(order[i:j], m), to[np.repeat(lo[i:j] - np.cumsum(m) + m, m) + np.arange(m.sum())]
        i = j


class Letters:
    """Counts of letters of the readings' words, for a bound on similarity that needs no edit distance."""

    MOST = 4  # words; readings of more are not bounded

    def __init__(self, readings: list[str]) -> None:
        number: dict[str, int] = {}
        self.words = np.full((len(readings), self.MOST), -1)
        self.size = np.zeros(len(readings), dtype=np.int64)
        for i, text in enumerate(readings):
            words = [number.setdefault(w, len(number)) for w in text.split()]
            self.size[i] = len(words)
            self.words[i, : min(len(words), self.MOST)] = words[: self.MOST]
        self.counts = np.zeros((len(number), 32), dtype=np.int8)
        for w, i in number.items():
            for c in w[:100]:
                self.counts[i, ord(c) % 32] += 1
        self.length = np.array([len(w) for w in number], dtype=np.int64)
        self.initial, self.nick = (np.array([f(w) for w in number], dtype=bool) for f in (lambda w: len(w) == 1, lambda w: w in NICK))

    def bound(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """At least word_similarity: each edit mends one letter too many and one too few at most."""
        over = self.counts[x] - self.counts[y]
        edits = (np.abs(over).sum(axis=1, dtype=np.int32) + np.abs(over.sum(axis=1, dtype=np.int32))) / 2
        free = self.initial[x] | self.initial[y] | (self.nick[x] & self.nick[y]) | (np.maximum(self.length[x], self.length[y]) > 100)
        return np.where(free, 1.0, 1 - edits / np.maximum(self.length[x], self.length[y]))

    def possible(self, a: np.ndarray, b: np.ndarray, factor: float) -> np.ndarray:
        """Whether similarity times factor may reach LINK: False only where it surely doesn't."""
        swap = self.size[a] > self.size[b]
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        out = (self.size[a] > 0) & (self.size[b] - self.size[a] <= 1)
        shape = np.where(out & (self.size[b] <= self.MOST), self.size[a] * (self.MOST + 1) + self.size[b], -1)
        for k in np.unique(shape[shape >= 0]):
            at = np.flatnonzero(shape == k)
            x, y = divmod(int(k), self.MOST + 1)
            best = np.stack([np.max([self.bound(self.words[a[at], i], self.words[b[at], j]) for j in range(y)], axis=0) for i in range(x)])
            whole = best.mean(axis=0) * factor * (1.0 if x == y else 0.9)
            # words of which none has a partner may still be the same letters cut at another place
            out[at] = ((best.min(axis=0) >= WORD_LINK) & (whole >= LINK - 1e-9)) | (x != y and self.cut_elsewhere(a[at], b[at], x, y))
        return out

    def cut_elsewhere(self, a: np.ndarray, b: np.ndarray, x: int, y: int) -> np.ndarray:
        (la, ca), (lb, cb) = ((sum(f[self.words[r, i]].astype(np.int32) for i in range(n)) for f in (self.length, self.counts)) for r, n in ((a, x), (b, y)))
        return (la == lb) & (ca == cb).all(axis=1)


def placed(keys: DataFrame, counts: dict[tuple[str, str], int]) -> tuple[DataFrame, int]:
    """keys once for every task that compares them (field, kind, key, words, task, side, free), and the number of tasks.

    Kinds are cut into parts of PART readings at most, small ones of a field share a part. A task holds one part, whose
    readings of one kind meet; or two parts of one kind, where side 0 meets side 1; or readings without a kind (free), which
    as side 0 meet a part of any kind. So what a task holds is bounded whatever the kinds are, and all pairs that may be
    linked meet in exactly one task."""
    parts: dict[tuple[str, str], list[int]] = {}
    room: dict[tuple[str, bool], list[int]] = {}  # the part being filled with small kinds, and its readings
    made = 0
    for (field, kind), n in sorted(counts.items()):
        if n > PART:
            parts[field, kind] = list(range(made, made + -(-n // PART)))
            made += -(-n // PART)
            continue
        part = room.get((field, kind == ""))
        if part is None or part[1] + n > PART:
            part = room[field, kind == ""] = [made, 0]
            made += 1
        part[1] += n
        parts[field, kind] = [part[0]]
    places: dict[int, list[tuple[int, int, bool]]] = {p: [(p, 0, False)] for p in range(made)}
    tasks = made

    def meet(p: int, q: int, free: bool) -> None:
        nonlocal tasks
        places[p].append((tasks, 0, free))
        places[q].append((tasks, 1, free))
        tasks += 1

    for own in parts.values():
        for i, p in enumerate(own):
            for q in own[i + 1 :]:
                meet(p, q, False)
    for field in {f for f, _ in parts}:
        for p in parts.get((field, ""), []):
            for q in sorted({q for (f, kind), own in parts.items() if f == field and kind for q in own}):
                meet(p, q, True)
    rows = [(f, k, len(own), i, places[p]) for (f, k), own in parts.items() for i, p in enumerate(own)]
    plan = keys.sparkSession.createDataFrame(rows, "field string, kind string, parts int, part int, places array<struct<task: int, side: int, free: boolean>>")
    at = keys.select("field", "kind", "key", "words").join(F.broadcast(plan), ["field", "kind"]).where(F.pmod("key", "parts") == F.col("part"))
    return at.select("field", "kind", "key", "words", F.inline("places")), tasks


def verified_links(keys: DataFrame) -> DataFrame:
    """key_a, key_b, score of the readings that share a band and whose similarity is at least LINK. Kinds agree or one is missing.

    Readings travel, not their bands: a task hashes the readings it holds band by band, and takes the words of those that meet
    from memory. Some hundred bands a reading are neither shuffled nor joined, so no plan can take them for a small table."""
    counts = {(r["field"], r["kind"]): r["count"] for r in keys.groupBy("field", "kind").count().collect()}  # kinds are bounded
    width, n = band_shape(max(counts.values(), default=0))
    at, tasks = placed(keys, counts)
    cores = keys.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, min(n, -(-GROUPS_A_CORE * cores // max(tasks, 1))))  # of bands, for enough tasks

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("side", ignore_index=True)
        block, free = int(pdf["block"].iloc[0]), bool(pdf["free"].iloc[0])
        key, words, kind = pdf["key"].to_numpy(), pdf["words"].to_list(), pd.factorize(pdf["kind"])[0].astype(np.uint64)
        sides = int((pdf["side"] == 0).sum())
        two = free or bool(pdf["side"].iloc[-1] == 1)
        factor = 0.95 if free else 1.0
        grams, letters = grams_of(words), Letters(words)
        found: list[pd.DataFrame] = []
        met: list[np.ndarray] = []

        def verify() -> None:
            codes = np.unique(np.concatenate(met))
            met.clear()
            for i in range(0, len(codes), PAIRS_AT_ONCE // 10):
                a, b = np.divmod(codes[i : i + PAIRS_AT_ONCE // 10], len(key))
                may = letters.possible(a, b, factor)
                a, b = a[may], b[may]
                swap = key[a] > key[b]
                a, b = np.where(swap, b, a), np.where(swap, a, b)
                score = np.array([similarity(words[x], words[y]) for x, y in zip(a, b)], dtype=float) * factor
                ok = score >= LINK
                found.append(pd.DataFrame({"key_a": key[a[ok]], "key_b": key[b[ok]], "score": score[ok]}))

        for band in range(block, n, blocks):
            h = np.zeros(len(key), dtype=np.uint64) if free else kind << np.uint64(40)
            for column in minhash(grams, n * width, range(band * width, (band + 1) * width)):
                h = (h ^ column) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(31)
            for a, b in sharing(h[:sides], h[sides:] if two else None):
                b = b + sides if two else b
                met.append(np.minimum(a, b) * len(key) + np.maximum(a, b))
                if sum(map(len, met)) > PAIRS_AT_ONCE:
                    verify()
        if met:
            verify()
        return pd.concat(found) if found else pd.DataFrame({"key_a": key[:0], "key_b": key[:0], "score": np.zeros(0)})

    spread = max(GROUPS_A_CORE * cores, int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")))  # few bytes, much work
    groups = at.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).repartition(spread, "task", "block")
    return groups.groupBy("task", "block").applyInPandas(link, "key_a bigint, key_b bigint, score double").distinct()


def finished(open_: DataFrame) -> DataFrame:
    """key_a of the centres among few open links (key_a, key_b, rank_a, rank_b), taken by rank in one task: as rounds would."""

    def greedy(pdf: pd.DataFrame) -> pd.DataFrame:
        near: dict[int, list[int]] = {}
        rank: dict[int, tuple] = {}
        for a, b, r in zip(pdf["key_a"], pdf["key_b"], zip(pdf["full"], pdf["n"], pdf["key_a"])):
            near.setdefault(a, []).append(b)
            rank[a] = r
        closed: set[int] = set()
        centres = []
        for k in sorted(rank, key=rank.__getitem__, reverse=True):
            if k not in closed:
                centres.append(k)
                closed.update(near[k])
        return pd.DataFrame({"key_a": np.array(centres, dtype=np.int64)})

    rows = open_.select("key_a", "key_b", F.col("rank_a.full").alias("full"), F.col("rank_a.n").alias("n"), F.lit(0).alias("all"))
    return rows.groupBy("all").applyInPandas(greedy, "key_a bigint")


def stars(keys: DataFrame, links: DataFrame) -> DataFrame:
    """key, centre: stars around the most frequent readings.

    In each round every open reading that outranks its open neighbours becomes a centre, and its open neighbours close. Ranks
    differ, so each round decides at least one reading of every open part; rounds go on until none is open, the last links,
    once they are few, in one task. A satellite joins its best-fitting centre; one that fits two centres equally well, with a
    word or the kind missing, stays alone."""
    rank = F.struct(F.col("full"), F.col("n"), F.col("key"))
    ranked = keys.select("key", rank.alias("rank"))
    both = links.unionByName(links.select(F.col("key_b").alias("key_a"), F.col("key_a").alias("key_b"), "score"))
    edges = materialize(both.join(ranked.toDF("key_a", "rank_a"), "key_a").join(ranked.toDF("key_b", "rank_b"), "key_b"), "name-links")
    open_ = edges
    centres = None
    while (n := open_.count()) > FEW_LINKS:
        top = open_.groupBy("key_a", "rank_a").agg(F.max("rank_b").alias("best")).where("rank_a > best").select("key_a")
        top = materialize(top, "name-centres")
        closed = materialize(open_.join(top, "key_a", "left_semi").select(F.col("key_b").alias("key_a")).unionByName(top).distinct(), "name-closed")
        left = open_.join(closed, "key_a", "left_anti").join(closed.withColumnRenamed("key_a", "key_b"), "key_b", "left_anti")
        # a reading whose neighbours are all closed is a centre of its own
        alone = open_.select("key_a").distinct().join(closed, "key_a", "left_anti").join(left.select("key_a").distinct(), "key_a", "left_anti")
        done = top.unionByName(alone)
        centres = done if centres is None else centres.unionByName(done)
        open_ = materialize(left.select(open_.columns), "name-open")
    if n or centres is None:
        centres = finished(open_) if centres is None else centres.unionByName(finished(open_))
    centres = materialize(centres.distinct(), "name-centres")
    w = Window.partitionBy("key_a").orderBy(F.desc("score"), F.desc("rank_b"))
    fits = edges.join(centres.withColumnRenamed("key_a", "key_b"), "key_b", "left_semi").join(centres, "key_a", "left_anti")
    best = fits.withColumn("next", F.lead("score").over(w)).withColumn("i", F.row_number().over(w)).where("i = 1")
    ambiguous = (F.col("next") >= F.col("score") - 0.01) & (F.col("score") < 0.93)
    satellites = best.where(~F.coalesce(ambiguous, F.lit(False))).select(F.col("key_a").alias("key"), F.col("key_b").alias("centre"))
    return keys.select("key").join(satellites, "key", "left").select("key", F.coalesce("centre", "key").alias("centre"))


def clustered_names(names: DataFrame, vendors: list[str]) -> DataFrame:
    """field, name, centre: every spelling with the star it belongs to; a spelling of its own has a centre of its own.

    names: field, name, n (records), each spelling once. One row per spelling, however large a star is."""
    read = materialize(readings(names, vendors).withColumn("key", F.xxhash64("field", "kind", "words")), "readings")
    keys = read.groupBy("key").agg(F.first("field").alias("field"), F.first("kind").alias("kind"), F.first("words").alias("words"), F.sum("n").alias("n"))
    full = (F.col("kind") != "").cast("int") + F.size(F.filter(F.split("words", " "), lambda w: F.length(w) > 1))
    keys = materialize(keys.withColumn("full", F.least(full, F.lit(3))), "reading-keys")
    links = materialize(verified_links(keys), "verified-names")
    return read.join(stars(keys, links), "key").select("field", "name", "centre")


def linked_names(names: DataFrame, vendors: list[str]) -> DataFrame:
    """field, name_a, name_b: pairs of different spellings of one entity, the smaller by code point first; see clustered_names.

    All pairs of a star come out, as they are asked for; where stars are large take their members instead."""
    clustered = clustered_names(names, vendors)
    a, b = (clustered.select("field", "centre", F.col("name").alias(f"name_{s}")) for s in "ab")
    return a.join(b, ["field", "centre"]).where("name_a < name_b").select("field", "name_a", "name_b")


def name_spellings(case_studies: DataFrame) -> DataFrame:
    """field, name, n over customer_name and products_used; null and blank values are left out."""
    wide = case_studies.select(
        F.concat(
            F.array(F.struct(F.lit("customer_name").alias("field"), F.col("customer_name").alias("name"))),
            F.coalesce(F.transform(F.array_distinct("products_used"), lambda p: F.struct(F.lit("products_used").alias("field"), p.alias("name"))), F.expr("cast(array() as array<struct<field:string,name:string>>)")),
        ).alias("v")
    )
    return wide.select(F.inline("v")).where(F.length(F.trim("name")) > 0).groupBy("field", "name").agg(F.count("*").alias("n"))
