"""New batches against all history by a segment index for edit distance over words.

A text is a string of symbols, one per word. Of each text in the history a fixed number of disjoint segments of equal length
is stored with position and text length; as many as the allowed edits plus one plus a reserve. Edits can destroy one segment
each, so a text within the bound shares at least reserve + 1 of them with the probe, at a position shifted by no more than the
edits. Which disjoint segments are stored is free: the rarest are, by the segments found frequent over all texts that are
stored, which keeps common phrases out of the index without losing a pair. Every pair that shares enough is verified by edit
distance within its bound (a band of the matrix). The index grows by appending the segments of newly accepted texts.

Equal texts are one entry. Texts with fewer than MIN_WORDS words are compared for equality only. Null and empty texts match nothing.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .residue import WORD

#: Share of the longer text's words that may differ.
RATIO = 0.12
SEGMENT_WORDS, RESERVE, MIN_WORDS = 5, 1, 8
#: A segment that so large a share of some CHUNK of texts holds is common; which are affects speed only, not the result.
COMMON, CHUNK = 0.0005, 5000
#: Symbols: 20,992 ideographs and 11,172 syllables, all in the basic plane.
N_SYMBOLS = 0x9FFF - 0x4E00 + 1 + 0xD7A3 - 0xAC00 + 1


def symbol(word: str) -> str:
    x = zlib.crc32(word.encode()) % N_SYMBOLS
    return chr(0x4E00 + x) if x < 0x5200 else chr(0xAC00 + x - 0x5200)


_SYMBOLS: dict[str, str] = {}


def symbols(text: str) -> str:
    """One symbol per word, without regard to case and punctuation."""
    if len(_SYMBOLS) > 500_000:
        _SYMBOLS.clear()
    out = []
    for w in WORD.findall(text.lower()):
        s = _SYMBOLS.get(w)
        if s is None:
            s = _SYMBOLS[w] = symbol(w)
        out.append(s)
    return "".join(out)


def edits(n: int) -> int:
    """Most edits to any text within the bound of one of n words."""
    return int(RATIO * n / (1 - RATIO) + 1e-9)


def segment_length(n: int) -> int:
    """Words per segment: SEGMENT_WORDS, less where so few words would not give enough disjoint segments."""
    return min(SEGMENT_WORDS, n // (edits(n) + 1))


def codes(s: str) -> np.ndarray:
    return np.frombuffer(s.encode("utf-16-le"), dtype=np.uint16)


def gram_hashes(c: np.ndarray, q: int) -> np.ndarray:
    """64-bit hash of every q consecutive symbols."""
    h = np.full(len(c) - q + 1, 1469598103934665603 + q, dtype=np.uint64)
    for i in range(q):
        h = (h ^ c[i : len(c) - q + 1 + i].astype(np.uint64)) * np.uint64(1099511628211)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def common_segments(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the common segments of all texts, and in how many texts they stand at least.

    Each CHUNK of texts hands on the segments that a share COMMON of it, and two texts at least, hold: what is that common
    overall is so in some chunk. Only what adds up to that share of all texts is brought here, so there are at most the
    segments per text over COMMON, whatever the number of texts."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []

        def common() -> pd.DataFrame:
            h, k = np.unique(np.concatenate(held), return_counts=True)
            often = k >= max(2, math.ceil(COMMON * len(held)))
            return pd.DataFrame({"h": np.append(h[often], 0), "n": np.append(k[often], 0), "texts": np.append(np.zeros(often.sum(), np.int64), len(held))})

        for pdf in batches:
            for s in pdf["s"]:
                if s and len(s) >= MIN_WORDS:
                    c = codes(s)
                    held.append(np.unique(gram_hashes(c, segment_length(len(c)))))
                    if len(held) == CHUNK:
                        yield common()
                        held.clear()
        if held:
            yield common()

    sums = texts.select("s").mapInPandas(count, "h bigint, n bigint, texts bigint").groupBy("h").agg(F.sum("n").alias("n"), F.sum("texts").alias("texts"))
    sums = materialize(sums, "common-segments")
    total = sums.where("texts > 0").agg(F.coalesce(F.sum("texts"), F.lit(0))).first()[0]
    rows = sums.where(F.col("n") >= max(2, math.ceil(COMMON * total))).orderBy("h").select("h", "n").collect()
    return np.array([r["h"] for r in rows], np.int64), np.array([r["n"] for r in rows], np.int64)


def chosen_segments(h: np.ndarray, n: int, q: int, common: tuple[np.ndarray, np.ndarray]) -> list[int]:
    """Positions of the rarest disjoint segments: as many as edits + 1 + RESERVE, or all that fit."""
    want = min(edits(n) + 1 + RESERVE, n // q)
    count = np.zeros(len(h), dtype=np.int64)
    if len(common[0]):
        at = np.minimum(np.searchsorted(common[0], h), len(common[0]) - 1)
        count = np.where(common[0][at] == h, common[1][at], 0)
    taken = bytearray(n + q)
    picked: list[int] = []
    for p in np.argsort(count, kind="stable").tolist():
        if not (taken[p] or taken[p + q - 1]):  # segments are of equal length: one that overlaps covers an end
            taken[p : p + q] = b"\1" * q
            picked.append(p)
            if len(picked) == want:
                return sorted(picked)
    return [i * n // want for i in range(want)]  # the gaps left are too small for enough segments: cut evenly instead


SEGMENTS_DDL = "h bigint, id bigint, pos int, n int"


def history_segments(texts: DataFrame, common: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """h, id, pos, n: the segments to be stored of each text (columns id, s)."""
    shared = texts.sparkSession.sparkContext.broadcast(common)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            h, ids, pos, ns = [], [], [], []
            for i, s in zip(pdf["id"], pdf["s"]):
                if not s or len(s) < MIN_WORDS:
                    continue
                c = codes(s)
                q = segment_length(len(c))
                every = gram_hashes(c, q)
                at = chosen_segments(every, len(c), q, shared.value)
                h.append(every[at])
                ids += [i] * len(at)
                pos += at
                ns += [len(c)] * len(at)
            yield pd.DataFrame({"h": np.concatenate(h) if h else np.zeros(0, np.int64), "id": np.array(ids, np.int64), "pos": np.array(pos, np.int32), "n": np.array(ns, np.int32)})

    return texts.select("id", "s").mapInPandas(cut, SEGMENTS_DDL)


def probe_segments(texts: DataFrame) -> DataFrame:
    """h, id, pos, n: every substring of a batch text that may equal a stored segment."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for i, s in zip(pdf["id"], pdf["s"]):
                if not s or len(s) < MIN_WORDS:
                    continue
                c = codes(s)
                m = len(c)
                low, high = math.ceil(m * (1 - RATIO)), int(m / (1 - RATIO))
                for q in {segment_length(n) for n in range(max(low, 1), high + 1)}:
                    if q <= m:
                        h = gram_hashes(c, q)
                        out.append(pd.DataFrame({"h": h, "id": i, "pos": np.arange(len(h), dtype=np.int32), "n": np.int32(m)}))
            yield pd.concat(out) if out else pd.DataFrame({"h": np.zeros(0, np.int64), "id": np.zeros(0, np.int64), "pos": np.zeros(0, np.int32), "n": np.zeros(0, np.int32)})

    return texts.select("id", "s").mapInPandas(cut, SEGMENTS_DDL)


def matches(history: DataFrame, batch: DataFrame, segments: DataFrame | None = None) -> DataFrame:
    """Distinct old, new: ids of batch texts and of history texts within their bound (both: id, s; id stands for one text).

    segments: the stored index of the history; without it, it is built here."""
    if segments is None:
        segments = history_segments(history, common_segments(history))
    left = segments.select("h", F.col("id").alias("old"), F.col("pos").alias("p"), F.col("n").alias("n"))
    right = probe_segments(batch).select("h", F.col("id").alias("new"), F.col("pos").alias("q"), F.col("n").alias("m"))
    bound = F.floor(F.greatest("n", "m") * RATIO + 1e-9)
    most = F.floor(F.col("n") * (RATIO / (1 - RATIO)) + 1e-9).cast("int")
    length = F.least(F.lit(SEGMENT_WORDS), F.floor(F.col("n") / (most + 1)))
    need = F.least(most + 1 + RESERVE, F.floor(F.col("n") / length)) - most
    pairs = (
        left.join(right, "h")
        .where((F.abs(F.col("n") - F.col("m")) <= bound) & (F.abs(F.col("p") - F.col("q")) <= bound))
        .where("old <> new")
        .groupBy("old", "new")
        .agg(F.count("*").alias("shared"), F.min(need).alias("need"))
        .where("shared >= need")
        .select("old", "new")
    )
    within = f"levenshtein(a, b, cast(floor(greatest(length(a), length(b)) * {RATIO}D + 1e-9D) as int)) >= 0"  # -1 beyond the bound
    return (
        materialize(pairs, "segment-pairs")
        .join(history.select(F.col("id").alias("old"), F.col("s").alias("a")), "old")
        .join(batch.select(F.col("id").alias("new"), F.col("s").alias("b")), "new")
        .where(F.expr(within))
        .select("old", "new")
    )
