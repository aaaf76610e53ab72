"""Freely typed values mapped to the closest entry of a reference list.

Distinct values only: normalise, retrieve candidates that share character n-grams through an inverted index over the list's
spellings, score by cosine of TF-IDF weighted n-grams, accept the best entry above a threshold and a margin over the second.
All spellings that may come close enough are checked by edit distance with transpositions, which swapped letters disturb less
than n-grams; a count of letters in common leaves out only those that can't.
Abbreviations written with a full stop are completed from the words of each candidate before it is scored.

Null and blank values are no values. Ties go to no entry. A list longer than BLOCK spellings is worked off in blocks with
the n-gram counts of the whole list, whose best candidates are then compared.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .aliases import FIELDS, NONE, rows

THRESHOLD, MARGIN = 0.58, 0.03
#: An edit distance scores EDITED at most; scores below THRESHOLD - MARGIN decide nothing.
EDITED = 0.98
BLOCK = 50_000
#: Words that join or frame a value without naming it (fixed values).
JOINING = frozenset("and und et y e of de des du la le les der die das für for the in & + a".split())
FRAMING = frozenset("industry sector sektor branche industries region regions area layer tier mostly mainly only business domain field market markets".split())


def fold(text: str) -> str:
    text = text.replace("ß", "ss").lower()
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def tokens(text: str) -> list[str]:
    """Folded words of a value, abbreviations with their full stop; frames are dropped if anything else is left."""
    folded = fold(text).strip()
    folded = re.sub(r"\b((?:[a-z]\.){2,}|(?:[a-z]\.)+[a-z]\b)", lambda m: m[0].replace(".", ""), folded)  # u.s. -> us
    words = re.findall(r"[^\W_]+\.?", folded)
    rest = [w for w in words if w.rstrip(".") not in JOINING]
    bare = [w for w in rest if w.rstrip(".") not in FRAMING]
    return bare or rest or words


def grams(word: str) -> list[str]:
    padded = f"#{word}#"
    return [padded[i : i + n] for n in (2, 3) for i in range(len(padded) - n + 1)]


def edit_distance(a: str, b: str) -> int:
    """Insertions, deletions, changes and swaps of neighbouring letters."""
    before: list[int] = []
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, last, row = row, before, [i]
        for j, y in enumerate(b, 1):
            d = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, last[j - 2] + 1)
            row.append(d)
    return row[-1]


def gram_bag(words: list[str]) -> dict[str, int]:
    return Counter(g for w in words for g in grams(w))


class SpellingIndex:
    """Inverted index n-gram -> spellings of one field's reference list."""

    def __init__(self, spellings: list[tuple[str, str]], counts: tuple[int, dict[str, int]] | None = None):
        """counts: spellings in all and per n-gram where these are a part of a longer list."""
        self.spellings = [(entry, [w.rstrip(".") for w in tokens(text)]) for entry, text in spellings]
        bags = [gram_bag(words) for _, words in self.spellings]
        n, df = counts or (len(bags), Counter(g for bag in bags for g in bag))
        forms = sorted({(" ".join(ws), i) for i, (_, words) in enumerate(self.spellings) for ws in (words, words[::-1])})
        self.forms = [f for f, _ in forms]
        self.form_of = [i for _, i in forms]
        self.letters = {c: k for k, c in enumerate(sorted({c for f in self.forms for c in f}))}
        self.sizes = np.array([len(f) for f in self.forms], dtype=np.int32)
        self.bags = np.array([self.letter_bag(f) for f in self.forms], dtype=np.int16).reshape(len(forms), len(self.letters))
        self.idf = {g: math.log((1 + n) / (1 + k)) + 1 for g, k in df.items()}  # of the whole list
        self.unseen = math.log(1 + n) + 1
        self.postings: dict[str, list[tuple[int, float]]] = defaultdict(list)
        for i, bag in enumerate(bags):
            norm = math.sqrt(sum((k * self.idf[g]) ** 2 for g, k in bag.items())) or 1.0
            for g, k in bag.items():
                self.postings[g].append((i, k * self.idf[g] / norm))
        self.postings = dict(self.postings)
        self.exact: dict[tuple, set[str]] = defaultdict(set)
        for entry, words in self.spellings:
            self.exact[tuple(sorted(words))].add(entry)
        self.exact = dict(self.exact)

    def letter_bag(self, text: str) -> np.ndarray:
        bag = np.zeros(len(self.letters), dtype=np.int16)
        for c in text:
            if c in self.letters:
                bag[self.letters[c]] += 1
        return bag

    def close_forms(self, joined: str) -> list[int]:
        """Written forms whose edit score may reach THRESHOLD - MARGIN: letters that only one side has need an edit each."""
        n = len(joined)
        size = np.maximum(self.sizes, n)
        both = np.minimum(self.bags, self.letter_bag(joined)).sum(axis=1) if n <= 2 * self.sizes.max(initial=0) else 0
        allowed = (size > 3) & (np.abs(self.sizes - n) <= 0.4 * size)
        return np.flatnonzero(allowed & (EDITED * (1 - (size - both) / size) >= THRESHOLD - MARGIN - 1e-9)).tolist()

    def vector(self, words: list[str]) -> dict[str, float]:
        bag: dict[str, float] = defaultdict(float)
        for w in words:
            for g in grams(w):
                bag[g] += self.idf.get(g, self.unseen)
        norm = math.sqrt(sum(x * x for x in bag.values())) or 1.0
        return {g: x / norm for g, x in bag.items()}

    def cosines(self, words: list[str]) -> dict[int, float]:
        out: dict[int, float] = defaultdict(float)
        for g, x in self.vector(words).items():
            for i, y in self.postings.get(g, ()):
                out[i] += x * y
        return out

    def is_exact(self, value: str) -> bool:
        return tuple(sorted(w.rstrip(".") for w in tokens(value))) in self.exact

    def best(self, value: str) -> list[tuple[str, float]]:
        """The two best entries of a value with their scores."""
        words = tokens(value)
        plain = [w.rstrip(".") for w in words]
        entries: dict[str, float] = defaultdict(float)
        for entry in self.exact.get(tuple(sorted(plain)), ()):
            entries[entry] = 1.0
        if not entries:
            found = self.cosines(plain)
            for i, score in found.items():
                entry, target = self.spellings[i]
                if score > entries[entry]:
                    entries[entry] = score
            joined = " ".join(plain)
            for k in self.close_forms(joined):
                entry, other = self.spellings[self.form_of[k]][0], self.forms[k]
                entries[entry] = max(entries[entry], EDITED * (1 - edit_distance(joined, other) / max(len(joined), len(other))))
            short = [w for w in words if w.endswith(".")]
            if short:
                for i in found:
                    entry, target = self.spellings[i]
                    full, left, grown = [], list(target), 0
                    for w in words:
                        p = w.rstrip(".")
                        hit = next((t for t in left if t.startswith(p) and t != p), None) if w.endswith(".") else None
                        if hit:
                            left.remove(hit)
                            grown += 1
                            full.append(hit)
                        else:
                            full.append(p)
                            if p in left:
                                left.remove(p)
                    if grown:
                        shared = self.vector(full)
                        score = sum(x * dict(self.postings[g]).get(i, 0.0) for g, x in shared.items() if g in self.postings)
                        entries[entry] = max(entries[entry], 0.99 * score)
        return sorted(entries.items(), key=lambda x: (-x[1], x[0]))[:2]


def match_values(values: DataFrame, spellings: DataFrame) -> DataFrame:
    """field, typed, entry of distinct values (field, typed); spellings: field, entry, spelling. No entry: (none)."""
    spark = values.sparkSession
    per_field = spellings.groupBy("field").count().collect()  # one row per field
    blocks = max(1, math.ceil(max((r["count"] for r in per_field), default=0) / BLOCK))

    def block(k: int) -> dict[str, list[tuple[str, str]]]:
        mine = spellings if blocks == 1 else spellings.where(F.pmod(F.xxhash64("spelling"), F.lit(blocks)) == k)
        lists: dict[str, list[tuple[str, str]]] = defaultdict(list)
        for r in mine.collect():  # at most about BLOCK rows a field
            lists[r["field"]].append((r["entry"], r["spelling"]))
        return {f: sorted(x) for f, x in lists.items()}

    counts: dict[str, tuple[int, Counter]] = {}
    for k in range(blocks if blocks > 1 else 0):
        for field, rows_ in block(k).items():
            n, df = counts.get(field, (0, Counter()))
            for _, text in rows_:
                df.update(gram_bag([w.rstrip(".") for w in tokens(text)]).keys())
            counts[field] = (n + len(rows_), df)
    parts = []
    for k in range(blocks):
        shared = spark.sparkContext.broadcast((block(k), counts))

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            lists, whole = shared.value
            indexes: dict[str, SpellingIndex] = {}
            for pdf in batches:
                out = []
                for field, typed in zip(pdf["field"], pdf["typed"]):
                    if field not in indexes:
                        indexes[field] = SpellingIndex(lists.get(field, []), whole.get(field))
                    exact = indexes[field].is_exact(typed)  # above all others, of other blocks too
                    out += [(field, typed, entry, score + exact) for entry, score in indexes[field].best(typed)] or [(field, typed, NONE, 0.0)]
                yield pd.DataFrame(out, columns=["field", "typed", "entry", "score"])

        parts.append(values.mapInPandas(run, "field string, typed string, entry string, score double"))
    scored = parts[0]
    for p in parts[1:]:
        scored = scored.unionByName(p)
    if blocks > 1:
        scored = scored.groupBy("field", "typed", "entry").agg(F.max("score").alias("score"))
    w = Window.partitionBy("field", "typed").orderBy(F.desc("score"), "entry")  # at most two rows a block
    ranked = scored.withColumn("next", F.coalesce(F.lead("score").over(w), F.lit(0.0))).withColumn("rank", F.row_number().over(w)).where("rank = 1")
    accepted = (F.col("score") >= THRESHOLD) & (F.col("score") - F.col("next") >= MARGIN)
    return ranked.select("field", "typed", F.when(accepted, F.col("entry")).otherwise(NONE).alias("entry"))


def typed_values(case_studies: DataFrame) -> DataFrame:
    """Distinct non-blank field, typed over industry, region and the layers of solution_components."""
    wide = case_studies.select(
        F.array_union(
            F.array(F.struct(F.lit("industry").alias("field"), F.col("industry").alias("typed")), F.struct(F.lit("region").alias("field"), F.col("region").alias("typed"))),
            F.coalesce(F.transform("solution_components", lambda c: F.struct(F.lit("layer").alias("field"), c["layer"].alias("typed"))), F.expr("cast(array() as array<struct<field:string,typed:string>>)")),
        ).alias("v")
    )
    return wide.select(F.inline("v")).where(F.length(F.trim(F.regexp_replace("typed", r"\s+", " "))) > 0).distinct()


def mapped_values(case_studies: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """The columns of p1_found: values that equal an entry character for character are left out."""
    spark = case_studies.sparkSession
    kinds = spark.createDataFrame([(kind, field) for field, (kind, _) in FIELDS.items()], "kind string, field string")
    entries = taxonomy.select("kind", "value").join(F.broadcast(kinds), "kind").select("field", F.col("value").alias("entry"))  # three rows
    labelled = spark.createDataFrame(rows(), "field string, entry string, spelling string")
    known = labelled.join(entries, ["field", "entry"], "left_semi").unionByName(labelled.where(F.col("entry") == NONE))
    spellings = known.unionByName(entries.select("field", "entry", F.col("entry").alias("spelling"))).distinct()
    values = typed_values(case_studies)
    spread = 2 * spark.sparkContext.defaultParallelism  # few bytes, much work: more tasks than their size would give
    asked = values.join(entries.select("field", F.col("entry").alias("typed")), ["field", "typed"], "left_anti").repartition(spread)
    return match_values(asked, spellings)
