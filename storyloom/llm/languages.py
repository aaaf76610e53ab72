"""Language of documents and of their passages by rank-order profiles of character n-grams.

A profile lists a language's most frequent n-grams by rank; a passage's n-grams are ranked the same way, equal frequencies
sharing their mean rank, and the language with the least out-of-place distance is the passage's. Profiles are learned from a
bounded sample of the rows that carry a readable label; wrong labels are outvoted, and a second round drops sample texts and
passages that the first round's profiles contradict. Every passage of every document is classified.

A passage of fewer than MIN_WORDS words, or without a clear winner, has no language of its own. In the languages of a document,
short sentences are judged together with neighbours that look alike, and what is still unclear as one text. Every document has
a main language, if need be the most likely one with its low confidence; it is null only for texts without a known n-gram.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Generator, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import hash_share, materialize, spread

LANGUAGES = ("de", "en", "es", "fr", "it", "nl", "pt")
#: Names under which labels mean a language (fixed values): codes of two and three letters and English names.
LABELS = {
    "de": "de deu ger german deutsch", "en": "en eng english", "es": "es spa spanish castilian español", "fr": "fr fra fre french français",
    "it": "it ita italian italiano", "nl": "nl nld dut dutch flemish nederlands", "pt": "pt por portuguese português",
}
#: Rows per language that profiles are learned from, n-grams per profile, longest n-gram.
SAMPLE, PROFILE, LONGEST = 1500, 3000, 5
MIN_WORDS = 4
#: Words ranked together and documents whose passages are ranked together, for speed; words whose n-grams are kept.
AT_ONCE, DOCS_AT_ONCE, MOST_WORDS = 40_000, 500, 300_000
#: Least relative distance between the best and the second language of a passage.
CLEAR = 0.08
#: The same where a sentence of fewer than MIN_WORDS words, but so many at least, has no like neighbour.
SHORT_CLEAR, SHORT_WORDS = 0.25, 2
WORD = re.compile(r"[^\W\d_]+")
#: A sentence: closed by punctuation.
SENTENCE = re.compile(r"[.!?…][\"”“»’)\]]*$")
#: A passage ends at a blank line or after closing punctuation followed by white space; single line breaks may be wraps.
BLANK_LINE = re.compile(r"\s*\n\s*\n\s*")
CLOSED = re.compile(r"[.!?…][\"”“»’)\]]*\s+")
HYPHEN = re.compile(r"-(?<=[^\W\d_]-)[ \t]*\r?\n[ \t]*(?=[^\W\d_])")
#: Two or more capitalised words in a row are a name, which says little of the language.
NAME = re.compile(r"[A-ZÀ-Þ](?<!\w.)[a-zß-ÿ]+(?:\s+(?:of\s+)?[A-ZÀ-Þ][a-zß-ÿ]+)+\b")


def label_language(label: Column) -> Column:
    """The code that a label means, in any notation; null where it means none of the known languages."""
    base = F.element_at(F.split(F.lower(F.trim(label)), r"[-_\s]"), 1)
    out = F.lit(None).cast("string")
    for code, names in LABELS.items():
        out = F.when(base.isin(names.split()), F.lit(code)).otherwise(out)
    return out


def passages(text: str | None) -> list[str]:
    text = HYPHEN.sub("", text or "")
    out = []
    for part in BLANK_LINE.split(text) if "\n" in text else [text]:
        start = 0
        for m in CLOSED.finditer(part):
            out.append(part[start : m.start() + 1].strip())
            start = m.end()
        out.append(part[start:].strip())
    return [p for p in out if p]


def letters(text: str) -> list[str]:
    """The runs of letters in a text: WORD, with a short way for words that are nothing else."""
    out: list[str] = []
    for w in text.split():
        if w.isalpha():
            out.append(w)
        else:
            out += WORD.findall(w)
    return out


def telling_words(passage: str) -> list[str]:
    """Words of a passage without names, in lower case; all words where little else is left."""
    words = letters(NAME.sub(" ", passage).lower())
    return words if len(words) >= MIN_WORDS else letters(passage.lower())


def word_grams(word: str) -> list[str]:
    padded = f"_{word}_"
    return [padded[i : i + n] for n in range(1, LONGEST + 1) for i in range(len(padded) - n + 1) if padded[i : i + n] != "_"]


class Profiles:
    """Ranks of n-grams per language; missing n-grams have the rank PROFILE."""

    def __init__(self, counts: dict[str, Counter]):
        self.languages = [lang for lang in LANGUAGES if counts.get(lang)]
        tops = [[g for g, _ in sorted(counts[lang].items(), key=lambda x: (-x[1], x[0]))[:PROFILE]] for lang in self.languages]
        self.ids = {g: i for i, g in enumerate(sorted({g for top in tops for g in top}))}
        self.ranks2 = np.full((len(self.languages), len(self.ids)), 2 * PROFILE, dtype=np.int32)  # twice the ranks: means of ranks are halves
        for column, top in zip(self.ranks2, tops):
            column[[self.ids[g] for g in top]] = 2 * np.arange(len(top))
        self.forget()

    def rows_of(self, words: list[str]) -> list[int]:
        """Rows of the table of words; words seen for the first time are added with the ids of their known n-grams."""
        rows = self.rows
        try:
            return [rows[w] for w in words]
        except KeyError:
            for w in words:
                if w not in rows:
                    rows[w] = len(rows)
                    self.word_grams.append(np.array([self.ids[g] for g in word_grams(w) if g in self.ids], dtype=np.int32))
            return [rows[w] for w in words]

    def forget(self) -> None:
        self.rows: dict[str, int] = {}
        self.word_grams: list[np.ndarray] = []
        self.flat, self.offsets = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def grams_of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(n-gram ids of these words one after the other, how many of each)."""
        if len(self.offsets) <= len(self.word_grams):
            fresh = self.word_grams[len(self.offsets) - 1 :]
            self.flat = np.concatenate([self.flat, *fresh])
            self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum([len(x) for x in fresh])])
        sizes = self.offsets[rows + 1] - self.offsets[rows]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.offsets[rows] - ends + sizes, sizes)
        return self.flat[at], sizes

    def many_distances(self, texts: list[list[str]]) -> list[np.ndarray | None]:
        """Out-of-place distances of each list of words to every language; None where no n-gram is known."""
        out: list[np.ndarray | None] = [None] * len(texts)
        if len(self.languages) < 2:
            return out
        if len(self.rows) > MOST_WORDS:
            self.forget()
        start = 0
        while start < len(texts):  # as many lists at a time as their words stay within AT_ONCE
            rows: list[int] = []
            lengths: list[int] = []
            while start + len(lengths) < len(texts) and (len(rows) < AT_ONCE or not lengths):
                words = texts[start + len(lengths)]
                rows += self.rows_of(words)
                lengths.append(len(words))
            ids, sizes = self.grams_of(np.array(rows, dtype=np.int64))
            if len(ids):
                small = len(lengths) * len(self.ids) < 2**31  # keys that fit are sorted faster
                base = np.arange(len(lengths), dtype=np.int32 if small else np.int64) * len(self.ids)
                for i, d in self._distances(np.repeat(np.repeat(base, lengths), sizes) + ids):
                    out[start + i] = d
            start += len(lengths)
        return out

    def _distances(self, keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(list, distances) for n-grams in lists, each given as list times the number of n-grams plus its id."""
        n_ids = len(self.ids)
        keys.sort()
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        freq = np.diff(np.append(first, len(keys)))
        owner = keys[first] // n_ids
        gram = (keys[first] - owner * n_ids).astype(np.intp)
        lists = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        sizes = np.diff(np.append(lists, len(owner)))
        # per list and frequency: twice the mean rank, which is that of all n-grams more frequent and half of the equal ones
        number = np.cumsum(np.bincount(freq) > 0)  # the frequencies that occur, numbered from 1
        cell = np.repeat(np.arange(len(lists)) * number[-1] - 1, sizes) + number[freq]
        equal = np.bincount(cell, minlength=len(lists) * number[-1]).reshape(len(lists), number[-1])
        rank2 = (2 * (sizes[:, None] - np.cumsum(equal, axis=1)) + equal - 1).astype(np.int32).ravel()[cell]
        longest = int(sizes.max())
        kind = np.int32 if 2 * longest * max(PROFILE, longest) < 2**31 else np.int64  # sums that fit are added faster
        sums = [np.add.reduceat(np.abs(rank2 - column[gram]), lists, dtype=kind) for column in self.ranks2]
        yield from zip(owner[lists].tolist(), np.stack(sums, axis=1) / 2)

    def distances(self, words: list[str]) -> np.ndarray | None:
        return self.many_distances([words])[0]

    def verdict(self, distance: np.ndarray | None) -> tuple[str | None, float]:
        """(language, confidence): how far the best language's distance lies below the second's, relative to it."""
        if distance is None:
            return None, 0.0
        first, second = sorted(distance.tolist())[:2]
        return self.languages[int(distance.argmin())], (second - first) / second if second else 0.0

    def classify(self, passage: str) -> tuple[str | None, float]:
        return self.classified([passage])[0]

    def classified(self, parts: list[str]) -> list[tuple[str | None, float]]:
        """(language, confidence) of passages; none for those of fewer than MIN_WORDS words."""
        words = [telling_words(p) for p in parts]
        return [self.verdict(d) for d in self.many_distances([w if len(w) >= MIN_WORDS else [] for w in words])]


def languages_asked(known: Profiles, text: str | None, label: str | None) -> Generator[list[list[str]], list, list]:
    """text_languages as a coroutine: it yields lists of words and is sent their distances, so that many texts share one ranking."""
    words: dict[str, int] = defaultdict(int)
    trust: dict[str, float] = defaultdict(float)

    def add(lang: str, confidence: float, n: int) -> None:
        words[lang] += n
        trust[lang] += confidence * n

    parts = passages(text)
    telling = [telling_words(p) for p in parts]
    long = [i for i, w in enumerate(telling) if len(w) >= MIN_WORDS]
    got = yield [telling[i] for i in long]
    own = {i: known.verdict(d) for i, d in zip(long, got)}
    bare = {i: letters(NAME.sub(" ", parts[i]).lower()) for i in range(len(parts)) if i not in own and SENTENCE.search(parts[i])}
    named = [i for i, w in bare.items() if w]  # others are names, which say nothing
    likes = dict(zip(named, (yield [bare[i] for i in named]))) if named else {}
    unclear: list[int] = []
    runs: list[tuple[str, list[int]]] = []  # short sentences in a row that look alike
    open_ = False
    for i, p in enumerate(parts):
        lang, confidence = own.get(i, (None, 0.0))
        if lang and confidence >= CLEAR:
            add(lang, confidence, len(p.split()))
            open_ = False
        elif lang or i not in bare:
            unclear.append(i)
            open_ = False
        elif (like := known.verdict(likes.get(i))[0]) is not None:
            if open_ and runs[-1][0] == like:
                runs[-1][1].append(i)
            else:
                runs.append((like, [i]))
            open_ = True
    pools = [[w for i in run for w in bare[i]] for _, run in runs]
    for (_, run), pool, distance in zip(runs, pools, (yield pools) if pools else ()):
        lang, confidence = known.verdict(distance)
        if len(pool) >= SHORT_WORDS and confidence >= (CLEAR if len(pool) >= MIN_WORDS else SHORT_CLEAR):
            add(lang, confidence, sum(len(parts[i].split()) for i in run))
        else:
            unclear += run
    pooled = [w for i in unclear for w in telling[i]]
    distance = (yield [pooled])[0] if pooled else None
    lang, confidence = known.verdict(distance)
    sentence = any(SENTENCE.search(parts[i]) or len(telling[i]) >= MIN_WORDS for i in unclear)
    if lang and confidence >= CLEAR and sentence and len(pooled) >= MIN_WORDS:
        add(lang, confidence, sum(len(parts[i].split()) for i in unclear))
    if words:
        total, main = sum(words.values()), max(words, key=lambda x: (words[x], x))
        return [(x, n / total, trust[x] / n, x == main, x != label) for x, n in words.items()]
    if distance is None:
        distance = (yield [[w for p in parts for w in letters(p.lower())]])[0]
        lang, confidence = known.verdict(distance)
    if lang is None:
        return [(None, 1.0, 0.0, True, False)]
    off = 1.0 if label not in known.languages else 1 - float(distance.min() / max(distance[known.languages.index(label)], 1e-9))
    return [(lang, 1.0, confidence, True, sentence and lang != label and off >= CLEAR)]


def texts_languages(known: Profiles, texts: list[tuple[str | None, str | None]]) -> list[list[tuple[str | None, float, float, bool, bool]]]:
    """text_languages of many (text, label), their passages ranked together."""
    out: list = [None] * len(texts)
    asking = []
    for i, (text, label) in enumerate(texts):
        judge = languages_asked(known, text, label)
        asking.append((i, judge, next(judge)))
    while asking:
        answers = iter(known.many_distances([w for _, _, lists in asking for w in lists]))
        still = []
        for i, judge, lists in asking:
            try:
                still.append((i, judge, judge.send([next(answers) for _ in lists])))
            except StopIteration as done:
                out[i] = done.value
        asking = still
    return out


def text_languages(known: Profiles, text: str | None, label: str | None) -> list[tuple[str | None, float, float, bool, bool]]:
    """(language, share of words, confidence, main, not what the label means) of a text, at least one of them.

    Where nothing in the text is clear, its most likely language stands against a label that lies clearly further off."""
    return texts_languages(known, [(text, label)])[0]


def confirmed(texts: list[str], codes: list[str], judge: Profiles | None) -> list[list[str]]:
    """Of each text the passages that the judge gives to its labelled language, if that is most of them; without a judge all."""
    parts = [passages(text) for text in texts]
    if judge is None:
        return parts
    judged = iter(judge.classified([p for ps in parts for p in ps]))
    agree = [[p for p in ps if next(judged)[0] == code] for ps, code in zip(parts, codes)]
    return [kept if 2 * len(kept) > len(ps) else [] for ps, kept in zip(parts, agree)]


def sample_grams(sample: DataFrame, judge: Profiles | None = None) -> dict[str, Counter]:
    """n-gram counts per language over a bounded sample (text, code); with a judge only over passages that it confirms."""
    shared = sample.sparkSession.sparkContext.broadcast(judge)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: dict[str, Counter] = defaultdict(Counter)
        for pdf in batches:
            for k in range(0, len(pdf), DOCS_AT_ONCE):
                part = pdf.iloc[k : k + DOCS_AT_ONCE]
                for code, kept in zip(part["code"], confirmed(list(part["text"]), list(part["code"]), shared.value)):
                    words[code].update(w for p in kept for w in telling_words(p))
        rows = []
        for code, counter in words.items():
            grams: Counter = Counter()
            for w, n in counter.items():
                for g in word_grams(w):
                    grams[g] += n
            rows += [(code, g, n) for g, n in grams.items()]
        yield pd.DataFrame(rows, columns=["code", "gram", "n"])

    total = sample.mapInPandas(count, "code string, gram string, n bigint").groupBy("code", "gram").agg(F.sum("n").alias("n"))
    total = materialize(total, "language-grams")
    out: dict[str, Counter] = defaultdict(Counter)
    for code in LANGUAGES:
        for r in total.where(F.col("code") == code).orderBy(F.desc("n"), "gram").limit(PROFILE).collect():
            out[code][r["gram"]] = r["n"]
    return out


def learn(documents: DataFrame, sample: int = SAMPLE) -> Profiles:
    """Profiles from about `sample` labelled rows per language, chosen by hash of the document: copies of a text are chosen one
    by one, so the bound holds (up to the spread of such a draw) at any size and for any repetition."""
    labelled = documents.select("doc_id", "text", label_language(F.col("lang")).alias("code")).where("code is not null and text is not null")
    sizes = {r["code"]: r["n"] for r in labelled.groupBy("code").agg(F.count("*").alias("n")).collect()}  # seven rows
    share = F.lit(0.0)
    for code, n in sizes.items():
        share = F.when(F.col("code") == code, F.lit(min(1.0, sample / n))).otherwise(share)
    picked = labelled.where(hash_share("doc_id") < share).select("text", "code")
    picked = materialize(picked.repartition(8), "language-sample")
    first = Profiles(sample_grams(picked))
    return Profiles(sample_grams(picked, first))


SPANS_DDL = "doc_id bigint, passage int, language string, confidence double, words int"


def document_passages(documents: DataFrame, profiles: Profiles | None = None) -> DataFrame:
    """doc_id, passage (from 1), language, confidence, words of every passage of every document (doc_id, text)."""
    profiles = profiles or learn(documents)
    shared = documents.sparkSession.sparkContext.broadcast(profiles)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for pdf in batches:
            parts = [(doc, i, p) for doc, text in zip(pdf["doc_id"], pdf["text"]) for i, p in enumerate(passages(text), 1)]
            judged = known.classified([p for _, _, p in parts])
            rows = [(doc, i, *found, len(p.split())) for (doc, i, p), found in zip(parts, judged)]
            yield pd.DataFrame(rows, columns=["doc_id", "passage", "language", "confidence", "words"])

    return spread(documents.select("doc_id", "text")).mapInPandas(run, SPANS_DDL)


def foreign_passages(documents: DataFrame, profiles: Profiles | None = None) -> DataFrame:
    """doc_id, passage, language, confidence of the passages clearly in another language than most words of their document."""
    rows = document_passages(documents, profiles).where(F.col("confidence") >= CLEAR)
    sums = Window.partitionBy("doc_id", "language")
    main = F.max_by("language", F.struct("in_language", "language")).over(Window.partitionBy("doc_id"))  # a document's passages
    return rows.withColumn("in_language", F.sum("words").over(sums)).withColumn("main", main).where("language <> main").select("doc_id", "passage", "language", "confidence")


def document_languages(documents: DataFrame, profiles: Profiles | None = None) -> DataFrame:
    """doc_id, labelled (code or null), lang, share of words, confidence (mean), is_main: the languages of each document."""
    return judged_documents(documents, profiles).drop("against")


def judged_documents(documents: DataFrame, profiles: Profiles | None = None) -> DataFrame:
    """The columns of document_languages and against: whether the label doesn't mean the language.

    Passages of one document are judged together, so nothing is shuffled."""
    profiles = profiles or learn(documents)
    shared = documents.sparkSession.sparkContext.broadcast(profiles)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for pdf in batches:
            rows = []
            for k in range(0, len(pdf), DOCS_AT_ONCE):
                part = pdf.iloc[k : k + DOCS_AT_ONCE]
                judged = texts_languages(known, list(zip(part["text"], part["code"])))
                rows += [(doc, code, *x) for doc, code, found in zip(part["doc_id"], part["code"], judged) for x in found]
            yield pd.DataFrame(rows, columns=["doc_id", "labelled", "lang", "share", "confidence", "is_main", "against"])

    rows = spread(documents.select("doc_id", label_language(F.col("lang")).alias("code"), "text"))
    return rows.mapInPandas(run, "doc_id bigint, labelled string, lang string, share double, confidence double, is_main boolean, against boolean")


def wrong_labels(documents: DataFrame) -> DataFrame:
    """The columns of p10_found: doc_id, lang of languages in a document that its label does not mean."""
    return judged_documents(documents).where("against").select("doc_id", "lang")
