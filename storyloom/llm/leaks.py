"""Passages of evaluation texts inside a corpus: latent semantic retrieval, then word-sequence and answer checks.

Texts are cut into overlapping windows and weighted by TF-IDF over hashed words, with document counts of the whole corpus.
A distributed randomised SVD, fitted on a bounded sample of corpus windows and on all windows of the evaluation items, gives
the latent space; every corpus window is projected and compared by cosine with the windows of the items, a block of at most
ITEMS_AT_ONCE items at a time. What this leaves is retrieved exactly: an index of the items' word pairs tells for every document
which items it shares enough of them with for a chain to be possible. Candidates are then checked word by word: a chain of
common words that follows the item with few edits, cut at most once by other text, and long enough; the same chain tells which
items differ only in their answers (numbers, codes), as these count as edits.

Null and empty texts match nothing; items of fewer than RUN words can't leak by definition.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words in a row that make a leak, and the share of them that may be changed, added or missing.
RUN, EDITS = 20, 0.2
WINDOW, STEP = 24, 8
BUCKETS, RANK, POWER, SAMPLE = 8192, 128, 2, 20_000
#: Least cosine in the latent space; chosen for recall, as every candidate is checked afterwards.
COSINE = 0.3
GAP = 3
#: Neighbouring words of an item that a chain of n words holds side by side at least: n less the edits are common, each edit or
#: the cut parts two. PAIRS of them in all, and some RUN words in a row that hold PAIRS_IN_RUN: the chain lies in as few such
#: windows as cover it, and no window lacks more than lie outside it.
def least_pairs(n: int) -> int:
    return n - 2 * int(EDITS * n) - 2


LENGTHS = range(RUN, 20 * RUN)
PAIRS = min(map(least_pairs, LENGTHS))
PAIRS_IN_RUN = min(max(math.ceil(least_pairs(n) / math.ceil((n - 1) / (RUN - 1))), least_pairs(n) - (n - RUN)) for n in LENGTHS)
DOCS_AT_ONCE, ITEMS_AT_ONCE = 256, 10_000
WORD = re.compile(r"[^\W_]+(?:[-'’][^\W_]+)*")
HYPHEN = re.compile(r"-(?<=[^\W\d_]-)[ \t]*\r?\n[ \t]*(?=[^\W\d_])")


def words_of(text: str | None) -> list[str]:
    """WORD in a text, with a short way for what stands between blanks and is nothing else."""
    out: list[str] = []
    for w in HYPHEN.sub("", text or "").lower().replace("’", "'").split():
        if w.isalnum():
            out.append(w)
        else:
            out += WORD.findall(w)
    return out


_CODES: dict[str, int] = {}


def codes_of(words: list[str]) -> np.ndarray:
    """Words as 32-bit numbers: what texts are compared by."""
    codes = _CODES
    if len(codes) > 500_000:
        codes.clear()
    try:
        return np.array([codes[w] for w in words], dtype=np.uint32)
    except KeyError:
        for w in words:
            if w not in codes:
                codes[w] = zlib.crc32(w.encode())
        return np.array([codes[w] for w in words], dtype=np.uint32)


def buckets(codes: np.ndarray) -> np.ndarray:
    return (codes.astype(np.uint32) % BUCKETS).astype(np.int32)


def read_words(documents: DataFrame) -> DataFrame:
    """doc_id, codes of every document: its words, read once and kept for all passes over them."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "codes": pd.Series([codes_of(words_of(t)).view(np.int32) for t in pdf["text"]], dtype=object)})

    return documents.select("doc_id", "text").mapInPandas(read, "doc_id bigint, codes array<int>")


def windows(b: np.ndarray) -> list[np.ndarray]:
    """Overlapping windows of hashed words; the last one reaches the end."""
    if len(b) <= WINDOW:
        return [b] if len(b) else []
    starts = list(range(0, len(b) - WINDOW, STEP)) + [len(b) - WINDOW]
    return [b[s : s + WINDOW] for s in starts]


def document_counts(read: DataFrame) -> tuple[np.ndarray, int]:
    """Documents per bucket and documents in all, over the whole corpus (column codes)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(BUCKETS + 1, dtype=np.int64)
        for pdf in batches:
            for codes in pdf["codes"]:
                total[np.unique(buckets(codes))] += 1
                total[BUCKETS] += 1
        yield pd.DataFrame({"bucket": np.arange(BUCKETS + 1, dtype=np.int32), "n": total})

    rows = read.select("codes").mapInPandas(count, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # BUCKETS rows
    out = np.zeros(BUCKETS + 1, dtype=np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out[:BUCKETS], int(out[BUCKETS])


def idf_weights(counts: np.ndarray, total: int) -> np.ndarray:
    """Not squared: an item that leaked into much of the corpus must keep weight beside the other words of a window."""
    return np.log((1 + total) / (1 + counts)) + 1e-3


def vectors(cuts: list[np.ndarray], idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows of unit length."""
    out = np.zeros((len(cuts), BUCKETS), dtype=np.float32)
    for i, c in enumerate(cuts):
        np.add.at(out[i], c, idf[c])
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.maximum(norm, 1e-9)


def in_parts(cuts: list[np.ndarray], size: int = 1000) -> Iterator[list[np.ndarray]]:
    """Windows a few at a time: their rows are dense."""
    return (cuts[k : k + size] for k in range(0, len(cuts), size))


def projected(b: np.ndarray, lengths: np.ndarray, terms: np.ndarray, squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(windows of texts in the latent space, text of each); b: the hashed words of all texts, lengths of them each.

    terms, squares: weighted basis rows and squared weights per bucket, and zeros at the end. A window is WINDOW words from every
    STEP-th on, the last ones of a text fewer: the sum of WINDOW / STEP blocks. Windows are scaled by their length before
    projection, which leaves repeated words apart; that can only raise a cosine."""
    blocks = -(-lengths // STEP)
    width = WINDOW // STEP
    first = np.cumsum(blocks) - blocks
    at = np.arange(len(b)) + np.repeat(first * STEP - (np.cumsum(lengths) - lengths), lengths)
    padded = np.full(int(blocks.sum()) * STEP, BUCKETS, dtype=np.intp)
    padded[at] = b
    padded = np.ascontiguousarray(padded.reshape(-1, STEP).T)  # the first words of all blocks, then the second ones and so on
    sums = terms[padded[0]]
    for row in padded[1:]:
        sums += terms[row]
    weights = squares[padded].sum(axis=0)
    owner = np.repeat(np.arange(len(lengths)), blocks)
    place = np.arange(len(owner)) - first[owner]
    starts = np.flatnonzero((place == 0) | (place <= blocks[owner] - width))  # a text shorter than a window is one
    total, weight = sums[starts], weights[starts]
    for i in range(1, width):
        inside = np.flatnonzero(place[starts] + i < blocks[owner[starts]])
        total[inside] += sums[starts[inside] + i]
        weight[inside] += weights[starts[inside] + i]
    return total / np.sqrt(np.maximum(weight, 1e-9))[:, None].astype(np.float32), owner[starts]


def randomised_svd(sample: DataFrame, items: list[np.ndarray], idf: np.ndarray, seed: int = 7) -> np.ndarray:
    """Right singular vectors (BUCKETS x RANK) of the sampled windows stacked on the item windows.

    sample: codes. Each round multiplies by A'A: partitions return their share of A'(AQ), which Spark adds up by row. The item
    windows are scaled to the weight of the sample, so that their few directions are not lost under the corpus's own."""
    spark = sample.sparkSession
    rng = np.random.default_rng(seed)
    basis = np.linalg.qr(rng.standard_normal((BUCKETS, RANK)))[0].astype(np.float32)
    n = max(1, sample.count())
    weight = max(1.0, 8.0 * n / max(1, len(items)))
    for _ in range(POWER):
        shared = spark.sparkContext.broadcast((basis, idf))

        def multiply(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            q, weights = shared.value
            total = np.zeros_like(q)
            for pdf in batches:
                for codes in pdf["codes"]:
                    for c in windows(buckets(codes)):
                        u, k = np.unique(c, return_counts=True)
                        x = (k * weights[u]).astype(np.float32)
                        x /= max(math.sqrt(float(x @ x)), 1e-9)
                        total[u] += np.outer(x, x @ q[u])
            used = np.flatnonzero(np.abs(total).sum(axis=1))
            yield pd.DataFrame({"row": used.astype(np.int32), "v": pd.Series([total[i].tolist() for i in used], dtype=object)})

        parts = sample.mapInPandas(multiply, "row int, v array<float>")
        summed = parts.select("row", F.posexplode("v")).groupBy("row", "pos").agg(F.sum("col").alias("x")).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("pos", "x"))).alias("v")).select("row", "v.x")
        product = np.zeros_like(basis)
        for part in in_parts(items):
            fixed = vectors(part, idf)
            product += np.float32(weight) * (fixed.T @ (fixed @ basis))
        for r in summed.collect():  # at most BUCKETS rows of RANK numbers
            product[r["row"]] += np.asarray(r["x"], dtype=np.float32)
        basis = np.linalg.qr(product)[0].astype(np.float32)
    return basis


def is_answer(word: str) -> bool:
    return any(c.isdigit() for c in word)


def chain(doc: list, item: list, answer: list[bool] | None = None) -> tuple[int, int]:
    """(item words covered, edits) of the longest chain of common words that holds the item's answers.

    A chain follows document and item with at most GAP words missing on either side between two common words, and once over
    any other text of the document. Its edits stay within EDITS, and it has at least half of the words with digits that the
    item has there: texts that share a wording but not its figures are different. doc and item: words, or their codes with what
    is an answer of the item."""
    where: dict = defaultdict(list)
    for j, w in enumerate(item):
        where[w].append(j)
    answer = [is_answer(w) for w in item] if answer is None else answer
    answers = [0]
    for x in answer:
        answers.append(answers[-1] + x)
    # a state is (score, start in item, edits, answers found); of each common word the best without and with the cut
    recent: list[tuple[int, dict[int, tuple]]] = []  # the last common words: place in the document, item place -> states
    ends: dict[int, list] = defaultdict(list)
    top = (0, 0)
    for i, w in enumerate(doc):
        if w not in where:
            continue
        recent = [x for x in recent if x[0] >= i - GAP - 1]
        here: dict[int, tuple] = {}
        for j in where[w]:
            hit = answer[j]
            whole, cut = (1, j, 0, hit), None
            for before, states in recent:
                di = i - before
                for dj in range(1, GAP + 2):
                    state = states.get(j - dj)
                    if state is None:
                        continue
                    e = max(di, dj) - 1
                    x, y = state
                    if x[0] + 1 - 4 * e > whole[0]:
                        whole = (x[0] + 1 - 4 * e, x[1], x[2] + e, x[3] + hit)
                    if y is not None and (cut is None or y[0] + 1 - 4 * e > cut[0]):
                        cut = (y[0] + 1 - 4 * e, y[1], y[2] + e, y[3] + hit)
            for dj in range(1, GAP + 2):
                for x, at in ends.get(j - dj, ()):
                    if at < i - GAP - 1 and (cut is None or x[0] + 5 - 4 * dj > cut[0]):
                        cut = (x[0] + 5 - 4 * dj, x[1], x[2] + dj - 1, x[3] + hit)
            here[j] = (whole, cut)
            if whole[0] >= 3 and (not ends[j] or whole[0] > ends[j][-1][0][0]):
                ends[j].append((whole, i))
            for x in (whole, cut):
                if x is not None:
                    length = j - x[1] + 1
                    if length > top[0] and x[2] <= EDITS * length and 2 * x[3] >= answers[j + 1] - answers[x[1]]:
                        top = (length, x[2])
        recent.append((i, here))
    return top


class ItemIndex:
    """The items' words and word pairs: numbers of words, and at which places of which items a pair of neighbours stands."""

    def __init__(self, items: dict[int, list[str]]):
        self.items = np.array(sorted(items), dtype=np.int64)
        held = [codes_of(items[i]) for i in self.items]
        self.codes = np.unique(np.concatenate(held))
        self.size = len(self.codes) + 1
        self.texts = [(c.tolist(), [is_answer(w) for w in items[i]]) for i, c in zip(self.items, held)]  # codes, what is an answer
        self.longest = max(len(c) for c in held)
        self.table = np.zeros((len(held), self.longest), dtype=np.int32)  # the numbers of an item's words, filled up with 0
        answers = np.zeros((len(held), self.longest + 1), dtype=np.int32)
        for k, (c, (_, answer)) in enumerate(zip(held, self.texts)):
            self.table[k, : len(c)] = self.numbers(c)
            answers[k, 1 : len(c) + 1] = answer
        self.answers = np.cumsum(answers, axis=1)
        numbers = [self.numbers(c) for c in held]
        keys = np.concatenate([n[:-1] * self.size + n[1:] for n in numbers])
        owners = np.repeat(np.arange(len(held)), [len(n) - 1 for n in numbers])
        places = np.concatenate([np.arange(len(n) - 1) for n in numbers])
        order = np.argsort(keys, kind="stable")
        self.owners, self.places = owners[order], places[order]
        self.keys, first = np.unique(keys[order], return_index=True)
        self.bounds = np.append(first, len(keys))

    def numbers(self, codes: np.ndarray) -> np.ndarray:
        """The number of each word among the items' words, from 1; 0 for others."""
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, at + 1, 0)

    def possible(self, codes: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
        """Per text (its words' codes, one text after the other) the places in self.items of those that may have a chain of RUN
        words or more: the text shares enough word pairs, close enough to each other, and somewhere in the item it holds all
        words but the edits, with half of the answers among them."""
        text = np.repeat(np.arange(len(lengths)), lengths)
        numbers = self.numbers(codes)
        at = np.flatnonzero((numbers[:-1] > 0) & (numbers[1:] > 0) & (text[:-1] == text[1:]))
        keys = numbers[at] * self.size + numbers[at + 1]
        k = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = self.keys[k] == keys
        seen = np.unique(text[at[hit]] * len(self.keys) + k[hit])  # each pair once a text
        owner, k = np.divmod(seen, len(self.keys))
        counts = self.bounds[k + 1] - self.bounds[k]
        rows = np.repeat(self.bounds[k] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        n_items = len(self.items)
        cells, where, shared = np.unique(np.repeat(owner, counts) * n_items + self.owners[rows], return_inverse=True, return_counts=True)
        enough = shared >= PAIRS
        keep = enough[where]
        held = np.zeros((int(enough.sum()), self.longest + RUN), dtype=np.int16)  # the pairs of each text and item left, by place
        held[(np.cumsum(enough) - 1)[where[keep]], self.places[rows[keep]] + 1] = 1
        sums = np.cumsum(held, axis=1, dtype=np.int16)
        cells = cells[enough][(sums[:, RUN - 1 :] - sums[:, : 1 - RUN]).max(axis=1, initial=0) >= PAIRS_IN_RUN]
        able = cells[self.holds(text, numbers, len(lengths), *np.divmod(cells, n_items))]
        return np.split(able % n_items, np.searchsorted(able // n_items, np.arange(1, len(lengths))))


    def holds(self, text: np.ndarray, numbers: np.ndarray, n: int, texts: np.ndarray, items: np.ndarray) -> np.ndarray:
        """Whether these texts hold a span of these items: RUN words or more, all but the edits, and half of its answers."""
        there = np.zeros((n, self.size), dtype=bool)
        there[text, numbers] = True
        there[:, 0] = False
        held = there[texts[:, None], self.table[items]]
        answer = np.diff(self.answers, axis=1)[items] > 0
        words, found, asked = (np.zeros((len(texts), self.longest + 1), dtype=np.int32) for _ in range(3))
        np.cumsum(held, axis=1, out=words[:, 1:])
        np.cumsum(held & answer, axis=1, out=found[:, 1:])
        asked[:, :] = self.answers[items]
        out = np.zeros(len(texts), dtype=bool)
        for length in range(RUN, self.longest + 1):
            enough = words[:, length:] - words[:, :-length] >= math.ceil((1 - EDITS) * length - 1e-9)
            answered = 2 * (found[:, length:] - found[:, :-length]) >= asked[:, length:] - asked[:, :-length]
            out |= (enough & answered).any(axis=1)
        return out


def leak_passages(documents: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, cosine (greatest of any two windows, 0 where below COSINE), covered (item words), edits of every document
    (doc_id, text) that holds a passage of an item (item_id, text)."""
    from ..session import materialize, spread

    texts = items.where("text is not null").select("item_id", "text")
    blocks = max(1, -(-texts.count() // ITEMS_AT_ONCE))
    read = materialize(read_words(spread(documents.select("doc_id", "text"))), "document-words")
    counts, total = document_counts(read)
    found = None
    for k in range(blocks):
        mine = texts if blocks == 1 else texts.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k)
        held = {r["item_id"]: words_of(r["text"]) for r in mine.collect()}  # a block of the held-out set
        held = {i: w for i, w in sorted(held.items()) if len(w) >= RUN}
        if held:
            rows = _search(spread(read), held, idf_weights(counts, total), total)
            found = rows if found is None else found.unionByName(rows)
    return found if found is not None else documents.select("doc_id", *[F.lit(0).cast(t).alias(c) for c, t in (("item_id", "bigint"), ("cosine", "double"), ("covered", "int"), ("edits", "int"))]).where("false")


def _search(read: DataFrame, held: dict[int, list[str]], idf: np.ndarray, total: int) -> DataFrame:
    from ..session import hash_share, materialize

    index = ItemIndex(held)
    cuts = [(k, c) for k, i in enumerate(index.items) for c in windows(buckets(codes_of(held[i])))]
    sample = read.where(hash_share("doc_id") < min(1.0, SAMPLE / 10 / max(1, total))).select("codes")  # about ten windows a text
    basis = randomised_svd(materialize(sample.repartition(4), "leak-sample"), [c for _, c in cuts], idf)
    targets = np.concatenate([vectors(part, idf) @ basis for part in in_parts([c for _, c in cuts])])
    targets /= np.maximum(np.linalg.norm(targets, axis=1, keepdims=True), 1e-9)
    first = np.searchsorted([k for k, _ in cuts], np.arange(len(held)))  # the windows of an item follow each other
    terms = np.concatenate([idf[:, None] * basis, np.zeros((1, RANK))]).astype(np.float32)
    shared = read.sparkSession.sparkContext.broadcast((terms, np.append(idf**2, 0.0), targets.T.copy(), first, index))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows_of, squares, z, starts, known = shared.value
        for pdf in batches:
            rows = []
            for k in range(0, len(pdf), DOCS_AT_ONCE):
                part = pdf.iloc[k : k + DOCS_AT_ONCE]
                cut = [(doc, c.view(np.uint32)) for doc, c in zip(part["doc_id"], part["codes"]) if len(c) >= RUN * (1 - EDITS)]
                if not cut:
                    continue
                lengths = np.array([len(c) for _, c in cut])
                codes = np.concatenate([c for _, c in cut])
                latent, owner = projected(buckets(codes), lengths, rows_of, squares)
                far = np.einsum("ij,ij->i", latent, latent) >= COSINE**2  # a shorter vector has no such cosine with any
                latent, owner = latent[far], owner[far]
                near: list[dict[int, float]] = [{} for _ in cut]  # retrieved items with their cosine
                if len(owner):
                    first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
                    cosines = np.maximum.reduceat(np.maximum.reduceat(latent @ z, first, axis=0), starts, axis=1)  # texts x items
                    for t, j in zip(*np.nonzero(cosines >= COSINE)):
                        near[owner[first[t]]][int(j)] = float(cosines[t, j])
                for (doc, c), retrieved, able in zip(cut, near, known.possible(codes, lengths)):
                    if not len(able):
                        continue
                    c, able = c.tolist(), able.tolist()
                    for j in [*(j for j in able if j in retrieved), *(j for j in able if j not in retrieved)]:  # what the space leaves is checked as well
                        covered, edits = chain(c, *known.texts[j])
                        if covered >= RUN:
                            rows.append((doc, int(known.items[j]), retrieved.get(j, 0.0), covered, edits))
            yield pd.DataFrame(rows, columns=["doc_id", "item_id", "cosine", "covered", "edits"])

    return read.select("doc_id", "codes").mapInPandas(search, "doc_id bigint, item_id bigint, cosine double, covered int, edits int")


def leaks(documents: DataFrame, items: DataFrame) -> DataFrame:
    """The columns of p8_found: doc_id, item_id."""
    return leak_passages(documents, items).select("doc_id", "item_id")
