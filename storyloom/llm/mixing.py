"""Sources mixed to target shares of the total size by pivotal dependent rounding.

Sizes are tokens of a public tokenizer. Unless a size is given, the mixture is the largest in which every source that has
tokens reaches its target; a source without any can't, and its share goes to the others by their targets. With a given size,
a source that its documents, used max_repeats times each, can't fill gives all of that, and the others make up for it likewise. 
A document of a source gets the source's copies per document as expectation: the whole part outright, the fraction by
rounding. Two documents at a time, token mass is moved from one's fraction to the other's, in a direction drawn so that
expectations hold, until one fraction is 0 or 1; the source's tokens stay the same throughout. Each source is cut into cells
by a hash of the document, of about CELL documents, and a cell is paired in the order of such a hash; the one document it
leaves open goes up a reduction tree of FAN_IN cells to a node, and the root's is drawn. Cells, order and draws depend on
document ids, the seed and the number of a source's documents alone, so any partitioning of the input gives the same copies.

Documents without a listed source are not used. Null and empty texts have no tokens; they get the whole part of the copies.
"""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, spread

#: Documents of a source that one group pairs, and residuals that a node of the reduction tree pairs.
CELL, FAN_IN = 20_000, 64
EPS = 1e-9


def tokenizer_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    """File of a public tokenizer: below STORYLOOM_TOKENIZERS, else /opt/tokenizers."""
    return os.path.join(os.environ.get("STORYLOOM_TOKENIZERS", "/opt/tokenizers"), name)


#: How that vocabulary's tokenizer splits text before merging (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def count_tokens(documents: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, source, tokens. The vocabulary (one bounded file) is sent to the executors."""
    with open(path or tokenizer_path(), "rb") as f:
        shared = documents.sparkSession.sparkContext.broadcast(f.read())

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, shared.value.splitlines())}
        encoding = tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "source": pdf["source"], "tokens": [len(encoding.encode_ordinary(t)) if t else 0 for t in pdf["text"]]})

    return spread(documents.select("doc_id", "source", "text")).mapInPandas(count, "doc_id bigint, source string, tokens bigint")


def plan_sources(sizes: dict[str, int], targets: list[tuple[str, float, int]], total: int | None = None) -> dict[str, float]:
    """source -> tokens it is to give: by target, at most size x repeats, lacks passed on to the others by their targets."""
    most = {s: float(sizes.get(s, 0) * max(0, r)) for s, _, r in targets}
    want = {s: max(0.0, w or 0.0) for s, w, _ in targets}
    given = dict.fromkeys(want, 0.0)
    open_ = {s for s in want if want[s] > 0 and most[s] > 0}
    if total is None:
        left = min((most[s] / want[s] for s in open_), default=0.0) * sum(want[s] for s in open_)
    else:
        left = float(total)
    while open_ and left > EPS:
        weight = sum(want[s] for s in open_)
        full = {s for s in open_ if left * want[s] / weight >= most[s] - given[s]}
        if not full:
            for s in open_:
                given[s] += left * want[s] / weight
            break
        for s in full:
            left -= most[s] - given[s]
            given[s] = most[s]
        open_ -= full
    return given


def draw(seed: int, *ids: int) -> float:
    """A number in [0, 1) from the ids."""
    return int.from_bytes(hashlib.blake2b(":".join(map(str, (seed, *ids))).encode(), digest_size=6).digest()) / (1 << 48)


class Pivot:
    """Pairs fractional documents of one source one after the other; at most one stays open."""

    def __init__(self, seed: int):
        self.seed = seed
        self.open: tuple[int, int, float] | None = None

    def add(self, doc: int, size: int, p: float) -> list[tuple[int, int]]:
        """The (document, 0 or 1) that this document decides."""
        if p <= EPS or p >= 1 - EPS:
            return [(doc, int(p > 0.5))]
        if size <= 0:  # no mass to move
            return [(doc, int(draw(self.seed, doc) < p))]
        if self.open is None:
            self.open = (doc, size, p)
            return []
        other, other_size, q = self.open
        up = min((1 - p) * size, q * other_size)  # mass from the open one to this one
        down = min(p * size, (1 - q) * other_size)
        move = up if draw(self.seed, doc, other) < down / (up + down) else -down
        p, q = p + move / size, q - move / other_size
        out = []
        self.open = None
        for d, z, x in ((doc, size, p), (other, other_size, q)):
            if x <= EPS or x >= 1 - EPS:
                out.append((d, int(x > 0.5)))
            else:
                self.open = (d, z, x)
        return out


NODE = "doc_id bigint, source string, tokens bigint, base int, p double, cell bigint"
ROUNDED = f"{NODE}, extra int"


def rounded(rows: DataFrame, seed: int) -> DataFrame:
    """rows (columns of NODE) with extra: 0 or 1 where their cell decides them, null for the one it leaves open."""

    def pair(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(o=[draw(seed, d, -1) for d in pdf["doc_id"]]).sort_values(["o", "doc_id"])
        pivot, extra, p = Pivot(seed), {}, dict(zip(pdf["doc_id"], pdf["p"]))
        for d, tokens, x in zip(pdf["doc_id"], pdf["tokens"], pdf["p"]):
            extra.update(pivot.add(d, tokens, x))
        if pivot.open:
            p[pivot.open[0]] = pivot.open[2]
        return pdf.drop(columns="o").assign(p=[p[d] for d in pdf["doc_id"]], extra=pd.array([extra.get(d) for d in pdf["doc_id"]], dtype="Int32"))

    return rows.groupBy("source", "cell").applyInPandas(pair, ROUNDED)


def mix(documents: DataFrame, targets: DataFrame, total: int | None = None, seed: int = 11, path: str | None = None) -> DataFrame:
    """doc_id, source, tokens, copies of every document with a listed source; doc_id is unique."""
    wanted = [(r["source"], r["target_share"], r["max_repeats"]) for r in targets.select("source", "target_share", "max_repeats").collect()]  # one row per source
    spark = documents.sparkSession
    names = spark.createDataFrame([(s,) for s, _, _ in wanted], "source string")
    sized = materialize(count_tokens(documents.join(F.broadcast(names), "source", "left_semi"), path), "document-tokens")
    about = {r["source"]: (r["n"], r["docs"]) for r in sized.groupBy("source").agg(F.sum("tokens").alias("n"), F.count("*").alias("docs")).collect()}
    sizes = {s: n for s, (n, _) in about.items()}
    given = plan_sources(sizes, wanted, total)
    cells = {s: max(1, -(-about[s][1] // CELL)) for s in about}
    copies = spark.createDataFrame([(s, given[s] / sizes[s] if sizes.get(s) else 0.0, cells.get(s, 1)) for s, _, _ in wanted], "source string, per_document double, cells bigint")
    rows = sized.join(F.broadcast(copies), "source")
    base = F.floor(F.col("per_document") + EPS).cast("int")
    cell = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.col("cells")).alias("cell")
    rows = rows.select("doc_id", "source", "tokens", base.alias("base"), F.greatest(F.lit(0.0), F.col("per_document") - base).alias("p"), cell)
    whole = rows.where(F.col("p") <= EPS).withColumn("extra", F.lit(0))  # nothing to round, nothing to shuffle
    left = rows.where(F.col("p") > EPS)
    done, most = [whole], max(cells.values(), default=1)
    while True:
        step = materialize(rounded(left, seed), "mix")
        done.append(step.where("extra is not null"))
        left = step.where("extra is null").drop("extra").withColumn("cell", F.floor(F.col("cell") / FAN_IN))
        if most == 1:
            break
        most = -(-most // FAN_IN)

    def last(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(extra=[int(draw(seed, d) < p) for d, p in zip(pdf["doc_id"], pdf["p"])])

    out = left.mapInPandas(last, ROUNDED)  # one a source
    for d in done:
        out = out.unionByName(d)
    return out.select("doc_id", "source", "tokens", (F.col("base") + F.col("extra")).alias("copies"))


def listed_tokens(documents: DataFrame, targets: DataFrame, path: str | None = None) -> int:
    """Tokens of all documents of the listed sources."""
    names = targets.select("source").distinct()
    return count_tokens(documents.join(F.broadcast(names), "source", "left_semi"), path).agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]  # one row per source


def shares(documents: DataFrame, targets: DataFrame, total: int | None = None, path: str | None = None) -> DataFrame:
    """One row per target: source, target_share, max_repeats, documents, available_tokens, unused_tokens (of documents left
    out), mixed_tokens, most_copies, reached_share."""
    mixed = mix(documents, targets, total, path=path)
    per = mixed.groupBy("source").agg(F.count("*").alias("documents"), F.sum("tokens").alias("available_tokens"), F.sum(F.when(F.col("copies") == 0, F.col("tokens")).otherwise(0)).alias("unused_tokens"), F.sum(F.col("tokens") * F.col("copies")).alias("mixed_tokens"), F.max("copies").alias("most_copies"))
    out = targets.join(per, "source", "left").fillna(0, ["documents", "available_tokens", "unused_tokens", "mixed_tokens", "most_copies"])
    out = materialize(out, "mix-shares")
    whole = F.broadcast(out.agg(F.sum("mixed_tokens").alias("whole")))  # one row
    return out.join(whole).select(
        "source", "target_share", "max_repeats", "documents", "available_tokens", "unused_tokens", "mixed_tokens", "most_copies",
        F.when(F.col("whole") > 0, F.col("mixed_tokens") / F.col("whole")).otherwise(0.0).alias("reached_share"),
    )
