"""Queries of the llm operators: name -> (spark, folder of the tables) -> DataFrame."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_dir, table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .canonical import mapped_values

    return mapped_values(table(spark, sf_dir, "case_studies"), table(spark, sf_dir, "taxonomy"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pairs import frequent_pairs

    return frequent_pairs(table(spark, sf_dir, "case_studies"))


def p2_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pairs import pair_statistics

    return pair_statistics(table(spark, sf_dir, "case_studies"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pages import story_line_numbers

    return story_line_numbers(table(spark, sf_dir, "raw_pages"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .names import linked_names, name_spellings

    vendors = [r["value"] for r in table(spark, sf_dir, "taxonomy").where("kind = 'vendors'").select("value").collect()]  # a fixed list
    return linked_names(name_spellings(table(spark, sf_dir, "case_studies")), vendors)


#: Changes when what is kept of pages changes, so that no state of another kind is read.
STORIES = "known-stories-1"


def _state(spark: SparkSession, sf_dir: str) -> str:
    """The folder that keeps what was read of these tables from one call to the next."""
    return f"{shared_dir(spark)}/{STORIES}-{hashlib.sha256(sf_dir.rstrip('/').encode()).hexdigest()[:16]}"


def p4_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every spelling with its cluster: one row each, where p4_found gives all pairs."""
    from .names import clustered_names, name_spellings

    vendors = [r["value"] for r in table(spark, sf_dir, "taxonomy").where("kind = 'vendors'").select("value").collect()]  # a fixed list
    return clustered_names(name_spellings(table(spark, sf_dir, "case_studies")), vendors)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .known_pages import known_urls

    return known_urls(*(table(spark, sf_dir, t) for t in ("discovered_urls", "run_log", "fetch_manifest", "raw_pages")), _state(spark, sf_dir))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .residue_attempts import residue_attempts

    return residue_attempts(table(spark, sf_dir, "fetch_manifest"), table(spark, sf_dir, "raw_pages"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .leaks import leaks

    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p8_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p8_found with the latent cosine, the item words covered and the edits."""
    from .leaks import leak_passages

    return leak_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import shares

    return shares(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


def p9_shares_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As much as the listed sources hold in all: short sources reach their cap and are reported short of their target."""
    from .mixing import listed_tokens, shares

    documents, targets = table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets")
    return shares(documents, targets, total=listed_tokens(documents, targets))


def p9_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix

    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets")).select("doc_id", "source", "copies")


def p10_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .languages import document_languages

    return document_languages(table(spark, sf_dir, "documents"))


def p10_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .languages import foreign_passages

    return foreign_passages(table(spark, sf_dir, "documents"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .languages import wrong_labels

    return wrong_labels(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name[:1] == "p" and name[1:2].isdigit()}


def oracle_sql() -> dict[str, str]:
    from .pairs import SQL, STATISTICS_SQL

    return {"p2_found": SQL, "p2_statistics": STATISTICS_SQL}
