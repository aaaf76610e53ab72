"""Fetch attempts whose page or error text is residue instead of content."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pages, residue


def residue_pages(raw_pages: DataFrame) -> DataFrame:
    """raw_path, kind ('message', 'placeholder' or 'filler') of the stored pages whose story is residue.

    A page without any story whose notice for browsers without scripts is all there is to read counts as a message.
    Empty and null bodies have no residue."""

    def work(host, body, rules, known):
        story = [t for _, t in pages.raw_story(host, body, rules)]
        if not story and body and pages.is_markup(body):
            story = [t for _, _, leaf, t, _ in pages.parse_markup(body) if leaf == "noscript"]
        kind = residue.story_residue(story, known) if story else None
        return [(kind,)] if kind else []

    return pages.apply_rules(pages.host_pages(raw_pages), work, "raw_path string, kind string")


def error_texts(manifest: DataFrame) -> DataFrame:
    """The rows of manifest whose error text is an unfilled template or, with status 200, a page's message.

    Whether a text is one depends on the exemplars alone, so each batch is judged where it lies."""
    index = residue.Index(residue.EXEMPLARS)

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict = {}
        for pdf in batches:
            flags = []
            for error, status in zip(pdf["error"], pdf["status"]):
                key = (error, status == 200)
                if key not in seen:
                    if len(seen) > 100_000:
                        seen.clear()
                    seen[key] = residue.error_residue(error, 200 if key[1] else 0, index)
                flags.append(seen[key])
            yield pdf[flags]

    rows = manifest.where(F.length(F.trim("error")) > 0)
    return rows.mapInPandas(keep, rows.schema)


def residue_attempts(manifest: DataFrame, raw_pages: DataFrame) -> DataFrame:
    """Distinct url, fetched_at of the attempts to be excluded.

    manifest: url, fetched_at, raw_path, status, error. An attempt whose raw_path has no stored page is judged by its error."""
    rows = manifest.select("url", "fetched_at", "raw_path", "status", "error")
    by_error = error_texts(rows).select("url", "fetched_at")
    flagged = residue_pages(raw_pages).select("raw_path")
    by_page = rows.where(F.col("raw_path").isNotNull()).select("raw_path", "url", "fetched_at").join(flagged, "raw_path", "left_semi").select("url", "fetched_at")
    return by_page.unionByName(by_error).distinct()
