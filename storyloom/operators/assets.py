"""Image candidates of bundles settled as stored files."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from ..functions import html as H
from ..functions import text as T
from ..sinks.writers import store_files

MOST, MOST_BYTES = 6, 8_000_000
#: What is added to a candidate; all null where it was not needed, only asset_error set where it failed.
FIELDS = ("local_path", "asset_content_type", "asset_sha256", "asset_bytes", "asset_from_cache", "asset_final_url", "asset_retrieval_source", "asset_profile", "asset_error")


@F.pandas_udf(ArrayType(IntegerType()))
def planned_order(images: pd.Series, most: pd.Series) -> pd.Series:
    return pd.Series([H.asset_plan([x or {} for x in (list(i) if i is not None else [])], int(n)) for i, n in zip(images, most)])


def content_type_of(suffix):
    """The type that a suffix stands for, null for none of the known ones."""
    out = F.lit(None).cast("string")
    for kind, ending in T.IMAGE_TYPES.items():
        if kind != "image/jpg":
            out = F.when(suffix == ending, kind).otherwise(out)
    return out


def with_assets(bundles: DataFrame, root: str, fetch: Callable[[DataFrame], DataFrame], stored: DataFrame | None = None, most: int = MOST, most_bytes: int = MOST_BYTES) -> DataFrame:
    """bundles (vendor, sha256, related_images, ...) whose images carry FIELDS for the first `most` that could be settled, in the
    order of asset_plan; failures are noted and take no place. Files lie in root/vendor slug/sha256.assets, named by the digest
    of the embedded body or the address.

    fetch: DataFrame of url -> the columns of crawl.FETCHED. stored (path, content): files of earlier runs, used again without
    asking. All planned addresses are fetched at once, so that up to most + 4 requests are made that a walk in order would spare."""
    rows = bundles.select("vendor", "sha256", F.posexplode("related_images").alias("i", "image"), planned_order("related_images", F.lit(most)).alias("plan"))
    rows = rows.withColumns({
        "place": F.array_position("plan", F.col("i")).cast("int"),
        "folder": F.concat(F.lit(root.rstrip("/") + "/"), T.slugify(F.col("vendor")), F.lit("/"), F.col("sha256"), F.lit(".assets/")),
        "digest": T.digest16(F.coalesce("image.embedded", F.nullif("image.url", F.lit("")), "image.source")), "url": F.when(F.col("image.embedded").isNull(), F.col("image.url")),
    })
    if stored is None:
        rows = rows.withColumns({"old_path": F.lit(None).cast("string"), "old": F.lit(None).cast("binary")})
    else:
        named = stored.select(F.regexp_extract("path", r"([^/]+\.assets/[0-9a-f]{16})\.[a-z]+$", 1).alias("k"), F.col("path").alias("old_path"), F.col("content").alias("old"))
        first = named.where("k <> ''").groupBy("k").agg(F.min_by(F.struct("old_path", "old"), "old_path").alias("f")).select("k", "f.*")
        rows = rows.join(first, F.concat("sha256", F.lit(".assets/"), "digest") == F.col("k"), "left").drop("k")
    asked = rows.where("place > 0 and old is null and url <> ''").select("url").distinct()
    got = fetch(asked).select("url", *[F.col(c).alias(f"f_{c}") for c in ("body", "content_type", "final_url", "retrieval_source", "profile", "error")])
    rows = rows.join(got, "url", "left")
    embedded = F.col("image.embedded").cast("binary")
    kind = F.coalesce("f_content_type", F.lit(""))
    bare = F.lower(F.trim(F.substring_index(kind, ";", 1)))
    body = F.coalesce("old", embedded, "f_body")
    suffix = F.when(embedded.isNotNull(), ".svg").otherwise(T.image_suffix(F.col("f_body"), kind, F.col("url")))
    fresh = F.col("old").isNull() & embedded.isNull()
    error = (
        F.when(fresh & F.col("f_error").isNotNull(), F.col("f_error"))
        .when(fresh & (F.length("f_body") > most_bytes), F.lit(f"image exceeds max_bytes={most_bytes}"))
        .when(fresh & ~T.is_image(F.col("f_body"), kind, F.col("url")), F.concat(F.lit("non-image response: "), F.coalesce(F.nullif(kind, F.lit("")), F.lit("unknown content type"))))
        .when(fresh & (suffix == ".bin") & bare.startswith("image/"), F.concat(F.lit("unknown image type: "), kind))
    )
    rows = rows.withColumns({"body": body, "suffix": suffix, "error": error}).withColumn("good", (F.col("place") > 0) & F.col("body").isNotNull() & F.col("error").isNull())
    w = Window.partitionBy("vendor", "sha256").orderBy(F.col("place") == 0, "place")  # a bundle's images
    before = F.coalesce(F.sum(F.col("good").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("reached", (F.col("place") > 0) & (before < most)).withColumn("taken", F.col("good") & F.col("reached"))
    path = F.coalesce("old_path", F.concat("folder", "digest", "suffix"))
    by_suffix = content_type_of(F.regexp_extract(path, r"(\.[a-z]+)$", 1))
    settled = F.when(embedded.isNotNull() & F.col("old").isNull(), F.lit("image/svg+xml")).otherwise(F.coalesce(by_suffix, F.nullif(kind, F.lit("")), F.lit("application/octet-stream")))
    sent = lambda c: F.when(F.col("taken") & fresh, F.col(c))
    mine = {
        "local_path": F.when(F.col("taken"), path), "asset_content_type": F.when(F.col("taken"), settled), "asset_sha256": F.when(F.col("taken"), F.sha2("body", 256)),
        "asset_bytes": F.when(F.col("taken"), F.length("body").cast("bigint")), "asset_from_cache": F.when(F.col("taken"), F.col("old").isNotNull()), "asset_final_url": sent("f_final_url"),
        "asset_retrieval_source": sent("f_retrieval_source"), "asset_profile": sent("f_profile"), "asset_error": F.when(F.col("reached"), F.col("error")),
    }
    rows = rows.withColumns(mine)
    written = store_files(rows.where("taken and old is null").select(F.col("local_path").alias("path"), "body"))
    rows = rows.join(written.select(F.col("path").alias("local_path"), "written"), "local_path", "left")
    image = F.struct("i", F.struct("image.*", *FIELDS, F.col("written")).alias("image"))
    grouped = rows.groupBy("vendor", "sha256").agg(F.transform(F.sort_array(F.collect_list(image)), lambda x: x["image"].dropFields("embedded", "written")).alias("_images"))
    out = bundles.join(grouped, ["vendor", "sha256"], "left")
    return out.withColumn("related_images", F.coalesce("_images", F.array().cast(grouped.schema["_images"].dataType))).drop("_images")
