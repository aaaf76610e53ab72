"""Queries over records: scores, validation, merge, frequencies, matrices, search."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import analytics as A
from ..operators import records as R
from ..session import shared_dir, table
from .registry import query


def cs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "case_studies")


def one_each(records: DataFrame) -> DataFrame:
    """One row per id: records delivered twice have equal content."""
    return records.dropDuplicates(["id"])


ONE = "(select * from case_studies qualify row_number() over (partition by id order by slug) = 1)"
TRUTHY = "(coalesce({0}, '') <> '')::int"
FILLED = "(coalesce(len({0}), 0) > 0)::int"
MATURITY = " + ".join([TRUTHY.format(c) for c in ("business_problem", "solution_summary", "business_outcome")] + [FILLED.format(c) for c in ("products_used", "architecture_clues", "metrics")])
CONFIDENCE = "round((" + " + ".join(
    [TRUTHY.format(c) for c in ("vendor", "customer_name", "industry", "region", "business_problem", "solution_summary", "business_outcome", "source_url", "published_date")]
    + [FILLED.format(c) for c in ("products_used", "technical_area", "use_case_category")]
) + ") / 12.0, 2)"
LABEL = "case when {0} >= 5 then 'Strong reference' when {0} >= 3 then 'Useful but limited' else 'Marketing-level' end"


def counts_sql(source: str) -> str:
    return f"with v as ({source}) select label, count(*) count, count(*) / (select count(*) from v)::double share from v group by label"


@query("a01_industry_counts", counts_sql("select industry as label from case_studies where industry is not null"))
def a01_industry_counts(spark, d):
    return A.count_values(cs(spark, d).select(F.col("industry").alias("label")))


@query("a01_technical_area_counts", counts_sql("select label from (select unnest(technical_area) as label from case_studies) where label <> ''"))
def a01_technical_area_counts(spark, d):
    return A.count_values(A.tag_values(cs(spark, d), "technical_area"))


@query("a01_outcome_counts", counts_sql("select label from (select unnest(outcome_category) as label from case_studies) where label <> ''"))
def a01_outcome_counts(spark, d):
    return A.count_values(A.tag_values(cs(spark, d), "outcome_category"))


@query("a02_top_products", counts_sql("select label from (select unnest(products_used) as label from case_studies) where label <> ''") + " order by 2 desc, 1 limit 10")
def a02_top_products(spark, d):
    return A.top_values(A.tag_values(cs(spark, d), "products_used"), 10)


@query("a03_mean_confidence", f"select coalesce(avg(coalesce(nullif(confidence_score, 0), {CONFIDENCE})), 0) mean_confidence from case_studies")
def a03_mean_confidence(spark, d):
    return R.fill_scores(cs(spark, d)).agg(F.coalesce(F.avg("confidence_score"), F.lit(0.0)).alias("mean_confidence"))


@query("a04_maturity_distribution", f"select {LABEL.format('s')} as label, count(*) count, count(*) / (select count(*) from case_studies)::double share from (select coalesce(nullif(maturity_score, 0), {MATURITY}) s from case_studies) group by 1")
def a04_maturity_distribution(spark, d):
    return A.count_values(R.fill_scores(cs(spark, d)).select(R.maturity_label(F.col("maturity_score")).alias("label")))


MATRIX = """
with c as ({columns}), r as (select distinct industry as label from case_studies where industry is not null),
h as (select industry as label, unnest(list_distinct(use_case_category)) as col from case_studies)
select r.label, c.label as "column", count(h.col) as count from r cross join c left join h on h.label = r.label and h.col = c.label group by 1, 2
"""
ALPHABETICAL = "select distinct label from (select unnest(use_case_category) as label from case_studies) where label <> '' order by 1 limit 8"
BY_COUNT = "select label from (select unnest(use_case_category) as label from case_studies) where label <> '' group by label order by count(*) desc, label limit 8"


def _matrix(spark, d, by):
    records = cs(spark, d)
    return A.matrix_cells(records, "industry", "use_case_category", A.matrix_columns(records, "use_case_category", 8, by))


@query("a05_matrix_alphabetical", MATRIX.format(columns=ALPHABETICAL))
def a05_matrix_alphabetical(spark, d):
    return _matrix(spark, d, "alphabetical")


@query("a05_matrix_by_count", MATRIX.format(columns=BY_COUNT))
def a05_matrix_by_count(spark, d):
    return _matrix(spark, d, "count")


@query("a05_matrix_totals", "select label, sum(count)::bigint total from (" + MATRIX.format(columns=BY_COUNT) + ") group by label")
def a05_matrix_totals(spark, d):
    return A.matrix_totals(_matrix(spark, d, "count"))


@query("a05_vendor_industry_pivot", "select vendor, " + ", ".join(f"count(distinct id) filter (industry = '{i}') as \"{i}\"" for i in ("Energy", "Telecom and Networks", "Power and Utilities", "Business Software")) + " from case_studies group by vendor")
def a05_vendor_industry_pivot(spark, d):
    names = ["Energy", "Telecom and Networks", "Power and Utilities", "Business Software"]
    return cs(spark, d).groupBy("vendor").pivot("industry", names).agg(F.count_distinct("id")).na.fill(0)


@query("a06_layer_counts", counts_sql("select trim(c.layer) as label from (select unnest(solution_components) c from case_studies) where trim(c.layer) <> ''"))
def a06_layer_counts(spark, d):
    layers = cs(spark, d).select(F.explode("solution_components").alias("c")).select(F.trim("c.layer").alias("label"))
    return A.count_values(layers.where("label <> ''"))


@query("a07_integration_counts", counts_sql("select unnest(integration_points) as label from case_studies") + " having label is not null")
def a07_integration_counts(spark, d):
    return A.count_values(cs(spark, d).select(F.explode("integration_points").alias("label")))


@query("a08_components_by_layer", f"""
with i as (select id, unnest(solution_components) c, generate_subscripts(solution_components, 1) pos from {ONE}),
g as (select id, coalesce(nullif(trim(c.layer), ''), 'Uncategorized') layer, string_agg(c.name, ' | ' order by pos) components from i group by 1, 2)
select g.id, g.layer, coalesce(t.ordinal, 2147483647) layer_order, g.components from g left join taxonomy t on t.kind = 'component_layers' and t.value = g.layer
""")
def a08_components_by_layer(spark, d):
    layers = table(spark, d, "taxonomy").where("kind = 'component_layers'")
    return R.components_by_layer(one_each(cs(spark, d)), layers).withColumn("components", F.array_join("components", " | "))


@query("a09_unique_vendors", "select distinct vendor from case_studies where vendor is not null")
def a09_unique_vendors(spark, d):
    return cs(spark, d).where("vendor is not null").select("vendor").distinct()


@query("a10_sample_split", "select count(*) filter (is_sample) samples, count(*) filter (not coalesce(is_sample, false)) real, count(*) records from case_studies")
def a10_sample_split(spark, d):
    return cs(spark, d).agg(F.count_if("is_sample").alias("samples"), F.count_if(~F.coalesce("is_sample", F.lit(False))).alias("real"), F.count("*").alias("records"))


@query("a15_bar_widths", "with v as (select vendor as label, count(*) count from case_studies group by 1) select label, count, count / greatest((select max(count) from v), 1)::double * 100 width from v")
def a15_bar_widths(spark, d):
    return A.bar_widths(cs(spark, d).groupBy(F.col("vendor").alias("label")).count())


ISO = "case when regexp_full_match({0}, '\\d{{4}}(-\\d{{2}}(-\\d{{2}}.*)?)?') then coalesce(try_strptime(substr({0}, 1, 10), '%Y-%m-%d'), try_strptime({0}, '%Y-%m'), try_strptime({0}, '%Y')) end"


@query("a16_latest_date", f"select max(published_date) filter ({ISO.format('published_date')} is not null) latest from case_studies")
def a16_latest_date(spark, d):
    return cs(spark, d).agg(F.max(F.when(T.iso_date(F.col("published_date")).isNotNull(), F.col("published_date"))).alias("latest"))


@query("a17_component_totals", f"select id, coalesce(len(solution_components), 0) components, coalesce(len(list_distinct(list_transform(solution_components, lambda c: coalesce(nullif(trim(c.layer), ''), 'Uncategorized')))), 0) layers from {ONE}")
def a17_component_totals(spark, d):
    layers = F.array_distinct(F.transform("solution_components", lambda c: F.coalesce(F.nullif(F.trim(c["layer"]), F.lit("")), F.lit("Uncategorized"))))
    size = lambda c: F.coalesce(F.when(c.isNotNull(), F.size(c)), F.lit(0))
    return one_each(cs(spark, d)).select("id", size(F.col("solution_components")).alias("components"), size(layers).alias("layers"))


@query("a18_distinct_counts", "select count(distinct vendor) vendors, count(distinct industry) industries, count(distinct customer_name) customers from case_studies")
def a18_distinct_counts(spark, d):
    return cs(spark, d).agg(*[F.count_distinct(c).alias(n) for c, n in (("vendor", "vendors"), ("industry", "industries"), ("customer_name", "customers"))])


@query("rec_scores", f"select id, {CONFIDENCE} confidence, ({MATURITY}) maturity, {LABEL.format('(' + MATURITY + ')')} as label from case_studies")
def rec_scores(spark, d):
    return cs(spark, d).select("id", R.confidence_score().alias("confidence"), R.maturity_score().alias("maturity"), R.maturity_label(R.maturity_score()).alias("label"))


@query("rec_filled_scores", f"select id, coalesce(nullif(confidence_score, 0), {CONFIDENCE}) confidence_score, coalesce(nullif(maturity_score, 0), {MATURITY}) maturity_score from case_studies")
def rec_filled_scores(spark, d):
    return R.fill_scores(cs(spark, d)).select("id", "confidence_score", "maturity_score")


def _tests() -> str:
    out = [f"case when coalesce(trim({f}), '') = '' then 'text:{f}' end" for f in R.TEXT_FIELDS]
    out += [f"case when {f} is null or list_count({f}) < len({f}) then 'list:{f}' end" for f in R.LIST_FIELDS]
    out += ["case when trim(data_flow) = '' then 'optional:data_flow' end", "case when list_count(integration_points) < len(integration_points) then 'optional:integration_points' end"]
    out += ["case when list_count(solution_components) < len(solution_components) then 'component:object' end"]
    out += [f"case when len(list_filter(solution_components, lambda c: c is not null and coalesce(trim(c.{f}), '') = '')) > 0 then 'component:{f}' end" for f in ("name", "role")]
    return "concat_ws(', ', " + ", ".join([*out, "case when len(list_filter(solution_components, lambda c: trim(c.layer) = '')) > 0 then 'component:layer' end"]) + ")"


@query("rec_violations", f"select id, violations from (select id, {_tests()} violations from case_studies) where violations <> ''")
def rec_violations(spark, d):
    return R.normalise(cs(spark, d)).where(F.size("violations") > 0).select("id", F.array_join("violations", ", ").alias("violations"))


@query("rec_merge_samples", f"select id, is_sample, vendor from (select * from {ONE} where not is_sample) union all select id, is_sample, vendor from {ONE} s where is_sample and not exists (select 1 from case_studies r where r.id = s.id and not r.is_sample)")
def rec_merge_samples(spark, d):
    rows = one_each(cs(spark, d)).select("id", "is_sample", "vendor")
    return R.merge_records(rows.where("is_sample"), rows.where("not is_sample"))


@query("rec_upsert", f"select id, vendor, case when coalesce(maturity_score, 0) = 0 then 'incoming' else 'stored' end origin from {ONE}")
def rec_upsert(spark, d):
    stored = one_each(cs(spark, d)).select("id", "vendor", "maturity_score").withColumn("origin", F.lit("stored"))
    incoming = stored.where(F.coalesce("maturity_score", F.lit(0)) == 0).withColumn("origin", F.lit("incoming"))
    return R.upsert(stored, incoming).select("id", "vendor", "origin")


@query("rec_child_rows", " union all ".join(f"select id case_study_id, '{kind}' kind, value from (select id, unnest({f}) as value from {ONE}) where value is not null" for f, kind in R.CHILD_KINDS.items()))
def rec_child_rows(spark, d):
    return R.child_rows(one_each(cs(spark, d)))


@query("rec_restored_lists", "select id, " + ", ".join(f"array_to_string(list_sort(list_filter(coalesce({f}, []), lambda x: x is not null)), '|') {f}" for f in R.CHILD_FIELDS) + f" from {ONE}")
def rec_restored_lists(spark, d):
    rows = one_each(cs(spark, d))
    out = R.restore_lists(rows.select("id"), R.child_rows(rows))
    return out.select("id", *[F.array_join(f, "|").alias(f) for f in R.CHILD_FIELDS])


SLUG = "regexp_replace(regexp_replace(lower(customer_name), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"


@query("rec_duplicate_slugs", f"select coalesce(nullif({SLUG}, ''), 'untitled') slug, count(distinct id) ids from case_studies where customer_name is not null group by 1 having count(distinct id) > 1")
def rec_duplicate_slugs(spark, d):
    """Slugs as they would be made of customer names: those a store would refuse."""
    return R.duplicate_slugs(cs(spark, d).where("customer_name is not null").select("id", T.slugify(F.col("customer_name")).alias("slug")))


@query("rec_merge_counts", "select count(*) filter (is_sample and coalesce(id, '') <> '') samples, count(*) filter (not is_sample and coalesce(id, '') <> '') extracted, count(distinct id) filter (coalesce(id, '') <> '') total from case_studies")
def rec_merge_counts(spark, d):
    rows = cs(spark, d)
    return R.merge_counts(rows.where("is_sample"), rows.where("not is_sample"))


STORED = ", ".join(f"array_to_string(list_sort(list_filter(coalesce({f}, []), lambda x: x is not null)), '|') {f}" for f in R.CHILD_FIELDS)


@query("rec_seed_export", f"select id, slug, coalesce(nullif(confidence_score, 0), {CONFIDENCE}) confidence_score, coalesce(nullif(maturity_score, 0), {MATURITY}) maturity_score, {STORED} from {ONE} where id is not null")
def rec_seed_export(spark, d):
    """Seeded into a new record store in two parts, the second again with all, then exported."""
    from ..sinks.writers import RecordStore

    store = RecordStore(spark, f"{shared_dir(spark)}/records-{uuid.uuid4().hex}")
    store.create()
    rows = one_each(cs(spark, d).where("id is not null"))
    store.seed(rows.where("is_sample"))
    store.seed(rows)
    return store.export().select("id", "slug", "confidence_score", "maturity_score", *[F.array_join(f, "|").alias(f) for f in R.CHILD_FIELDS])


@query("rec_sorted_json", f"select id, vendor, len(coalesce(products_used, [])) products, slug from {ONE}")
def rec_sorted_json(spark, d):
    """Records written as JSON with sorted keys and read again; the order of keys is checked by tests."""
    rows = one_each(cs(spark, d))
    back = rows.select(F.from_json(R.sorted_json(rows), R.RECORD_DDL).alias("r"))
    return back.select("r.id", "r.vendor", F.coalesce(F.size("r.products_used"), F.lit(0)).cast("bigint").alias("products"), "r.slug")


@query("rec_slugify", "select id, case when s = '' then 'untitled' else s end slug from (select id, regexp_replace(regexp_replace(lower(customer_name), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') s from case_studies where customer_name is not null)")
def rec_slugify(spark, d):
    return cs(spark, d).where("customer_name is not null").select("id", T.slugify(F.col("customer_name")).alias("slug"))


@query("rec_table_rows", f"select id, array_to_string(use_case_category[1:2], ', ') use_cases, array_to_string(products_used[1:3], ', ') products from {ONE}")
def rec_table_rows(spark, d):
    join = lambda f, n: F.array_join(F.slice(f, 1, n), ", ")
    return one_each(cs(spark, d)).select("id", join("use_case_category", 2).alias("use_cases"), join("products_used", 3).alias("products"))


@query("rec_categories", f"select id, array_to_string(list_concat(technical_area, use_case_category), '|') categories from {ONE}")
def rec_categories(spark, d):
    empty = F.array().cast("array<string>")
    return one_each(cs(spark, d)).select("id", F.array_join(F.concat(F.coalesce("technical_area", empty), F.coalesce("use_case_category", empty)), "|").alias("categories"))


SEARCH = "lower(concat_ws(' ', customer_name, vendor, industry, solution_summary, array_to_string(products_used, ' '), array_to_string(technical_area, ' '), array_to_string(use_case_category, ' ')))"


@query("search_facets", f"select id from case_studies where contains({SEARCH}, 'the') and vendor = (select max(vendor) from case_studies where len(technical_area) > 0) and list_contains(technical_area, (select technical_area[1] from case_studies where len(technical_area) > 0 order by vendor desc, technical_area[1] limit 1))")
def search_facets(spark, d):
    """The facets are those of the last vendor by alphabet and its first technical area."""
    tagged = cs(spark, d).where("size(technical_area) > 0")
    last = tagged.agg(F.max("vendor").alias("v")).first()["v"]
    area = tagged.where(F.col("vendor") == last).agg(F.min(F.col("technical_area")[0]).alias("a")).first()["a"]
    return A.facet_filter(cs(spark, d), text=" THE", vendor=last, area=area).select("id")


@query("search_text_only", f"select id from case_studies where contains({SEARCH}, 'bank')")
def search_text_only(spark, d):
    return A.facet_filter(cs(spark, d), text="Bank").select("id")


@query("search_industry", f"select id from case_studies where industry = 'Energy' and contains({SEARCH}, '%') = contains({SEARCH}, '%')")
def search_industry(spark, d):
    return A.facet_filter(cs(spark, d), industry="Energy").select("id")


@query("rec_by_slug", "select id, slug from case_studies where slug = (select min(slug) from case_studies) limit 1")
def rec_by_slug(spark, d):
    records = cs(spark, d)
    first = records.agg(F.min("slug").alias("slug"))
    return records.join(F.broadcast(first), "slug", "left_semi").select("id", "slug").limit(1)  # one row


@query("rec_ranked_vendors", "select lpad(row_number() over (order by count(*) desc, vendor)::varchar, 2, '0') rank, vendor, count(*) count from case_studies group by vendor")
def rec_ranked_vendors(spark, d):
    w = Window.orderBy(F.desc("count"), "vendor")  # one row per vendor
    counted = cs(spark, d).groupBy("vendor").count()
    return counted.select(F.lpad(F.row_number().over(w).cast("string"), 2, "0").alias("rank"), "vendor", "count")


@query("rec_dates", f"select id, case when coalesce(published_date, '') = '' then '—' when t is not null then strftime(t, '%b ') || day(t) || strftime(t, ', %Y') else published_date end shown from (select id, published_date, {ISO.format('published_date')} t from case_studies)")
def rec_dates(spark, d):
    return cs(spark, d).select("id", T.date_label(F.col("published_date")).alias("shown"))


@query("rec_tag_drift", "select label, count(*) count from (select unnest(technical_area) as label from case_studies) where label <> '' and label not in (select value from taxonomy where kind = 'technical_areas') group by label")
def rec_tag_drift(spark, d):
    known = table(spark, d, "taxonomy").where("kind = 'technical_areas'").select(F.col("value").alias("label"))
    return A.tag_values(cs(spark, d), "technical_area").join(known, "label", "left_anti").groupBy("label").count()


@query("rec_percent", "with v as (select vendor, avg(maturity_score) / 6 s from case_studies group by vendor) select vendor, floor(s * 100 + 0.5)::int || '%' share from v")
def rec_percent(spark, d):
    return cs(spark, d).groupBy("vendor").agg((F.avg("maturity_score") / 6).alias("s")).select("vendor", T.percent(F.col("s")).alias("share"))
