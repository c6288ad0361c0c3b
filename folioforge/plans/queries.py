"""Registered queries: each takes (spark, sf_dir), reads whole tables and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from folioforge.functions import text
from folioforge.functions.rounding import exact_sum, stable_round
from folioforge.operators import aggregates, cdc, clean, dedup, features, olap, profile, quality, scaling, warehouse
from folioforge.plans import catalog as catalog_plan, pipeline, records as record_plan, recovery, runlog
from folioforge.plans.runlog import read_runs
from folioforge.schemas import ETL_EXECUTION_LOG, EVENT_MESSAGE
from folioforge.session import broadcast_if_small, configure, cut_lineage, literal_frame, scratch_path
from folioforge.sources import bucketed, catalog_csv, cube_store, images, lookups, membership, record_pages, sinks
from folioforge.sources.tables import (
    RECORD_SOURCES,
    catalog_raw,
    order_snapshots,
    records_raw,
    sales,
    table,
)
from folioforge.streaming import jobs, state

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RUN_TS = "2024-01-31 00:00:00"
LINE_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
ORDER_KEY = ["o_orderkey"]


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


# --- cleaning and features -------------------------------------------------------------------------


@query
def clean_standardise(spark, sf):
    columns = ["ingest_seq", "isbn", "title", "author", "format", "category", "price", "old_price", "rating"]
    return clean.standardise_catalog(catalog_raw(spark, sf)).select(*columns)


@query
def clean_text(spark, sf):
    title = text.clean_text(F.col("name"))
    return catalog_raw(spark, sf).select(
        "ingest_seq",
        text.clean_text(F.col("name"), 8).alias("title_8"),
        text.title_case(title).alias("title_cased"),
        text.display_label(F.concat(F.col("format"), text.title_case(F.col("category")))).alias("camel_label"),
        text.display_label(F.concat(F.col("format"), F.lit("-"), F.col("category"))).alias("dash_label"),
    )


@query
def impute_all(spark, sf):
    filled = clean.impute_catalog(clean.standardise_catalog(catalog_raw(spark, sf)))
    return filled.select(
        "ingest_seq",
        stable_round(F.col("price"), 4).alias("price"),
        "old_price",
        "rating",
        "author",
        "format",
    )


@query
def drop_invalid(spark, sf):
    rows = clean.drop_invalid(clean.standardise_catalog(catalog_raw(spark, sf)), ["price", "isbn"])
    return rows.select("ingest_seq", "isbn", "price")


@query
def path_remap(spark, sf):
    raw = catalog_raw(spark, sf)
    folder, file = text.path_parts(F.col("img_paths"))
    # Every second cover lies on disk under another name, so it is missing.
    stored = F.when(F.col("ingest_seq") % 2 == 0, file).otherwise(F.concat(F.lit("scan-"), file))
    files = raw.select(folder.alias("folder"), stored.alias("file"))
    return images.resolve_covers(raw, files, "img_paths").select(
        "ingest_seq", text.swap_path_prefix(F.col("img_paths")).alias("local_path"), "cover_url"
    )


@query
def price_features(spark, sf):
    return catalog_plan.prepare_catalog(catalog_raw(spark, sf)).select(
        "ingest_seq", "discount_amount", "discount_pct", "price_gbp", "value_score", "is_bestseller"
    )


@query
def text_features(spark, sf):
    rows = features.text_features(table(spark, sf, "documents"), "text")
    return rows.select(
        "doc_id",
        "title_length",
        "word_count",
        stable_round(F.col("chars_per_word"), 4).alias("chars_per_word"),
        "has_subtitle",
        text.equals_ignore_case(F.col("lang"), "EN").alias("is_english"),
    )


@query
def tier_counts(spark, sf):
    return aggregates.tier_counts(catalog_plan.prepare_catalog(catalog_raw(spark, sf)), ["price_tier", "discount_tier"])


@query
def key_validity(spark, sf):
    isbn = F.col("isbn")
    return clean.standardise_catalog(catalog_raw(spark, sf)).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(text.digits_between(isbn, 13, 13)).alias("valid_13"),
        F.count_if(text.digits_between(isbn, 10, 13)).alias("valid_10_13"),
    )


@query
def dedup_first(spark, sf):
    return dedup.dedup_by_key(catalog_raw(spark, sf), "isbn", ["ingest_seq"]).select("isbn", "ingest_seq")


@query
def dedup_keep_blank(spark, sf):
    return dedup.dedup_by_key(catalog_raw(spark, sf), "isbn", ["ingest_seq"], keep_blank=True).select("isbn", "ingest_seq")


@query
def dedup_two_stage(spark, sf):
    lines = table(spark, sf, "lineitem")
    kept = dedup.dedup_two_stage(
        lines,
        ["l_orderkey", "l_linenumber"],
        ["l_orderkey", "l_partkey"],
        F.col("l_partkey") % 10 == 0,
        lines.columns,
    )
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@query
def append_records(spark, sf):
    # The added records are text rows as a form would send them: gaps, bad numbers, a too low old price.
    part = table(spark, sf, "part")
    key = F.col("p_partkey").cast("string")
    added = part.select(
        F.when(F.col("p_partkey") % 40 == 7, F.col("p_name")).alias("title"),
        F.col("p_brand").alias("author"),
        F.lit("Added").alias("category"),
        F.concat(F.lit("new-"), key).alias("isbn"),
        F.when(F.col("p_partkey") % 60 == 7, "bad").otherwise(F.col("p_size").cast("string")).alias("price"),
        F.when(F.col("p_partkey") % 100 == 7, "1.50").when(F.col("p_size") > 40, "99.50").alias("old_price"),
        F.lit("4.8").alias("rating"),
    )
    base = catalog_plan.prepare_catalog(catalog_raw(spark, sf))
    rows = features.append_records(base, added)
    return rows.groupBy("category").agg(
        F.count(F.lit(1)).alias("rows"),
        exact_sum(F.col("price")).alias("sum_price"),
        exact_sum(F.col("old_price")).alias("sum_old_price"),
        exact_sum(F.col("value_score")).alias("sum_value_score"),
        F.count_if(F.col("title") == "Untitled").alias("untitled"),
        F.count_if("is_bestseller").alias("bestsellers"),
    )


@query
def etl_fact(spark, sf):
    fact = warehouse.etl_fact(catalog_plan.prepare_catalog(catalog_raw(spark, sf)))
    return fact.withColumn("price", stable_round(F.col("price"), 4))


@query
def sample_rows(spark, sf):
    base = clean.standardise_catalog(catalog_raw(spark, sf)).where(F.col("img_path_raw").isNotNull() & (F.col("img_path_raw") != ""))
    shown = aggregates.sample_rows(base, "ingest_seq", 12).select(
        F.col("ingest_seq").cast("string").alias("ingest_seq"),
        text.ellipsis(F.col("title"), 7, 10).alias("title"),
        "author",
        "format",
    )
    return aggregates.preview(shown, ["ingest_seq"], 12)


# --- catalog statistics ----------------------------------------------------------------------------


@query
def category_stats(spark, sf):
    return aggregates.category_stats(catalog_plan.prepare_catalog(catalog_raw(spark, sf)))


@query
def top_entities(spark, sf):
    return aggregates.top_entities(catalog_plan.prepare_catalog(catalog_raw(spark, sf)), "author", 10)


@query
def category_insights(spark, sf):
    return aggregates.category_insights(catalog_plan.prepare_catalog(catalog_raw(spark, sf)), 4)


@query
def value_counts(spark, sf):
    return profile.value_counts(
        table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus", "l_quantity", "l_suppkey"], 15
    )


@query
def entity_relative(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_quantity", "l_extendedprice"
    )
    rows = aggregates.entity_relative(lines, "l_suppkey", "l_quantity", "l_returnflag", "l_extendedprice")
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "entity_count",
        stable_round(F.col("entity_avg"), 4).alias("entity_avg"),
        stable_round(F.col("diff_from_group_median"), 3).alias("diff_from_group_median"),
    )


# --- profiles --------------------------------------------------------------------------------------


@query
def null_profile(spark, sf):
    return profile.null_profile(catalog_raw(spark, sf))


@query
def null_totals(spark, sf):
    return profile.null_totals(catalog_raw(spark, sf))


@query
def dup_profile(spark, sf):
    lines = table(spark, sf, "lineitem")
    return dedup.duplicate_counts(lines, {"row": lines.columns, "key": ["l_orderkey", "l_linenumber"]})


@query
def numeric_profile(spark, sf):
    parts = profile.numeric_profile(table(spark, sf, "part"), ["p_size", "p_retailprice"])
    lines = profile.numeric_profile(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"])
    return parts.unionByName(lines)


@query
def summary_points(spark, sf):
    return profile.summary_points(profile.numeric_profile(table(spark, sf, "orders"), ["o_totalprice"]))


@query
def describe_table(spark, sf):
    return profile.describe_exact(profile.numeric_profile(table(spark, sf, "customer"), ["c_acctbal"]))


@query
def distinct_counts(spark, sf):
    return profile.distinct_counts(table(spark, sf, "lineitem"), ["l_returnflag", "l_partkey", "l_suppkey"])


@query
def histogram(spark, sf):
    return profile.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 20)


@query
def histogram_log(spark, sf):
    return profile.histogram_log(table(spark, sf, "lineitem"), "l_extendedprice", 30)


@query
def corr_matrix(spark, sf):
    return profile.corr_matrix(table(spark, sf, "lineitem"), LINE_MEASURES)


@query
def iqr_outliers(spark, sf):
    return profile.iqr_outliers(table(spark, sf, "lineitem"), LINE_MEASURES)


@query
def iqr_cap(spark, sf):
    return profile.iqr_cap_report(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"])


@query
def minmax_scale(spark, sf):
    rows = scaling.minmax_scale(table(spark, sf, "lineitem"), LINE_MEASURES)
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", *[stable_round(F.col(f"scaled_{c}"), 4).alias(f"scaled_{c}") for c in LINE_MEASURES]
    )


@query
def zscore_scale(spark, sf):
    rows = scaling.zscore_scale(table(spark, sf, "lineitem"), LINE_MEASURES)
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", *[stable_round(F.col(f"z_{c}"), 3).alias(f"z_{c}") for c in LINE_MEASURES]
    )


@query
def pca_two_feature(spark, sf):
    variance, _ = scaling.pca(table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice"), ["l_quantity", "l_extendedprice"])
    return variance


@query
def pca_points(spark, sf):
    """Line items on the components of two features."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    _, points = scaling.pca(lines, ["l_quantity", "l_extendedprice"])
    return points


# The catalog features that the component view takes.
PCA_FEATURES = ["price", "rating", "old_price", "discount_pct", "value_score"]


@query
def pca_total(spark, sf):
    """Variance that the first two components of the catalog's features explain together."""
    catalog = catalog_plan.staged_catalog(catalog_raw(spark, sf)).select(*PCA_FEATURES)
    variance, _ = scaling.pca(catalog, PCA_FEATURES)
    return scaling.total_variance(variance)


@query
def pca_embeddings(spark, sf):
    _, points = scaling.pca(table(spark, sf, "embeddings"), "embedding")
    return points.select("vec_id", "label", "pc1", "pc2")


@query
def before_after(spark, sf):
    metrics, columns = catalog_plan.stage_metrics(catalog_raw(spark, sf), {"price": "price", "rating": "book_depository_stars"})
    return profile.before_after(metrics, columns["raw"], columns["featured"], ["price", "rating"])


@query
def stage_funnel(spark, sf):
    metrics, columns = catalog_plan.stage_metrics(catalog_raw(spark, sf))
    counts = {"raw": "rows", "standardised": "rows", "deduplicated": "kept_rows", "featured": "kept_rows"}
    return profile.stage_funnel(metrics, {stage: (count, columns[stage]) for stage, count in counts.items()})


@query
def transform_summary(spark, sf):
    metrics, _ = catalog_plan.stage_metrics(catalog_raw(spark, sf))
    return profile.transform_summary(metrics)


@query
def extract_summary(spark, sf):
    return profile.extract_summary(catalog_raw(spark, sf), "isbn", ["price", "book_depository_stars", "old_price", "author", "isbn"])


# --- nested-source records -------------------------------------------------------------------------


@query
def api_features(spark, sf):
    return record_plan.transform_records(records_raw(spark, sf))


@query
def popularity_topk(spark, sf):
    return aggregates.popularity_topk(record_plan.transform_records(records_raw(spark, sf)), 5)


@query
def source_summary(spark, sf):
    return aggregates.source_summary(record_plan.transform_records(records_raw(spark, sf)))


@query
def quality_counts(spark, sf):
    return aggregates.quality_counts(record_plan.transform_records(records_raw(spark, sf)))


@query
def page_tier_counts(spark, sf):
    return aggregates.tier_counts(
        record_plan.transform_records(records_raw(spark, sf)), ["page_tier", "rating_category", "publish_decade"]
    )


def land_pages(spark: SparkSession, sf: str, root: str, page_size: int = 50) -> dict[str, str]:
    """Write the derived documents as JSON pages of bounded size, one folder per source."""
    docs = records_raw(spark, sf)
    number = F.floor(F.col("ingest_seq") / page_size)
    pages = docs.groupBy("_source", number.alias("page")).agg(
        F.count(F.lit(1)).alias("numFound"),
        F.sort_array(F.collect_list(F.struct("ingest_seq", *[c for c in docs.columns if c not in ("ingest_seq", "_source")]))).alias("docs"),
    )
    # A page never holds more than ``page_size`` documents. Files follow the page number, as a download would write them.
    ordered = pages.repartitionByRange("_source", "page").sortWithinPartitions("_source", "page")
    ordered.select("_source", "numFound", "docs").write.partitionBy("_source").json(root)
    return {s: f"{root}/_source={s}" for s in RECORD_SOURCES}


@query
def record_pages_ingest(spark, sf):
    sources = land_pages(spark, sf, scratch_path(spark, "pages"))
    sources["history"] = sources["science"] + "-absent"
    pages, errors = record_pages.read_sources(spark, sources)
    status = record_pages.source_status(spark, pages, list(sources), errors)
    return record_pages.require_records(status).select(
        "source", "records", F.substring_index("status", ":", 1).alias("status")
    )


@query
def record_pages_docs(spark, sf):
    sources = land_pages(spark, sf, scratch_path(spark, "pages"))
    pages, _ = record_pages.read_sources(spark, sources)
    docs = record_plan.flatten(record_pages.explode_docs(pages))
    return docs.select("ol_key", "api_source", "author", "isbn", "pages", "avg_rating")


@query
def record_pipeline(spark, sf):
    root = scratch_path(spark, "run")
    sources = land_pages(spark, sf, f"{root}/landing")
    pipeline.run_record_pipeline(spark, sources, f"{root}/out", "full")
    pipeline.run_record_pipeline(spark, sources, f"{root}/out", "incremental")
    runs = read_runs(spark, f"{root}/out/run_log").select(
        F.lit("run").alias("part"),
        F.col("load_strategy").alias("name"),
        F.col("status").alias("detail"),
        F.col("records_extracted").cast("double").alias("a"),
        F.col("records_after_transform").cast("double").alias("b"),
        F.col("records_loaded").cast("double").alias("c"),
    )
    fact = sinks.read_published(spark, f"{root}/out/fact").select(
        F.lit("fact").alias("part"), F.col("ol_key").alias("name"), F.col("page_tier").alias("detail"),
        F.col("publish_year").cast("double").alias("a"), F.col("avg_rating").cast("double").alias("b"), F.col("popularity_score").alias("c"),
    )
    return runs.unionByName(fact)


# --- quality ---------------------------------------------------------------------------------------

CATALOG_RULES = quality.GateRules(
    key="isbn", critical=("isbn", "title", "price", "rating"), ranges={"rating": (0.0, 5.0), "price": (1.0, 45.0)}
)


def row_rules() -> dict:
    return {
        "missing_isbn": F.col("isbn").isNotNull(),
        "bad_price": F.col("price") > 0,
        "bad_isbn": F.col("isbn").isNull() | text.digits_between(F.col("isbn"), 13, 13),
    }


@query
def gate_checks(spark, sf):
    return quality.gate_checks(clean.standardise_catalog(catalog_raw(spark, sf)), CATALOG_RULES)


@query
def gate_checks_clean(spark, sf):
    return quality.gate_checks(record_plan.transform_records(records_raw(spark, sf)), quality.RECORD_RULES)


def _report(spark, sf):
    staged = catalog_plan.staged_catalog(catalog_raw(spark, sf))
    return quality.validate_report(
        staged.drop("ingest_seq"),
        null_columns=["isbn", "title", "author", "format", "price", "old_price"],
        numeric=["price", "old_price", "rating", "discount_pct"],
    )


@query
def validate_report(spark, sf):
    return _report(spark, sf)


@query
def validate_totals(spark, sf):
    return quality.report_totals(_report(spark, sf))


@query
def validate_groups(spark, sf):
    return quality.group_status(_report(spark, sf))


@query
def quarantine_split(spark, sf):
    return quality.route_report(clean.standardise_catalog(catalog_raw(spark, sf)), row_rules())


@query
def quarantine_routes(spark, sf):
    rows = clean.standardise_catalog(catalog_raw(spark, sf))
    soft = {"unrated": F.col("rating").isNotNull(), "untitled": F.col("title").isNotNull()}
    routes = quality.route_rows(rows, row_rules(), soft)
    return aggregates.table_status(dict(zip(("warehouse", "audit", "quarantine"), routes)))


@query
def quarantine_reprocess(spark, sf):
    rows = clean.standardise_catalog(catalog_raw(spark, sf)).select("ingest_seq", "isbn", "title", "price")
    _, bad = quality.split_rows(rows, row_rules())
    path = scratch_path(spark, "dead-letters")
    sinks.write_parquet(bad, path)
    fixed, still = quality.reprocess(
        spark.read.parquet(path), rows.schema, lambda d: d.withColumn("price", F.coalesce("price", F.lit(9.99))), row_rules()
    )
    routes = {"fixed": fixed, "quarantine": still}
    named = [df.select(F.lit(route).alias("route"), "ingest_seq", "isbn", "price") for route, df in routes.items()]
    return reduce(DataFrame.unionByName, named)


@query
def load_verify(spark, sf):
    old, new = order_snapshots(spark, sf)
    return quality.load_verify(new, cdc.upsert(old, new, ORDER_KEY), ["o_orderkey", "o_totalprice", "o_comment"])


# --- change data capture and loads -----------------------------------------------------------------


@query
def cdc_summary(spark, sf):
    return cdc.cdc_summary(*order_snapshots(spark, sf), ORDER_KEY)


@query
def cdc_key_sets(spark, sf):
    return cdc.cdc_key_sets(*order_snapshots(spark, sf), ORDER_KEY)


@query
def cdc_samples(spark, sf):
    old, new = [d.select("o_orderkey", "o_orderstatus", "o_totalprice") for d in order_snapshots(spark, sf)]
    new = new.withColumn("o_orderstatus", F.nullif(F.col("o_orderstatus"), F.lit("F")))
    return cdc.cdc_samples(old, new, ORDER_KEY)


@query
def cdc_feed(spark, sf):
    return cdc.cdc_feed(*order_snapshots(spark, sf), ORDER_KEY).select("o_orderkey", "op")


@query
def cdc_column_audit(spark, sf):
    old, new = order_snapshots(spark, sf)
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    return cdc.cdc_column_audit(old.select(*columns), new.select(*columns), ORDER_KEY)


@query
def cdc_apply(spark, sf):
    old, new = order_snapshots(spark, sf)
    applied = cdc.apply_feed(old, cdc.cdc_feed(old, new, ORDER_KEY), ORDER_KEY)
    return applied.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


@query
def upsert_result(spark, sf):
    old, new = order_snapshots(spark, sf)
    return cdc.upsert(old, new, ORDER_KEY).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")


@query
def upsert_metrics(spark, sf):
    return cdc.upsert_metrics(*order_snapshots(spark, sf), ORDER_KEY)


@query
def incremental_load(spark, sf):
    old, new = order_snapshots(spark, sf)
    root = scratch_path(spark, "published")
    sinks.full_load(spark, old, root)
    sinks.incremental_load(spark, new, root, ORDER_KEY)
    return sinks.read_published(spark, root).select("o_orderkey", "o_totalprice")


@query
def bucket_upsert(spark, sf):
    old, new = order_snapshots(spark, sf)
    path = scratch_path(spark, "buckets")
    for batch in (old, new, new):
        sinks.upsert_buckets(spark, batch, path, ORDER_KEY, buckets=8)
    return sinks.read_buckets(spark, path).select("o_orderkey", "o_totalprice")


@query
def bucket_evolution(spark, sf):
    """Another bucket count is asked for, a batch adds a column, the next one lacks it."""
    old, new = order_snapshots(spark, sf)
    path = scratch_path(spark, "evolving")
    columns = ["o_orderkey", "o_totalprice"]
    sinks.upsert_buckets(spark, old.select(*columns), path, ORDER_KEY, buckets=8)
    sinks.upsert_buckets(spark, new.select(*columns, "o_orderstatus"), path, ORDER_KEY, buckets=16)
    sinks.upsert_buckets(spark, old.select(*columns), path, ORDER_KEY, buckets=4)
    return sinks.read_buckets(spark, path).select("o_orderkey", "o_totalprice", "o_orderstatus")


@query
def bucket_atomic(spark, sf):
    """(state, rows, total): after a batch that failed between two buckets, and after the batch was repeated."""
    old, new = order_snapshots(spark, sf)
    path = scratch_path(spark, "atomic")
    sinks.upsert_buckets(spark, old, path, ORDER_KEY, buckets=8)
    last = F.pmod(F.xxhash64(*ORDER_KEY), F.lit(8)) == 7
    torn = new.withColumn("o_comment", F.when(last, F.raise_error(F.lit("no space left"))).cast("string"))
    states = []
    for state, batch in (("failed", torn), ("repeated", new)):
        try:
            sinks.upsert_buckets(spark, batch, path, ORDER_KEY)
        except Exception as error:
            if "no space left" not in str(error):
                raise
        rows = sinks.read_buckets(spark, path)
        rows = rows.agg(F.count(F.lit(1)).alias("rows"), exact_sum(F.col("o_totalprice")).alias("total"))
        states.append(cut_lineage(rows.select(F.lit(state).alias("state"), "rows", "total")))
    return states[0].unionByName(states[1])


@query
def warehouse_publish(spark, sf):
    """The star that readers see after a second run, with other prices, failed at its last table."""
    root = scratch_path(spark, "warehouse")
    catalog = catalog_plan.staged_catalog(catalog_raw(spark, sf))
    sinks.publish_tables(spark, warehouse.star_schema(catalog), root)
    other = warehouse.star_schema(catalog.withColumns({"price": F.col("price") + 1, "category": F.concat("category", F.lit("*"))}))
    last = list(other)[-1]
    other[last] = other[last].withColumn("title", F.raise_error(F.lit("no space left")).cast("string"))
    try:
        sinks.publish_tables(spark, other, root)
    except Exception as error:
        if "no space left" not in str(error):
            raise
    return star_measures(sinks.read_tables(spark, root))


@query
def change_audit(spark, sf):
    old, new = [d.select("o_orderkey", "o_custkey", "o_totalprice") for d in order_snapshots(spark, sf)]
    path = scratch_path(spark, "change-audit")
    for _ in range(2):
        sinks.write_change_audit(spark, old, new, "o_orderkey", path, "r1", RUN_TS)
    return spark.read.parquet(path).select("key_id", "action", "column_changed", "old_value", "new_value")


@query
def partition_overwrite(spark, sf):
    old, new = order_snapshots(spark, sf)
    path = scratch_path(spark, "years")
    year = F.year("o_orderdate")
    sinks.overwrite_partitions(old.withColumn("order_year", year), path, ["order_year"])
    sinks.overwrite_partitions(new.withColumn("order_year", year).where("order_year >= 1999"), path, ["order_year"])
    stored = spark.read.parquet(path)
    return stored.groupBy(F.col("order_year").cast("int").alias("order_year")).agg(
        F.count(F.lit(1)).alias("rows"), exact_sum(F.col("o_totalprice")).alias("total")
    )


@query
def csv_roundtrip(spark, sf):
    path = scratch_path(spark, "csv")
    raw = catalog_raw(spark, sf).withColumns({"currency": F.lit("$"), "image": F.lit("x.jpg")})
    header = ["name", "book_depository_stars", "img_paths", "author", "format", "category", "price", "old_price", "currency", "isbn", "image"]
    sinks.write_csv(raw.select(*header), path)
    good, _ = catalog_csv.split_corrupt(catalog_csv.read_catalog_csv(spark, path))
    return clean.standardise_catalog(good).groupBy("category", "currency").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("isbn").alias("isbns"),
        F.count("title").alias("titles"),
        exact_sum(F.col("price")).alias("sum_price"),
        exact_sum(F.col("old_price")).alias("sum_old_price"),
    )


@query
def zone_evolution(spark, sf):
    root = scratch_path(spark, "zones")
    old, new = order_snapshots(spark, sf)
    sinks.write_zone(old.select("o_orderkey", "o_totalprice"), root, "raw", "r1", "old")
    sinks.write_zone(new.select("o_orderkey", "o_totalprice", "o_orderstatus"), root, "raw", "r2", "new")
    sinks.write_zone(new.select("o_orderkey", "o_totalprice", "o_orderstatus"), root, "raw", "r2", "new")
    return sinks.read_zone(spark, root, "raw").groupBy("run_id", F.col("_ingest_source").alias("source")).agg(
        F.count(F.lit(1)).alias("rows"), F.count("o_orderstatus").alias("with_status")
    )


@query
def checksum_dedup(spark, sf):
    old, new = order_snapshots(spark, sf)
    return dedup.new_by_checksum(new, old, ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]).select(
        "o_orderkey", "o_totalprice"
    )


@query
def checksum_index(spark, sf):
    """(state, rows, total) of a target with indexed checksums: first load, a batch, the same batch again."""
    old, new = order_snapshots(spark, sf)
    path, columns = scratch_path(spark, "indexed"), ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    states = []
    for state, batch in (("first", old), ("batch", new), ("again", new)):
        membership.append_new(spark, batch.select(*columns), path, columns, n_files=16)
        rows = membership.read_indexed(spark, path)
        rows = rows.agg(F.count(F.lit(1)).alias("rows"), exact_sum(F.col("o_totalprice")).alias("total"))
        states.append(cut_lineage(rows.select(F.lit(state).alias("state"), "rows", "total")))
    return reduce(DataFrame.unionByName, states)


@query
def dataset_checksum(spark, sf):
    return recovery.dataset_checksum(
        table(spark, sf, "orders"), ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
    )


@query
def table_status(spark, sf):
    return aggregates.table_status({t: table(spark, sf, t) for t in ("orders", "lineitem", "part")})


@query
def missing_partitions(spark, sf):
    events = table(spark, sf, "events").where(~F.dayofweek("ts").isin(1, 7))  # weekends are missing
    return recovery.missing_partitions(events, F.col("ts"), "2024-01-01", "2024-01-31")


@query
def backfill_days(spark, sf):
    path = scratch_path(spark, "days")
    events = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    sinks.overwrite_partitions(events.where(~F.dayofweek("day").isin(1, 7)), path, ["day"])
    for _ in range(2):
        target = spark.read.parquet(path)
        recovery.backfill(events, target, path, "day", lambda d: d, "2024-01-01", "2024-01-31")
    return spark.read.parquet(path).groupBy(F.col("day").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("rows"))


@query
def backfill_pruned(spark, sf):
    """Days of a curated zone that lacked weekends, after two backfills from a raw zone with a partition per day."""
    raw, curated = scratch_path(spark, "raw-days"), scratch_path(spark, "curated-days")
    events = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    sinks.overwrite_partitions(events, raw, ["day"])
    sinks.overwrite_partitions(events.where(~F.dayofweek("day").isin(1, 7)), curated, ["day"])
    for _ in range(2):
        recovery.backfill_partitions(spark, spark.read.parquet(raw), curated, "day", lambda d: d, "2024-01-01", "2024-01-31")
    return spark.read.parquet(curated).groupBy(F.col("day").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("rows"), exact_sum(F.col("value")).alias("total")
    )


@query
def bucketed_fact(spark, sf):
    """(l_orderkey, time_key, lines, revenue): lines and orders in the same buckets, joined and summed without a shuffle."""
    root, names = scratch_path(spark, "bucketed"), [f"folio_{label}_{uuid.uuid4().hex}" for label in ("orders", "lines")]
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), warehouse.time_key(F.col("o_orderdate")).alias("time_key"))
    orders = bucketed.write_bucketed(orders, names[0], f"{root}/orders", ["l_orderkey"], 8)
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice")
    lines = bucketed.write_bucketed(lines, names[1], f"{root}/lines", ["l_orderkey"], 8)
    return lines.join(orders.hint("merge"), "l_orderkey").groupBy("l_orderkey", "time_key").agg(
        F.count(F.lit(1)).alias("lines"), exact_sum(F.col("l_extendedprice")).alias("revenue")
    )


@query
def bucketed_diff(spark, sf):
    """(o_orderkey, op): the snapshot comparison over two bucketed tables, without a shuffle."""
    root, sides = scratch_path(spark, "bucketed"), []
    for label, df in zip(("old", "new"), order_snapshots(spark, sf)):
        name = f"folio_{label}_{uuid.uuid4().hex}"
        sides.append(bucketed.write_bucketed(df, name, f"{root}/{label}", ORDER_KEY, 8))
    return cdc.snapshot_diff(*sides, ORDER_KEY, missing_keys=False).select("o_orderkey", "op")


@query
def source_status(spark, sf):
    configured = ["view", "click", "signup", "purchase", "error", "refund"]
    return record_pages.status_by_column(spark, table(spark, sf, "events"), "event_type", configured)


@query
def events_json_props(spark, sf):
    parsed = jobs.parse(table(spark, sf, "events"), "props", "k bigint")
    return parsed.groupBy(F.col("message.k").alias("k")).agg(
        F.count(F.lit(1)).alias("rows"), stable_round(F.avg("value"), 4).alias("avg_value")
    )


# --- warehouse -------------------------------------------------------------------------------------


@query
def dim_category(spark, sf):
    named = table(spark, sf, "part").withColumn("category", F.concat("p_type", F.lit("-"), "p_brand"))
    return warehouse.dim_category(named)


@query
def dim_first_seen(spark, sf):
    return warehouse.dimension(
        catalog_raw(spark, sf), "author", "author_key", "author_name", first_seen="ingest_seq"
    )


@query
def dim_publisher(spark, sf):
    return warehouse.dim_publisher(table(spark, sf, "part"), "p_type")


@query
def dim_time(spark, sf):
    return warehouse.dim_time(table(spark, sf, "orders"), "o_orderdate")


@query
def dim_upsert(spark, sf):
    part = table(spark, sf, "part")
    existing = warehouse.dimension(part.where("p_brand like '%1%'"), "p_brand", "brand_key", "brand_name")
    return warehouse.dim_upsert(existing, part.select(F.col("p_brand").alias("brand_name")), "brand_key", "brand_name")


@query
def fact_sales(spark, sf):
    part = table(spark, sf, "part")
    categories = warehouse.dimension(part, "p_type", "category_key", "category_name")
    brands = warehouse.dimension(part.where("p_brand <> 'Brand#7'"), "p_brand", "publisher_key", "publisher_name")
    # Keys are attached to the small side first, so the fact is joined once per natural entity.
    keyed = warehouse.lookup_key(part, categories, "p_type", "category_name", "category_key")
    keyed = warehouse.lookup_key(keyed, brands, "p_brand", "publisher_name", "publisher_key")
    keyed = keyed.select(F.col("p_partkey").alias("l_partkey"), "category_key", "publisher_key")
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), warehouse.time_key(F.col("o_orderdate")).alias("time_key")
    )
    lines = table(spark, sf, "lineitem").join(keyed, "l_partkey").join(orders, "l_orderkey")
    return lines.groupBy("l_orderkey", "l_linenumber", "category_key", "publisher_key", "time_key").agg(
        F.count(F.lit(1)).alias("rows"),
        exact_sum(F.col("l_quantity")).alias("quantity"),
        exact_sum(F.col("l_extendedprice")).alias("price"),
    )


@query
def nf3_books(spark, sf):
    return warehouse.books_3nf(catalog_plan.staged_catalog(catalog_raw(spark, sf)))["books"].withColumn(
        "price", stable_round(F.col("price"), 4)
    )


def star_measures(tables) -> DataFrame:
    dims = {
        "category_key": (tables["dim_category"], "category_key"),
        "format_key": (tables["dim_format"], "format_key"),
        "publisher_key": (tables["dim_publisher"], "publisher_key"),
    }
    joined = olap.star(tables["fact_book_sales"], dims)
    return joined.groupBy("category_name", "format_name", "publisher_name", "region").agg(
        *olap.measures("price", "rating"), F.sum("is_bestseller").alias("bestsellers")
    )


@query
def star_catalog(spark, sf):
    return star_measures(warehouse.star_schema(catalog_plan.staged_catalog(catalog_raw(spark, sf))))


@query
def star_complete(spark, sf):
    """(check, rows): the fact, what is left of it after joining all dimensions, and its orphans."""
    tables = warehouse.star_schema(catalog_plan.staged_catalog(catalog_raw(spark, sf)))
    fact = cut_lineage(tables["fact_book_sales"])
    keys = {"dim_category": "category_key", "dim_format": "format_key", "dim_publisher": "publisher_key", "dim_time": "time_key"}
    joined = olap.star(fact, {key: (tables[name], key) for name, key in keys.items()})
    orphans = warehouse.fk_integrity(fact, {name: (tables[name], key, key) for name, key in keys.items()})
    orphans = orphans.agg(F.lit("orphans").alias("table_name"), F.sum("orphan_rows").alias("rows"))
    return aggregates.table_status({"fact": fact, "joined": joined}).unionByName(orphans)


@query
def gate_two_ratings(spark, sf):
    """A gate with two rating columns of the same bounds; one of them is broken in places."""
    rows = clean.standardise_catalog(catalog_raw(spark, sf))
    rows = rows.withColumn("avg_rating", F.lit(4.0)).withColumn("rating", F.when(F.col("ingest_seq") % 50 == 0, 99.0).otherwise(3.0))
    rules = quality.GateRules("ingest_seq", ("ingest_seq",), {"rating": (0.0, 5.0), "avg_rating": (0.0, 5.0)})
    return quality.gate_checks(rows, rules).where("check LIKE '%range%'")


@query
def snowflake_rollup(spark, sf):
    suppliers = (
        table(spark, sf, "supplier")
        .join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("s_suppkey").alias("l_suppkey"), "r_name")
    )
    regions, region_dim = warehouse.snowflake(suppliers, "r_name", "region_key", "region_name")
    categories, genre_dim = warehouse.snowflake(
        table(spark, sf, "part").select(F.concat("p_type", F.lit("-"), "p_brand").alias("category"), F.col("p_type").alias("genre")).distinct(),
        "genre",
        "genre_key",
        "genre_name",
    )
    lines = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_extendedprice")
    parts = table(spark, sf, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.concat("p_type", F.lit("-"), "p_brand").alias("category")
    )
    joined = (
        lines.join(broadcast_if_small(regions), "l_suppkey")
        .join(region_dim, "region_key")
        .join(parts, "l_partkey")
        .join(broadcast_if_small(categories), "category")
        .join(genre_dim, "genre_key")
    )
    return joined.groupBy("region_name", "genre_name").agg(
        F.count(F.lit(1)).alias("rows"), exact_sum(F.col("l_extendedprice")).alias("revenue")
    )


@query
def fk_integrity(spark, sf):
    part = table(spark, sf, "part")
    return warehouse.fk_integrity(
        table(spark, sf, "lineitem"),
        {
            "part": (part, "l_partkey", "p_partkey"),
            "supplier": (table(spark, sf, "supplier"), "l_suppkey", "s_suppkey"),
            "orders": (table(spark, sf, "orders"), "l_orderkey", "o_orderkey"),
            "reduced_part": (part.where("p_size <= 45"), "l_partkey", "p_partkey"),
        },
    )


# --- OLAP ------------------------------------------------------------------------------------------

PRICE, RATING = "l_extendedprice", "l_quantity"


@query
def olap_slice(spark, sf):
    return olap.slice_(sales(spark, sf, "part"), {"p_type": "PROMO"}, ["p_type", "l_returnflag"], PRICE, RATING)


@query
def olap_dice(spark, sf):
    return olap.dice(
        sales(spark, sf),
        {"p_type": ["PROMO", "ECONOMY", "SMALL"]},
        {PRICE: (10000.0, 50000.0)},
        ["p_type", "l_returnflag", "r_name"],
        PRICE,
        RATING,
    )


@query
def olap_rollup(spark, sf):
    fact = sales(spark, sf, "part").withColumn("flag", F.col("l_quantity") >= 45)
    return olap.rollup_category(fact, "p_type", PRICE, RATING, "flag", top=15)


@query
def olap_rollup_total(spark, sf):
    return olap.rollup_total(sales(spark, sf, "part"), ["p_type", "p_brand"], PRICE, RATING)


@query
def olap_drilldown(spark, sf):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return olap.drilldown(
        sales(spark, sf),
        {"p_type": "PROMO"},
        [*keys, "p_brand", "r_name", "l_returnflag", PRICE, RATING],
        [F.desc(PRICE), F.asc(RATING), *keys],
        12,
    )


CUBE_DIMS = ["p_type", "l_returnflag", "r_name"]


@query
def cube_full(spark, sf):
    return olap.cube_full(sales(spark, sf), CUBE_DIMS, PRICE, RATING)


@query
def cube_slice_all(spark, sf):
    return olap.cube_cells(table(spark, sf, "lineitem"), CUBE_DIMS, {"l_returnflag": "R"}, PRICE, RATING)


@query
def cube_topn(spark, sf):
    return olap.cube_topn(sales(spark, sf, "part"), ["p_brand"], ["l_returnflag", "l_linestatus"], 6, 4, PRICE, RATING)


@query
def cube_parquet(spark, sf):
    path = scratch_path(spark, "cube")
    cube = olap.cube_full(sales(spark, sf), CUBE_DIMS, PRICE, RATING)
    sinks.write_parquet(cube, path, ["grouping_id"])
    return spark.read.parquet(path).where("grouping_id = 5").select("l_returnflag", "row_count", "sum_l_extendedprice")


@query
def cube_merge(spark, sf):
    """The cube of two batches of facts, merged cell by cell; the second batch comes twice and counts once."""
    facts, root = sales(spark, sf), scratch_path(spark, "cube-store")
    for batch, part in (("a", facts.where("l_shipdate < DATE '1997-01-01'")), *[("b", facts.where("l_shipdate >= DATE '1997-01-01'"))] * 2):
        cube_store.add_to_cube(spark, part, root, batch, CUBE_DIMS, PRICE, RATING)
    return cube_store.read_cube(spark, root, CUBE_DIMS, PRICE, RATING)


@query
def olap_custom_sql(spark, sf):
    olap.register_views(spark, {"wh_sales": sales(spark, sf)})
    return olap.run_sql(
        spark,
        """SELECT p_brand, count(*) AS row_count, max(l_extendedprice) AS top_price
           FROM wh_sales WHERE r_name = :region AND l_quantity >= :low GROUP BY p_brand""",
        {"region": "ASIA", "low": 30},
    )


@query
def fx_convert(spark, sf):
    rates = literal_frame(spark, [("GBP", 0.81), ("JPY", 150.0)], lookups.RATE_SCHEMA)
    part = table(spark, sf, "part").select(F.col("p_retailprice").alias("price"))
    row = lookups.add_converted(part, rates).agg(
        exact_sum(F.col("price_in_gbp")).alias("GBP"), exact_sum(F.col("price_in_eur")).alias("EUR")
    )
    return profile.stack(
        row.crossJoin(lookups.rate_row(rates, ["GBP", "EUR"])),
        "currency",
        {c: {"rate": F.col(f"_rate_{c}"), "converted": F.col(c)} for c in ("GBP", "EUR")},
    )


@query
def enrich_prefix_lookup(spark, sf):
    known = [p for p, _, _ in lookups.PUBLISHERS]
    prefixes = F.array(*[F.lit(p) for p in [*known, "97899999"]])
    slot = (F.col("p_partkey") % 12).cast("int")
    isbn = F.concat(F.coalesce(F.get(prefixes, slot), F.lit("00000000")), F.lpad(F.col("p_partkey").cast("string"), 5, "0"))
    lookup = lookups.publishers(spark).union(literal_frame(spark, [("97899999", None, None)], lookups.PUBLISHER_SCHEMA))
    return (
        lookups.enrich_publisher(table(spark, sf, "part").withColumn("isbn", isbn), lookup)
        .groupBy("publisher", "publisher_region")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


# --- streaming -------------------------------------------------------------------------------------


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.read_messages(spark, sf, EVENT_MESSAGE, glob="events.parquet")


def run_to_parquet(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    root = scratch_path(spark, label)
    jobs.drain(jobs.write_append(df, f"{root}/out", f"{root}/checkpoint"))
    return spark.read.schema(df.schema).parquet(f"{root}/out")


@query
def stream_ingest(spark, sf):
    parsed = jobs.parse(event_stream(spark, sf), "props", "k bigint")
    out = parsed.select("event_id", "user_id", "event_type", "value", F.col("message.k").alias("k"))
    return run_to_parquet(spark, out, "ingest")


@query
def stream_dedup(spark, sf):
    twice = event_stream(spark, sf).unionByName(event_stream(spark, sf))
    out = jobs.dedup(jobs.event_time(twice), ["event_id"]).select("event_id", "value")
    return run_to_parquet(spark, out, "dedup").agg(
        F.count(F.lit(1)).alias("rows"), exact_sum(F.col("value")).alias("total")
    )


def _windows(spark, sf, **options):
    counted = jobs.throughput(jobs.event_time(event_stream(spark, sf)), ["event_type"], delay="1 day", **options)
    root = scratch_path(spark, "windows")
    jobs.drain(jobs.upsert_windows(counted, f"{root}/out", f"{root}/checkpoint", ["event_type"], buckets=8))
    rows = sinks.read_buckets(spark, f"{root}/out").select("window_start", "event_type", "n")
    return rows.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


@query
def stream_throughput(spark, sf):
    return _windows(spark, sf, size="1 hour")


@query
def stream_throughput_sliding(spark, sf):
    return _windows(spark, sf, size="2 hours", slide="1 hour")


@query
def stream_operations(spark, sf):
    changes = jobs.operations(event_stream(spark, sf), "event_type", ["signup", "purchase"], ["event_id", "value"])
    return run_to_parquet(spark, changes, "operations").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("rows"), exact_sum(F.col("value")).alias("total")
    )


@query
def stream_last_value(spark, sf):
    root = scratch_path(spark, "last")
    writer = jobs.upsert_stream(
        event_stream(spark, sf), f"{root}/out", f"{root}/checkpoint", ["user_id"], ["ts", "event_id"], buckets=8
    )
    jobs.drain(writer)
    return sinks.read_buckets(spark, f"{root}/out").select("user_id", "event_id", "event_type", "value")


@query
def stream_dead_letters(spark, sf):
    root = scratch_path(spark, "dead")
    body = F.to_json(F.struct("event_id", "user_id", "value"))
    damaged = F.when(F.col("event_id") % 13 == 0, F.substring(body, 1, 12)).otherwise(body)
    messages = event_stream(spark, sf).select(damaged.alias("body"))
    parsed = jobs.parse(messages, "body", "event_id bigint, user_id bigint, value double").select(
        "body", F.col("message").isNotNull().alias("ok"), "message.*"
    )
    writer = jobs.upsert_stream(
        parsed, f"{root}/out", f"{root}/checkpoint", ["event_id"],
        good=F.col("ok"), dead_letters=f"{root}/dead", buckets=8, newest_wins=False,
    )
    jobs.drain(writer)
    good = sinks.read_buckets(spark, f"{root}/out").select(F.lit("loaded").alias("route"), "event_id", "user_id", "value")
    bad = spark.read.parquet(f"{root}/dead").select(F.lit("dead_letter").alias("route"), *good.columns[1:])
    return good.unionByName(bad)


def land_events(spark: SparkSession, sf: str, path: str, where: str = "true", n_files: int = 4) -> None:
    """Events as files whose rows and order have nothing to do with time."""
    dealt = table(spark, sf, "events").where(where).repartition(n_files, F.xxhash64("event_id"))
    dealt.sortWithinPartitions(F.xxhash64("event_id")).write.mode("append").parquet(path)


@query
def stream_state_last(spark, sf):
    """The last event of every user from state inside the stream, over micro-batches that are out of order."""
    root, order = scratch_path(spark, "state"), ["ts", "event_id"]
    land_events(spark, sf, f"{root}/in")
    events = jobs.event_time(jobs.read_messages(spark, f"{root}/in", EVENT_MESSAGE, files_per_batch=1))
    changes = state.last_rows(events, ["user_id"], order, ["event_type", "value"], delay="60 days")
    jobs.drain(state.write_changes(changes, f"{root}/out", f"{root}/checkpoint"))
    return state.read_last(spark, f"{root}/out", ["user_id"], order).select("user_id", "event_id", "event_type", "value")


@query
def stream_resume(spark, sf):
    """(event_id, value, arrival): a stream that fails in its second batch and goes on after more files came in."""
    root = scratch_path(spark, "resume")
    paths = f"{root}/in", f"{root}/out", f"{root}/checkpoint"

    def fail(batch_id: int) -> None:
        if batch_id == 1:
            raise RuntimeError("stopped in batch 1")

    first, rest = "ts < TIMESTAMP_NTZ '2024-01-16'", "ts >= TIMESTAMP_NTZ '2024-01-16'"
    for where, after in ((first, fail), (rest, None)):
        land_events(spark, sf, paths[0], where)
        events = jobs.read_messages(spark, paths[0], EVENT_MESSAGE, files_per_batch=1).select("event_id", "value", F.expr(first).alias("early"))
        try:
            jobs.drain(jobs.write_batches(events, *paths[1:], after=after))
        except Exception as error:
            if "stopped in batch 1" not in str(error):
                raise
    return spark.read.parquet(paths[1]).drop("batch_id")


# --- run log ---------------------------------------------------------------------------------------


def event_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Events seen as runs: one in seven failed, duration and size follow from the number."""
    number = F.col("event_id")
    return table(spark, sf, "events").select(
        number.cast("string").alias("run_id"),
        F.col("ts").alias("run_timestamp"),
        F.when(number % 7 == 0, "FAILED").otherwise("SUCCESS").alias("status"),
        (number % 5000).alias("total_ms"),
        (number % 97).alias("records_loaded"),
    )


@query
def run_metrics(spark, sf):
    return runlog.run_metrics(event_runs(spark, sf))


@query
def latest_runs(spark, sf):
    return runlog.latest_runs(event_runs(spark, sf), 12).select("run_id", "status", "total_ms")


@query
def run_freshness(spark, sf):
    return runlog.freshness(table(spark, sf, "events"), RUN_TS, "ts")


# --- whole catalog run -----------------------------------------------------------------------------


@query
def catalog_pipeline(spark, sf):
    """(table_name, member, rows, total): what the run left in the fact, the normal form, the star and the log."""
    out = pipeline.run_catalog_pipeline(spark, catalog_raw(spark, sf), scratch_path(spark, "catalog"), RUN_TS)
    count, price = F.count(F.lit(1)).alias("rows"), exact_sum(F.col("price")).alias("total")
    books = out["books"].join(out["categories"], "category_id").groupBy(F.col("category_name").alias("member")).agg(count, price)
    sales = star_measures(out).select(
        F.concat_ws("/", "category_name", "format_name").alias("member"), F.col("row_count").alias("rows"), F.col("avg_price").alias("total")
    )
    parts = {
        "etl_fact": out["etl_fact"].groupBy(F.col("price_tier").alias("member")).agg(count, price),
        "books": books,
        "star": sales,
        "etl_log": out["etl_log"].groupBy(F.col("status").alias("member")).agg(count, F.sum("loaded_records").cast("double").alias("total")),
    }
    named = [df.select(F.lit(name).alias("table_name"), "member", "rows", "total") for name, df in parts.items()]
    return reduce(DataFrame.unionByName, named)


@query
def catalog_report(spark, sf):
    """The report that the catalog run writes: all columns, duplicates told apart without the helper column."""
    return pipeline.run_catalog_pipeline(spark, catalog_raw(spark, sf), scratch_path(spark, "catalog-report"), RUN_TS)["report"]


@query
def failed_run_log(spark, sf):
    """The log after a run whose input misses the price column, followed by a good one."""
    root = scratch_path(spark, "failing")
    raw = catalog_raw(spark, sf)
    try:
        pipeline.run_catalog_pipeline(spark, raw.drop("price"), root, RUN_TS)
    except AnalysisException:
        pass
    pipeline.run_catalog_pipeline(spark, raw, root, RUN_TS)
    runs = read_runs(spark, f"{root}/etl_log", ETL_EXECUTION_LOG)
    return runs.select("status", "load_strategy", "extracted_records", "loaded_records")
