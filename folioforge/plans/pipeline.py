"""End-to-end runs: extract, transform, gate, load, verify, log."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from folioforge.operators.aggregates import category_stats
from folioforge.operators.clean import add_batch_time
from folioforge.operators.quality import (
    RECORD_RULES,
    GateRules,
    gate_checks,
    gate_passed,
    load_verify,
    report_totals,
    route_rows,
    validate_report,
)
from folioforge.operators.warehouse import books_3nf, etl_fact, star_schema
from folioforge.plans.catalog import prepare_catalog
from folioforge.plans.records import transform_records
from folioforge.plans.recovery import Throttled, retry
from folioforge.plans.runlog import append_run, read_runs
from folioforge.schemas import ETL_EXECUTION_LOG
from folioforge.session import cut_lineage
from folioforge.sources import files
from folioforge.sources.record_pages import explode_docs, read_pages, require_records, source_status
from folioforge.sources.sinks import (
    BUCKET,
    POINTER,
    full_load,
    incremental_load,
    publish_tables,
    read_buckets,
    read_published,
    read_tables,
    upsert_buckets,
    write_change_audit,
    write_csv,
    write_parquet,
    write_report,
)

# Columns the loaded record fact must have.
REQUIRED = ("ol_key", "title", "author", "avg_rating", "api_source")


class GateFailed(RuntimeError):
    """The quality gate stopped the run before the load."""


class PartialSources(RuntimeError):
    """A full load was asked for, but some sources could not be read; the target keeps what it has."""


def stage_sources(
    spark: SparkSession, sources: Mapping[str, str], multi_line: bool, sleep: Callable[[float], None]
) -> tuple[DataFrame | None, dict[str, str]]:
    """(staged pages, error per failed source). Each source is read, with retries, on its own, so one
    that cannot be found or read does not stop the others.
    """
    pages, errors = None, {}
    for name, path in sources.items():
        try:
            part = retry(
                lambda name=name, path=path: cut_lineage(read_pages(spark, path, name, multi_line)),
                fatal=(Throttled, AnalysisException),
                sleep=sleep,
            )
        except Exception as error:
            errors[name] = str(error).splitlines()[0]
            continue
        pages = part if pages is None else pages.unionByName(part)
    return pages, errors


def run_record_pipeline(
    spark: SparkSession,
    sources: Mapping[str, str],
    root: str,
    strategy: str = "incremental",
    rules: GateRules = RECORD_RULES,
    fail_rules: Mapping[str, Column] | None = None,
    warn_rules: Mapping[str, Column] | None = None,
    buckets: int | None = None,
    run_time: datetime | None = None,
    multi_line: bool = False,
    sleep: Callable[[float], None] = time.sleep,
) -> dict[str, object]:
    """Load nested JSON sources into the record fact below ``root``.

    The gate runs between transform and load. Rows that break a fail rule go to quarantine, rows that
    break a warn rule are recorded in the audit log. An incremental load writes a change audit first.
    It publishes a new version of the whole fact, or, with ``buckets``, rewrites only the key buckets
    the batch touches, which is the choice for a large fact. Exactly one run-log row is written, also on
    failure.
    """
    if strategy not in ("full", "incremental"):
        raise ValueError(f"unknown strategy {strategy}")
    started = time.monotonic()
    run_time = run_time or datetime.now(timezone.utc)
    run_ts, run_id = run_time.isoformat(), uuid.uuid4().hex
    run: dict[str, object] = {
        "run_id": run_id,
        "run_timestamp": run_time,
        "sources_attempted": len(sources),
        "load_strategy": strategy,
        "status": "FAILED",
        "error_msg": "",
    }
    reports = f"{root}/reports/{run_id}"
    try:
        pages, errors = stage_sources(spark, sources, multi_line, sleep)
        if errors and strategy == "full":
            raise PartialSources(f"a full load needs all sources, failed: {', '.join(sorted(errors))}")
        status = require_records(cut_lineage(source_status(spark, pages, list(sources), errors)))
        status.write.mode("overwrite").parquet(f"{reports}/sources")

        # Counts are taken from what was written: counters of a running job may see a task twice.
        write_parquet(explode_docs(pages), f"{root}/raw/run_id={run_id}")
        raw = spark.read.parquet(f"{root}/raw/run_id={run_id}")
        run["records_extracted"] = raw.count()

        fact = cut_lineage(transform_records(raw))
        run["records_after_transform"] = fact.count()

        checks = cut_lineage(gate_checks(fact, rules))
        write_report(checks, f"{reports}/gate", run_ts)
        if not gate_passed(checks):
            raise GateFailed("quality gate failed, see the gate report")

        if fail_rules or warn_rules:
            fact, audit, bad = route_rows(fact, fail_rules or {}, warn_rules or {})
            write_parquet(audit, f"{root}/audit/run_id={run_id}")
            write_parquet(bad, f"{root}/quarantine/run_id={run_id}")
        fact = fact.withColumn("loaded_at", F.lit(run_ts).cast("timestamp"))
        loaded = load_fact(spark, fact, root, strategy, buckets, run_id, run_ts)
        run["records_loaded"] = fact.count()

        write_report(load_verify(fact, loaded, REQUIRED), f"{reports}/verify", run_ts)
        run["status"] = "SUCCESS"
    except Exception as error:
        run["error_msg"] = f"{type(error).__name__}: {error}".splitlines()[0]
    finally:
        run["total_ms"] = int((time.monotonic() - started) * 1000)
        append_run(spark, f"{root}/run_log", run)
    return run


def load_fact(
    spark: SparkSession, fact: DataFrame, root: str, strategy: str, buckets: int | None, run_id: str, run_ts: str
) -> DataFrame:
    """Write the fact by one of the strategies and return the loaded table."""
    target, bucketed, audit = f"{root}/fact", f"{root}/fact_buckets", f"{root}/cdc_audit"
    if buckets is not None:
        if strategy == "full":
            raise ValueError("a bucketed fact is loaded incrementally")
        if files.exists(spark, bucketed):
            write_change_audit(spark, read_buckets(spark, bucketed), fact, "ol_key", audit, run_id, run_ts, ["loaded_at", BUCKET])
        upsert_buckets(spark, fact, bucketed, ["ol_key"], buckets)
        return read_buckets(spark, bucketed)
    if strategy == "full":
        full_load(spark, fact, target)
    else:
        if files.exists(spark, f"{target}/{POINTER}"):
            write_change_audit(spark, read_published(spark, target), fact, "ol_key", audit, run_id, run_ts, ["loaded_at"])
        incremental_load(spark, fact, target, ["ol_key"])
    return read_published(spark, target)


def run_catalog_pipeline(
    spark: SparkSession, raw: DataFrame, root: str, run_ts: str, strategy: str = "full", source: str = "catalog"
) -> dict[str, DataFrame]:
    """The four catalog phases: features and statistics, fact load, warehouse, quality audit.

    The featured catalog is staged once as Parquet and all phases read it. All warehouse tables become visible in one step.
    The run is logged once, after its last phase, as SUCCESS only if all phases came through.
    """
    started = time.monotonic()
    entry: dict[str, object] = {
        "exec_id": uuid.uuid4().hex,
        "source": source,
        "load_strategy": strategy.upper(),
        "status": "FAILED",
        "timestamp": datetime.fromisoformat(run_ts),
    }
    try:
        write_parquet(raw, f"{root}/raw")
        kept = spark.read.parquet(f"{root}/raw")
        entry["extracted_records"] = kept.count()
        write_parquet(prepare_catalog(kept), f"{root}/staged")
        catalog = spark.read.parquet(f"{root}/staged")
        entry["transformed_records"] = catalog.count()
        write_csv(catalog.drop("ingest_seq"), f"{root}/processed", drop=["img_path_raw"])
        write_csv(category_stats(catalog), f"{root}/category_stats")

        fact = add_batch_time(etl_fact(catalog), run_ts, "created_at")
        if strategy == "full":
            full_load(spark, fact, f"{root}/etl_fact")
        else:
            incremental_load(spark, fact, f"{root}/etl_fact", ["isbn"])
        entry["loaded_records"] = entry["transformed_records"]

        publish_tables(spark, {**books_3nf(catalog), **star_schema(catalog)}, f"{root}/warehouse")

        report = cut_lineage(validate_report(catalog))
        write_report(report, f"{root}/audit", run_ts)
        entry["status"] = "SUCCESS"
    finally:
        entry["execution_time_ms"] = int((time.monotonic() - started) * 1000)
        append_run(spark, f"{root}/etl_log", entry, ETL_EXECUTION_LOG)
    return {
        "catalog": catalog,
        "report": report,
        "totals": report_totals(report),
        **read_tables(spark, f"{root}/warehouse"),
        "etl_fact": read_published(spark, f"{root}/etl_fact"),
        "etl_log": read_runs(spark, f"{root}/etl_log", ETL_EXECUTION_LOG),
    }
