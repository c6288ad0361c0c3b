"""Quality gates, graded validation reports, row routing and load verification."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from folioforge.functions.checksum import row_sha256
from folioforge.functions.rounding import stable_round
from folioforge.operators.profile import iqr_bounds, numeric_columns, outside, stack

# Graded limits (below the first PASS, below the second WARN, else FAIL), pass rate.
NULL_GRADES = (5, 20)
OUTLIER_GRADES = (5, 15)
IDENTIFIER_GRADES = (1, 10)
GATE_PASS_RATE = 90.0
HELPER_COLUMNS = ("image", "img_path_raw", "cover_url", "ingest_seq")
RATING_COLUMNS = ("avg_rating", "rating")


@dataclass(frozen=True)
class GateRules:
    """Declarative limits of a gate. ``ranges`` maps a column to its inclusive bounds."""

    key: str
    critical: Sequence[str]
    ranges: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    min_rows: int = 1
    max_null_share: float = 0.05


# The limits used for nested-source records.
RECORD_RULES = GateRules(
    key="ol_key",
    critical=("ol_key", "title", "author", "publish_year", "avg_rating"),
    ranges={"avg_rating": (0.0, 5.0), "publish_year": (1000, 2030)},
)


def gate_checks(df: DataFrame, rules: GateRules) -> DataFrame:
    """(check, status, failing): one row per rule, all rules in one aggregate.

    Counting starts per key, so uniqueness needs no second pass; nulls count as one key value. With
    no rows only the row-count check is reported.
    """
    critical = [c for c in rules.critical if c in df.columns]
    ranges = {c: r for c, r in rules.ranges.items() if c in df.columns}
    keyed = rules.key in df.columns
    nulls = sum((F.col(c).isNull().cast("bigint") for c in critical), F.lit(0).cast("bigint"))

    def out_of_range(c: str, low: float, high: float) -> Column:
        return F.count_if((F.col(c) < low) | (F.col(c) > high))

    counts = [F.count(F.lit(1)).alias("rows"), F.sum(nulls).alias("nulls")]
    counts += [out_of_range(c, low, high).alias(f"_r_{c}") for c, (low, high) in ranges.items()]
    per_key = df.groupBy(F.col(rules.key)).agg(*counts) if keyed else df.agg(*counts)
    row = per_key.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("nulls"), F.lit(0)).alias("nulls"),
        F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("dups"),
        *[F.coalesce(F.sum(f"_r_{c}"), F.lit(0)).alias(f"_r_{c}") for c in ranges],
    )

    def status(ok: Column) -> Column:
        return F.when(ok, "PASS").otherwise("FAIL")

    share = F.try_divide(F.col("nulls").cast("double"), F.col("rows") * max(1, len(critical)))
    enough = F.col("rows") >= rules.min_rows
    checks = {
        f"Row count >= {rules.min_rows}": (enough, F.when(enough, F.lit(0).cast("bigint")).otherwise(F.lit(1).cast("bigint"))),
        f"Critical columns null rate <= {rules.max_null_share:g}": (
            share <= rules.max_null_share,
            F.col("nulls"),
        ),
    }
    for c, (low, high) in ranges.items():
        alone = c in RATING_COLUMNS and sum(r in ranges for r in RATING_COLUMNS) == 1
        label = "Rating range" if alone else f"{c} range"
        checks[f"{label} [{low:g} - {high:g}]"] = (F.col(f"_r_{c}") == 0, F.col(f"_r_{c}"))
    if keyed:
        checks[f"Primary key ({rules.key}) uniqueness"] = (F.col("dups") == 0, F.col("dups"))
    report = stack(
        row, "check", {name: {"status": status(ok), "failing": bad, "_rows": F.col("rows")} for name, (ok, bad) in checks.items()}
    )
    first = f"Row count >= {rules.min_rows}"
    return report.where((F.col("_rows") > 0) | (F.col("check") == first)).drop("_rows")


def gate_passed(checks: DataFrame) -> bool:
    """True when no check failed (reads the short check table)."""
    return checks.where("status = 'FAIL'").isEmpty()


def graded(pct: Column, limits: tuple[float, float]) -> Column:
    return F.when(pct < limits[0], "PASS").when(pct < limits[1], "WARN").otherwise("FAIL")


def validate_report(
    df: DataFrame,
    null_columns: Sequence[str] | None = None,
    numeric: Sequence[str] | None = None,
    valid_flag: str | None = "isbn13_valid",
    approx: bool = False,
) -> DataFrame:
    """(check, column_name, status, value): graded nulls, types, outliers, duplicates, identifiers.

    By default all columns are checked for nulls and all numeric ones for outliers. Helper columns are no part of the
    report, so they do not hide duplicate rows either. Everything but duplicate rows is one pass.
    """
    df = df.drop(*HELPER_COLUMNS)
    null_columns = list(null_columns or df.columns)
    numeric = list(numeric if numeric is not None else numeric_columns(df))
    flagged = valid_flag is not None and valid_flag in df.columns

    fenced = df.crossJoin(F.broadcast(iqr_bounds(df, numeric, approx))) if numeric else df
    row = fenced.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"_null{i}") for i, c in enumerate(null_columns)],
        *[F.count_if(outside(c)).alias(f"_out{i}") for i, c in enumerate(numeric)],
        *[F.count(c).alias(f"_num{i}") for i, c in enumerate(numeric)],
        *([F.count_if(~F.col(valid_flag)).alias("_invalid")] if flagged else []),
    )
    # Rows are told apart by a 256-bit fingerprint, so the shuffle does not carry them.
    duplicates = df.groupBy(row_sha256(df.columns).alias("_row")).agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("_dups")
    )
    row = row.crossJoin(F.broadcast(duplicates))

    def share(count: str, total: str) -> Column:
        return stable_round(F.col(count) * 100.0 / F.greatest(F.col(total), F.lit(1)), 2)

    checks = []

    def add(check: str, column: str, status: Column, value: Column) -> None:
        checks.append(
            F.struct(
                F.lit(check).alias("check"),
                F.lit(column).alias("column_name"),
                status.alias("status"),
                value.cast("double").alias("value"),
            )
        )

    for i, c in enumerate(null_columns):
        add("Null Check", c, graded(share(f"_null{i}", "_rows"), NULL_GRADES), share(f"_null{i}", "_rows"))
    for c in numeric:
        add("Schema Validation", c, F.lit("PASS"), F.lit(0.0))
    for i, c in enumerate(numeric):
        add("Outlier Detection", c, graded(share(f"_out{i}", f"_num{i}"), OUTLIER_GRADES), share(f"_out{i}", f"_num{i}"))
    add("Duplicate Check", "ALL", F.when(F.col("_dups") == 0, "PASS").otherwise("WARN"), F.col("_dups"))
    if flagged:
        add("ISBN-13 Validation", "isbn", graded(share("_invalid", "_rows"), IDENTIFIER_GRADES), share("_invalid", "_rows"))
    return row.select(F.inline(F.array(*checks)))


def report_totals(report: DataFrame) -> DataFrame:
    """One row: total, passed, warned, failed, pass rate and overall gate of a report."""
    row = report.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == "PASS").alias("passed"),
        F.count_if(F.col("status") == "WARN").alias("warned"),
        F.count_if(F.col("status") == "FAIL").alias("failed"),
    )
    rate = stable_round(F.coalesce(F.try_divide(F.col("passed") * 100.0, F.col("total")), F.lit(0.0)), 1)
    return row.withColumn("pass_rate", rate).withColumn(
        "gate", F.when(F.col("pass_rate") >= GATE_PASS_RATE, "PASS").otherwise("FAIL")
    )


def group_status(report: DataFrame) -> DataFrame:
    """(check, passed, total) per check group."""
    return report.groupBy("check").agg(
        F.count_if(F.col("status") == "PASS").alias("passed"), F.count(F.lit(1)).alias("total")
    )


def with_reasons(df: DataFrame, rules: Mapping[str, Column], name: str = "reasons") -> DataFrame:
    """Attach the names of the broken rules; a rule that evaluates to null counts as broken."""
    broken = [F.when(F.coalesce(rule, F.lit(False)), F.lit(None)).otherwise(F.lit(label)) for label, rule in rules.items()]
    return df.withColumn(name, F.array_compact(F.array(*broken)))


def split_rows(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(curated, quarantine): good rows as they were, bad rows with ``reasons`` and JSON ``payload``."""
    tagged = with_reasons(df, rules)
    good = tagged.where(F.size("reasons") == 0).drop("reasons")
    bad = tagged.where(F.size("reasons") > 0).withColumn("payload", F.to_json(F.struct(*df.columns)))
    return good, bad


def route_rows(
    df: DataFrame, fail_rules: Mapping[str, Column], warn_rules: Mapping[str, Column]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(warehouse, audit, quarantine): a broken fail rule keeps a row out of the warehouse; a broken
    warn rule lets it in and leaves a record with ``warnings`` and ``payload`` in the audit log.
    """
    tagged = with_reasons(with_reasons(df, fail_rules), warn_rules, "warnings")
    payload = F.to_json(F.struct(*df.columns)).alias("payload")
    passed = tagged.where(F.size("reasons") == 0)
    return (
        passed.select(*df.columns),
        passed.where(F.size("warnings") > 0).select("warnings", payload),
        tagged.where(F.size("reasons") > 0).select(*df.columns, "reasons", payload),
    )


def route_report(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(route, reason, rows): a bad row appears once per reason."""
    tagged = with_reasons(df, rules).select(F.explode_outer("reasons").alias("reason"))
    return (
        tagged.groupBy("reason")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(
            F.when(F.col("reason").isNull(), "curated").otherwise("quarantine").alias("route"),
            F.coalesce("reason", F.lit("ok")).alias("reason"),
            "rows",
        )
    )


def reprocess(quarantine: DataFrame, schema, fix, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Read quarantined payloads again, apply ``fix`` to the rows and route them once more."""
    rows = quarantine.select(F.from_json("payload", schema).alias("r")).select("r.*")
    return split_rows(fix(rows), rules)


def load_verify(source: DataFrame, target: DataFrame, required: Sequence[str]) -> DataFrame:
    """(check, status, detail): target rows not fewer than source rows, required columns present."""
    counts = source.agg(F.count(F.lit(1)).alias("src")).crossJoin(
        F.broadcast(target.agg(F.count(F.lit(1)).alias("tgt")))  # one row each
    )
    missing = sorted(set(required) - set(target.columns))
    return stack(
        counts,
        "check",
        {
            "row_count": {
                "status": F.when(F.col("tgt") >= F.col("src"), "PASS").otherwise("FAIL"),
                "detail": F.concat(F.col("tgt").cast("string"), F.lit("/"), F.col("src").cast("string")),
            },
            "required_columns": {
                "status": F.lit("FAIL" if missing else "PASS"),
                "detail": F.lit(",".join(missing)),
            },
        },
    )
