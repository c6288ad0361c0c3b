"""Catalog plan: raw rows to the featured catalog, and the warehouse built on it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from folioforge.functions.text import trimmed
from folioforge.operators import profile
from folioforge.operators.clean import impute_catalog, standardise_catalog
from folioforge.operators.dedup import dedup_by_key
from folioforge.operators.features import catalog_features
from folioforge.operators.profile import missing_cells
from folioforge.session import cut_lineage

SEQUENCE = "ingest_seq"


def deduplicated(raw: DataFrame) -> DataFrame:
    """Standardise, impute (median and mode see the duplicates), keep the first row per key."""
    return dedup_by_key(impute_catalog(standardise_catalog(raw)), "isbn", [SEQUENCE])


def prepare_catalog(raw: DataFrame) -> DataFrame:
    """The featured catalog as a lazy plan."""
    return catalog_features(deduplicated(raw))


def staged_catalog(raw: DataFrame) -> DataFrame:
    """The featured catalog, written once: for reports that pass over it several times."""
    return cut_lineage(prepare_catalog(raw))


def stage_metrics(raw: DataFrame, watched: Mapping[str, str] = {}) -> tuple[DataFrame, dict[str, int]]:
    """(metrics, columns per stage) of raw, standardised, imputed, deduplicated and featured rows, from one pass.

    The raw file is read once: every row carries its raw gaps into the staged rows, where median and mode are taken. The
    features of all rows are computed beside them, and only the kept row of a key counts for the later stages.
    ``watched`` maps a processed column to its raw name.
    """
    marks = {
        "_raw_key": F.col("isbn"),
        "_raw_nulls": missing_cells(raw.columns),
        **{f"_raw_{c}": F.col(name).isNull() for c, name in watched.items()},
    }
    # Marks are set on raw rows, before columns are renamed, and ride along.
    standardised = standardise_catalog(raw)
    names = standardised.columns
    rows = cut_lineage(standardise_catalog(raw.withColumns(marks)).withColumn("_gaps", missing_cells(names)))
    filled = impute_catalog(rows)
    featured = catalog_features(filled)
    own = [c for c in featured.columns if c not in marks and c != "_gaps"]
    metrics = profile.stage_metrics(
        featured,
        {"raw_keys": F.col("_raw_key"), "kept_rows": F.coalesce(trimmed(F.col("isbn")), F.lit(""))},
        F.col(SEQUENCE),
        {
            "raw_nulls": F.col("_raw_nulls"),
            "gaps": F.col("_gaps"),
            "gaps_left": missing_cells(names),
            **{f"raw_{c}": F.col(f"_raw_{c}") for c in watched},
        },
        {"nulls": missing_cells(own), "flagged": F.col("is_bestseller"), **{c: F.col(c).isNull() for c in watched}},
    )
    columns = {"raw": len(raw.columns), "standardised": len(names), "deduplicated": len(names), "featured": len(own)}
    return metrics, columns
