"""Row fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# How the text of a row is joined, and what stands for null (no escaped field gives it).
FIELD_SEPARATOR = "|"
NULL_MARK = "\\N"


def row_text(columns: Sequence[str]) -> Column:
    """The row as one text. Fields are escaped, so different rows never give the same text."""
    fields = [
        F.coalesce(
            F.replace(F.replace(F.col(c).cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|")),
            F.lit(NULL_MARK),
        )
        for c in columns
    ]
    return F.concat_ws(FIELD_SEPARATOR, *fields)


def row_sha256(columns: Sequence[str]) -> Column:
    return F.sha2(row_text(columns), 256)
