"""A stored cube that takes increments: a batch merges its finest cells into the stored ones, facts are not read again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from folioforge.operators.olap import cube_of_state, cube_state, merge_states
from folioforge.sources import files
from folioforge.sources.sinks import POINTER, publish_tables, read_tables

CELLS, BATCHES = "cells", "batches"


def add_to_cube(
    spark: SparkSession,
    batch: DataFrame,
    root: str,
    batch_id: str,
    dims: Sequence[str],
    price: str,
    rating: str,
    distinct: str | None = None,
) -> bool:
    """Merge the facts of one batch into the cube below ``root``; False if this batch was merged before.

    Cells and the list of merged batches are published as one, so a batch that is repeated after a failure counts once.
    """
    state, done = cube_state(batch, dims, price, rating, distinct), spark.range(1).select(F.lit(batch_id).alias("batch_id"))
    if files.exists(spark, f"{root}/{POINTER}"):
        stored = read_tables(spark, root)
        if not stored[BATCHES].where(F.col("batch_id") == batch_id).isEmpty():
            return False
        state = merge_states(stored[CELLS].unionByName(state), dims)
        done = stored[BATCHES].unionByName(done).coalesce(1)
    publish_tables(spark, {CELLS: state, BATCHES: done}, root)
    return True


def read_cube(spark: SparkSession, root: str, dims: Sequence[str], price: str, rating: str) -> DataFrame:
    """All cells of the stored cube, told apart by ``grouping_id``."""
    return cube_of_state(read_tables(spark, root)[CELLS], dims, price, rating)
