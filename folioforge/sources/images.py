"""Cover images: inventory of files, decoding, grey-level attributes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from folioforge.functions.text import path_parts, swap_path_prefix

# Accepted file types and the grey weights (ITU-R 601) of blue, green and red.
EXTENSIONS = (".jpg", ".jpeg", ".png")
GREY_WEIGHTS_BGR = (0.114, 0.587, 0.299)


def image_files(spark: SparkSession, root: str, extensions: Sequence[str] = EXTENSIONS) -> DataFrame:
    """(folder, file, length) of the image files below ``root``; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    parts = F.split("path", "/")
    named = files.select(
        F.element_at(parts, -2).alias("folder"), F.element_at(parts, -1).alias("file"), "length", "path"
    )
    return named.where(F.lower("file").rlike("(" + "|".join(e.replace(".", r"\.") for e in extensions) + ")$"))


def inventory(files: DataFrame) -> DataFrame:
    """(folder, images) per category folder, and a total under a null folder."""
    return files.rollup("folder").agg(F.count(F.lit(1)).alias("images"))


def resolve_covers(catalog: DataFrame, files: DataFrame, path_column: str = "img_path_raw") -> DataFrame:
    """Add cover_url where the referenced file is in the inventory; null otherwise."""
    folder, file = path_parts(F.col(path_column))
    known = files.select(F.col("folder").alias("_folder"), F.col("file").alias("_file")).distinct()
    joined = catalog.withColumns({"_f": folder, "_n": file}).join(
        known, (F.col("_f") == F.col("_folder")) & (F.col("_n") == F.col("_file")), "left"
    )
    url = F.when(F.col("_file").isNotNull(), F.concat(F.lit("/covers/"), F.col("_f"), F.lit("/"), F.col("_n")))
    return joined.withColumn("cover_url", url).drop("_f", "_n", "_folder", "_file")


def decode(spark: SparkSession, root: str) -> DataFrame:
    """Decoded images; files that cannot be decoded are left out."""
    loaded = (
        spark.read.format("image").option("dropInvalid", True).option("recursiveFileLookup", True).load(root)
    )
    return loaded.select("image.origin", "image.width", "image.height", "image.nChannels", "image.data")


def _grey_stats(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        means, deviations = [], []
        for data, channels in zip(batch["data"], batch["nChannels"]):
            pixels = np.frombuffer(data, dtype=np.uint8).reshape(-1, channels).astype(np.float64)
            grey = pixels[:, 0] if channels == 1 else np.round(pixels[:, :3] @ np.array(GREY_WEIGHTS_BGR))
            means.append(float(grey.mean()))
            deviations.append(float(grey.std()))
        yield pd.DataFrame(
            {
                "origin": batch["origin"],
                "img_width": batch["width"].astype("int32"),
                "img_height": batch["height"].astype("int32"),
                "img_aspect_ratio": batch["width"] / batch["height"],
                "img_brightness": means,
                "img_contrast": deviations,
            }
        )


def attributes(decoded: DataFrame) -> DataFrame:
    """Width, height, aspect ratio, mean grey level and its deviation per image."""
    schema = (
        "origin string, img_width int, img_height int, img_aspect_ratio double, "
        "img_brightness double, img_contrast double"
    )
    return decoded.mapInPandas(_grey_stats, schema)


def attach_attributes(catalog: DataFrame, attrs: DataFrame, path_column: str = "img_paths") -> tuple[DataFrame, DataFrame]:
    """(rows whose image was decoded, with its attributes; one row with the count of all others).

    The local path is the referenced one with its folder renamed.
    """
    folder, file = path_parts(swap_path_prefix(F.col(path_column)))
    parts = F.split("origin", "/")
    keyed = attrs.withColumns({"_folder": F.element_at(parts, -2), "_file": F.element_at(parts, -1)})
    rows = catalog.withColumns({"_f": folder, "_n": file})
    on = (F.col("_f") == F.col("_folder")) & (F.col("_n") == F.col("_file"))
    valid = rows.join(keyed, on).drop("_f", "_n", "_folder", "_file")
    rejected = rows.join(keyed, on, "left_anti").agg(F.count(F.lit(1)).alias("missing_or_unreadable"))
    return valid, rejected
