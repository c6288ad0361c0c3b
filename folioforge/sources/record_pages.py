"""Nested JSON pages: documents in an array, landed as one folder or file per source."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from folioforge.schemas import RECORD_PAGE
from folioforge.session import literal_frame
from folioforge.sources.catalog_csv import EmptySource

CORRUPT = "_corrupt_record"
PAGE = T.StructType([*RECORD_PAGE.fields, T.StructField(CORRUPT, T.StringType())])
SOURCE = "_source"


def read_pages(spark: SparkSession, path: str, source: str, multi_line: bool = False) -> DataFrame:
    """Pages of one source, tagged: one page per line, which can be split.

    ``multi_line=True`` is for pretty-printed pages: a page begins with a brace at the start of a line, and a file, which is
    read as one text, may hold any number of them.
    """
    if multi_line:
        texts = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("_file"))
        cut = texts.select("_file", F.posexplode(F.split("value", "\\n(?=\\{)")).alias("_page", "_text"))
        parsed = F.from_json("_text", PAGE, {"columnNameOfCorruptRecord": CORRUPT})
        return cut.where(F.trim("_text") != "").select(
            parsed.alias("_parsed"), "_file", F.col("_page").cast("bigint").alias("_page")
        ).select("_parsed.*", F.lit(source).alias(SOURCE), "_file", F.lit(0).cast("bigint").alias("_split"), "_page")
    pages = spark.read.schema(PAGE).option("columnNameOfCorruptRecord", CORRUPT)
    return pages.json(path).select(
        "*",
        F.lit(source).alias(SOURCE),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_page"),
    )


def read_sources(
    spark: SparkSession, sources: Mapping[str, str], multi_line: bool = False
) -> tuple[DataFrame | None, dict[str, str]]:
    """(pages of every readable source, error per unreadable source).

    A source that cannot be read does not stop the others.
    """
    pages, errors = None, {}
    for name, path in sources.items():
        try:
            part = read_pages(spark, path, name, multi_line)
        except AnalysisException as error:
            errors[name] = str(error).splitlines()[0]
            continue
        pages = part if pages is None else pages.unionByName(part)
    return pages, errors


def explode_docs(pages: DataFrame) -> DataFrame:
    """One row per document, ordered by ``ingest_seq`` (source, file, page, position)."""
    return pages.select(
        F.posexplode("docs").alias("_pos", "_doc"), SOURCE, "_file", "_split", "_page"
    ).select(
        "_doc.*",
        SOURCE,
        F.struct(SOURCE, "_file", "_split", "_page", "_pos").alias("ingest_seq"),
    )


def source_status(
    spark: SparkSession, pages: DataFrame | None, configured: list[str], errors: Mapping[str, str] | None = None
) -> DataFrame:
    """(source, records, reported, status) for every configured source, in one pass over the pages.

    No readable page, or only corrupt ones, is a failure.
    """
    errors = dict(errors or {})
    wanted = literal_frame(spark, [(s, errors.get(s)) for s in configured], "source string, error string")
    if pages is None:
        pages = spark.createDataFrame([], T.StructType([*PAGE.fields, T.StructField(SOURCE, T.StringType())]))
    counted = pages.groupBy(F.col(SOURCE).alias("source")).agg(
        F.sum(F.coalesce(F.size("docs"), F.lit(0))).alias("records"),
        F.max("numFound").alias("reported"),
        F.count_if(F.col(CORRUPT).isNotNull()).alias("corrupt"),
    )
    return _status(wanted, counted)


def _status(wanted: DataFrame, counted: DataFrame) -> DataFrame:
    joined = F.broadcast(wanted).join(counted, "source", "left")  # the configured list is short
    reason = F.coalesce("error", F.when(F.col("corrupt") > 0, "malformed page"), F.lit("no records"))
    ok = F.col("error").isNull() & (F.coalesce("corrupt", F.lit(0)) == 0) & (F.coalesce("records", F.lit(0)) > 0)
    return joined.select(
        "source",
        F.coalesce("records", F.lit(0)).cast("bigint").alias("records"),
        "reported",
        F.when(ok, "SUCCESS").otherwise(F.concat(F.lit("FAILED: "), reason)).alias("status"),
    )


def status_by_column(spark: SparkSession, df: DataFrame, source_column: str, configured: list[str]) -> DataFrame:
    """(source, records, status) for flat rows that carry their source name."""
    wanted = literal_frame(spark, [(s, None) for s in configured], "source string, error string")
    counted = df.groupBy(F.col(source_column).alias("source")).agg(
        F.count(F.lit(1)).alias("records"), F.lit(None).cast("bigint").alias("reported"), F.lit(0).alias("corrupt")
    )
    return _status(wanted, counted).select(
        "source", "records", F.when(F.col("status") == "SUCCESS", "SUCCESS").otherwise("FAILED").alias("status")
    )


def require_records(status: DataFrame) -> DataFrame:
    """Stop when no source gave a record; the short status table is the only thing read."""
    if status.where("records > 0").isEmpty():
        raise EmptySource("no records extracted from any source")
    return status
