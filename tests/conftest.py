import json

import pytest
from helpers import book
from pyspark.sql import SparkSession, types as T

from folioforge.schemas import RECORD_DOC
from folioforge.session import configure


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


LISTS = ("author_name", "publisher", "isbn", "subject")
NUMBERS = ("first_publish_year", "number_of_pages_median", "ratings_average", "ratings_count")


@pytest.fixture(scope="session")
def payload():
    """One page of four: two whole documents, one with empty or missing lists, one with nothing but key and title."""
    docs = [book(1), book(2), book(3, *LISTS, author_name=[], isbn=[]), book(4, *LISTS, *NUMBERS)]
    return {"numFound": len(docs), "docs": docs}


@pytest.fixture(scope="session")
def raw_documents():
    """Six documents of two sources: one bare, one without ratings, one key twice under different titles."""
    docs = [
        book(11),
        book(12),
        book(13, *LISTS, *NUMBERS),
        book(11, title="Volume 11 again", publisher=["Elsewhere"]),
        book(14, "ratings_average", "ratings_count"),
        book(15, "subject"),
    ]
    return [{**d, "_source": f"shelf {i % 2}"} for i, d in enumerate(docs)]


@pytest.fixture(scope="session")
def raw_records(spark, raw_documents):
    schema = T.StructType([*RECORD_DOC.fields, T.StructField("_source", T.StringType())])
    return spark.createDataFrame([tuple(d[name] for name in schema.names) for d in raw_documents], schema)


@pytest.fixture
def landed(tmp_path, payload):
    """Three sources with one page each, one page per line."""
    sources = {}
    for name in ("science", "technology", "medicine"):
        folder = tmp_path / "landing" / name
        folder.mkdir(parents=True)
        docs = [{**d, "key": f"{d['key']}-{name}"} for d in payload["docs"]]
        (folder / "page.json").write_text(json.dumps({**payload, "docs": docs}) + "\n")
        sources[name] = str(folder)
    return sources
