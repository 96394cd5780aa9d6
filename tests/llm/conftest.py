import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 97} and{i % 13}" for i in range(9000))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns whose names clash."""
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "src0", 0),
        (3, LONG, "en", "src0", len(LONG)),
        (4, "Plain words, twice.", "en", "src1", 19),
        (5, "Plain words, twice.", "en", "src1", 19),
        (5, "Plain words, twice.", "en", "src1", 19),
        (None, "no id at all", "de", "src2", 12),
        (7, "ÀÉ Straße Σας İ ﬁ 字 \U0001f600 don't 'tis <|endoftext|> x", "xx", "src2", 40),
    ]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, DOCS)
    clash = ("length", "w", "sha", "h", "key", "n", "a", "m", "v", "line", "size", "fp", "at", "start", "items", "shard")
    return df.withColumns({c: F.lit("clash") for c in clash})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
