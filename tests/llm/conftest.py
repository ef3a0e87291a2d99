import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows,
    and extra columns whose names clash with outputs and helper columns."""
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    rows = [
        (1, base, "en", "src0", len(base)),
        (1, base, "en", "src0", len(base)),  # repeated row
        (2, base, "en", "src1", len(base)),  # exact copy
        (3, base.upper(), None, "src1", len(base)),
        (4, "", "en", "src0", 0),
        (5, None, "de", None, None),
        (6, " \t\n ", "fr", "src2", 4),
        (7, "one", "fr", "src2", 3),
        (8, "word " * 30000, "en", "src0", 150000),
        (9, "x" * 20000, "es", "src3", 20000),
        (10, 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" é  done.', "en", "src3", 60),
        (None, "no id here", "en", "src0", 10),
    ]
    df = spark.createDataFrame(rows, DOC_SCHEMA)
    return df.selectExpr("*", "1 AS size", "'x' AS fingerprint", "2 AS _row", "'y' AS shard", "3 AS _group", "4 AS sequence_id")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def local_docs(documents):
    return {r["doc_id"]: r for r in documents.collect()}
