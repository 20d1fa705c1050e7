import pytest

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF001


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def document_rows(documents):
    return documents.collect()


SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size string, kept int, "
          "toxic_score string, key string, node long, order_key int, tag string, n_tokens string")


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows,
    and further columns whose names the operators use themselves."""
    long_text = " ".join(f"word{i % 977} Über<|endoftext|>" for i in range(60_000))
    texts = [(1, "The same text here"), (2, "the SAME text here"), (2, "the SAME text here"),
             (None, None), (None, "only text"), (3, ""), (4, None), (5, " \t\n"), (6, long_text),
             (7, long_text + " end"), (8, "x" * 5000), (9, "ÀÉ 日本語 <|startoftext|> 12"),
             (10, "one"), (11, "one two"), (-4, "THE same text here"), (12, None)]
    rows = [(i, t, None if k % 3 == 0 else "en", None if k % 2 else "s", None,
             "s", 1, "t", "k", 1, 2, None, "n") for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)
