import pytest

SF = "/root/testdata/sf0.001"

#: texts that are odd in one way or another
ODD = [None, "", " ", "\n\t", "a", "A b", "é ß 日本 𠮷", "x" * 3000, " ".join("w%d" % (i % 7) for i in range(5000)), "<|endoftext|>", "</s> [INST]", "a\x00b"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Odd texts, some of them twice, with null and repeated ids and columns whose names clash with results."""
    rows = [(i, t, "en") for i, t in enumerate(ODD)] + [(3, ODD[3], "en"), (None, "null id", None), (None, None, None), (50, ODD[6], None)]
    return spark.createDataFrame([(*r, 0, "x") for r in rows], "doc_id long, text string, lang string, n_tokens int, spans string")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
