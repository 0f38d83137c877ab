import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and white-space texts, repeated rows, a very long text, and columns named like outputs."""
    long = " ".join(f"word{k % 997} of{k % 31}" for k in range(60_000))
    data = [
        (1, "a b c d e f", "s1", 7), (2, None, "s1", None), (3, "", None, 7), (None, "a b c d e f", None, 7), (None, None, None, None),
        (4, " \t\n ", "s2", 7), (5, long, "s2", 7), (6, "è un’altra cosa, è così", "s1", 7), (6, "è un’altra cosa, è così", "s1", 7), (7, "a  b c d\ne f ", "s1", 7),
    ]
    clash = "score kept spans fingerprint shard slot uid target digest best n fp low g whole threshold h key row own root node label y"
    names = "doc_id long, text string, source string, size int, " + ", ".join(f"{c} int" for c in clash.split())
    return spark.createDataFrame([r + (0,) * 24 for r in data], names)
