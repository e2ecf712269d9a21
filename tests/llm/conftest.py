import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

SF = "/root/testdata/sf0.001"
DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()),
                   StructField("lang", StringType()), StructField("source", StringType()),
                   StructField("n_chars", LongType())])

LONG = " ".join(f"word{i % 997} sea{i}" for i in range(12000))
ODD = [
    (1, None, "en", "a", None), (2, "", None, "a", 0), (3, " \t\n", "en", None, 3), (4, LONG, "en", "b", len(LONG)),
    (5, "the same text twice over", "en", "b", 24), (5, "the same text twice over", "en", "b", 24),
    (6, "the  same text twice\nover", "en", "b", 25), (None, "the same text twice over ", "de", "b", 25),
    (7, "one", "en", "c", 3), (8, "%%% 123 ###", None, "c", 11), (9, LONG + " end", "en", "c", None),
    (None, None, None, None, None),
]


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, ties and repeated rows."""
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clash(odd):
    """Extra columns named like results and inner columns of the operators."""
    out = odd
    for c in ("kept", "keep_id", "group_size", "id", "h", "row", "gid", "size", "copies", "score", "lang_pred", "ids",
              "n_words", "n_chars", "spans", "target", "entities", "uid", "digit", "p", "n_removed", "source_size"):
        if c not in out.columns:
            out = out.selectExpr("*", f"'x' AS `{c}`")
    return out
