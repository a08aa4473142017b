import pytest

from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def tiny(spark):
    """The smallest documents with awkward rows beside them: nulls, blanks, a long text, repeats, clashing columns."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = spark.createDataFrame(
        [(9001, None, "en", "src0", None), (9002, "", None, None, 0), (9003, "   \n\t ", "en", None, 7),
         (9004, "word " * 40000, "en", "src0", None), (9005, "same text here, twice over, with enough words to count", "en", "src1", 5),
         (9005, "same text here, twice over, with enough words to count", "en", "src1", 5), (None, "no id on this row at all", "en", "src1", 5),
         (9006, "café 🙂 naïve word\x0b\x0cÀ", "fr", "src2", 9)],
        docs.schema)
    return docs.unionByName(odd).withColumns({"n_words": F.lit("clash"), "kept": F.lit(7), "size": F.lit("x")})


@pytest.fixture(scope="session")
def none_left(tiny):
    return tiny.limit(0)
