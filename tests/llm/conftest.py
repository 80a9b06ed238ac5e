import pytest
from pyspark.sql import functions as F


@pytest.fixture
def docs(spark):
    """Rows that every operator must take: nulls, empty and long texts, ties, repeats, clashing and further columns."""
    prose = " ".join(f"word{i % 97} other{i % 89}" for i in range(400))
    near = prose.replace("word5 ", "changed ", 1)
    rows = [
        (1, prose, "en", "a", 10), (2, near, "en", "a", 10), (3, prose, "en", None, None), (3, prose, "en", None, None),
        (4, None, None, None, None), (5, "", "en", "b", 0), (6, " \n\t ", "en", "b", 4), (None, prose + " end", "en", "b", 1),
        (7, "One two", "en", "b", 7), (8, "one TWO", "en", "b", 7), (9, "x" * 50_000 + " " + "é" * 20_000, "fr", "b", 70_001),
        (10, "\n".join(["the same line again"] * 30), "en", "b", 600), (11, "Ünïcödé\x0bwörds\x1fhere </s>[INST] <|endoftext|>", "de", "b", 3),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return frame.withColumns({"rank": F.lit("clash"), "kept": F.lit("clash"), "n_words": F.lit("clash"), "bucket": F.lit(1)})


@pytest.fixture
def no_docs(docs):
    return docs.where("false")
