import random

import pytest

from gridloom.llm import common  # noqa: F401

#: Extra columns whose names the operators might use themselves.
CLASHING = ["score", "key", "fp", "component_id", "block", "epoch", "n_lines", "n_deleted", "ids", "spans", "words", "name", "first", "at", "rank", "media"]


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text, lang, source, n_chars) with nulls, empty and very long texts, ties and repeated rows."""
    r = random.Random(7)
    vocab = ["the", "of", "Hello", "wörld", "123", "a.b@c.de", "x" * 30, "it's", "###", "Ünï", "日本"]
    long = " ".join(r.choice(vocab) for _ in range(30_000))
    rows = [(1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n\t ", None, None, None), (4, long, "en", "b", len(long)), (5, "one two three", "en", "a", 13), (5, "one two three", "en", "a", 13), (5, "another text of id five", "en", "b", 23), (None, "no id here at all", "en", "b", 17), (None, None, None, None, None)]
    rows += [(i, "\n".join(" ".join(r.choice(vocab) for _ in range(r.randint(0, 12))) for _ in range(r.randint(1, 5))), "en", r.choice("abc"), 1) for i in range(10, 60)]
    rows += [(i, "a passage that is the same in many documents of this table, all of it\nand a second line", "en", "a", 90) for i in range(60, 80)]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(odd_rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit("clash") for c in CLASHING}).cache()


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
