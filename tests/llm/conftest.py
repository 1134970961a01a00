import re

import pytest
from pyspark.sql import types as T

LONG = "long words of a text " * 20_000
CLASHING = ("digest", "row_no", "row", "size", "key", "shard", "fp", "kept", "first", "stratum", "score", "path", "blob")
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType()),
                       *[T.StructField(name, T.StringType()) for name in CLASHING]])


def frame(spark, rows):
    """Documents from (doc_id, text, source), with further columns whose names clash with inner ones."""
    return spark.createDataFrame([(i, text, "en", source, None if text is None else len(text), *["x"] * len(CLASHING))
                                  for i, text, source in rows], SCHEMA)


ODD = [(1, "One two  three\tfour five", "a"), (2, "One two three four five", "a"), (7, None, None), (3, "", "b"),
       (4, " \n ", "b"), (5, LONG, "a"), (6, LONG, "c"), (None, "One two three four five", "a"), (None, None, None),
       (8, "single", "c"), (8, "single", "c"), (9, "übel ñandú 漢字 'tis \U0001f600 end", "c"), (2, "One two three four five", "a"),
       (10, "x" * 50_000, "b"), (11, " lead\n\n  and trail ", None)]


@pytest.fixture(scope="session")
def odd(spark):
    return frame(spark, ODD).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])


@pytest.fixture(scope="session")
def make(spark):
    return lambda rows: frame(spark, rows)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


@pytest.fixture(scope="session")
def words():
    return words_of


@pytest.fixture(scope="session")
def lowered():
    return lower_ascii
