"""Text expressions: cleaning, counting, truncating, tokens and n-grams."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_text(text: Column) -> Column:
    """Lower-case; every run of anything but a-z and 0-9 becomes one space; no space at the ends.

    The same as replacing other characters by spaces and then joining runs of
    spaces, in one pass over the text.
    """
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def word_count(cleaned: Column) -> Column:
    return F.when(cleaned == "", F.lit(0)).otherwise(F.size(F.split(cleaned, " ")))


def truncate(text: Column, limit: int = 60) -> Column:
    """The first `limit` characters followed by three dots, or the whole text if it fits."""
    return F.when(F.length(text) > limit, F.concat(F.left(text, F.lit(limit)), F.lit("..."))).otherwise(text)


def tokens(cleaned: Column, stop_words=()) -> Column:
    """Words of two or more characters, without the stop words, in order."""
    words = F.regexp_extract_all(cleaned, F.lit(r"\b\w\w+\b"), F.lit(0))
    stops = list(stop_words)
    return F.filter(words, lambda w: ~w.isin(stops)) if stops else words


def ngrams(words: Column, low: int = 1, high: int = 2) -> Column:
    """All runs of `low` to `high` consecutive words, joined by a space."""
    runs, kept = words, []
    for size in range(1, high + 1):
        if size > 1:
            # the runs one word shorter, each followed by the next word
            n = F.greatest(F.size(words) - (size - 1), F.lit(0))
            runs = F.zip_with(F.slice(runs, 1, n), F.slice(words, size, n), lambda run, word: F.concat_ws(" ", run, word))
        if size >= low:
            kept.append(runs)
    return F.concat(*kept)
