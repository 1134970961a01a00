"""Exact deduplication with the heavy hitters taken out before the shuffle.

1. Every row gets the SHA-256 of its normalised text; the narrow table (id, digest, row number) is
   written once, so the text is read once and a row's number never changes.
2. A Misra-Gries style frequent-items sketch (Spark's `approx_top_k`, combined map-side) names the
   digests that may be frequent; one more pass over the narrow table counts those exactly and finds
   their winners. At most `tracked` rows are broadcast, whatever the data.
3. Rows of a verified digest are decided where they are, without a shuffle. The others are shuffled
   by digest; no group among them can hold more than about 1/`tracked` of the rows.

Defined results: a null text counts as the empty text; a null id loses against every other id; of
rows that repeat both id and text exactly one stays; an empty table gives an empty result; only the
named columns are read, so any further column may have any name.
"""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import SPACES, rows_that_stay, whole_text
from millrace.session import cut_lineage

TRACKED = 4096


def text_digest(text_col):
    """SHA-256 of the text with every run of white space as one space."""
    return F.sha2(F.regexp_replace(whole_text(text_col), SPACES, " "), 256)


def _digested(docs, id_col, text_col):
    return cut_lineage(docs.select(F.col(id_col).alias("doc_id"), text_digest(text_col).alias("digest"),
                                   F.monotonically_increasing_id().alias("row_no")), "digests")


def frequent_digests(rows: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """At most `tracked` digests, among them every one with more than about 1/`tracked` of the rows."""
    top = F.expr(f"approx_top_k(digest, {tracked // 2}, {tracked})")
    return rows.agg(top.alias("top")).select(F.explode("top.item").alias("digest"))


def decide(rows: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """(doc_id, digest, row_no) with keep_id, group_size and kept; `rows` must be a written table."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_no"))
    size = F.count(F.lit(1))
    named = F.broadcast(frequent_digests(rows, tracked))
    winners = rows.join(named, "digest").groupBy("digest").agg(first.alias("first"), size.alias("group_size"))
    met = rows.join(F.broadcast(winners), "digest", "left")
    frequent = met.filter(F.col("first").isNotNull())
    group = W.partitionBy("digest")
    others = met.filter(F.col("first").isNull()).select("digest", "doc_id", "row_no").withColumns(
        {"first": first.over(group), "group_size": size.over(group)})
    return frequent.unionByName(others).select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
        (F.col("row_no") == F.col("first.row_no")).alias("kept"), "digest", "row_no")


def decisions(docs: DataFrame, id_col="doc_id", text_col="text", tracked: int = TRACKED) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, digest."""
    return decide(_digested(docs, id_col, text_col), tracked).drop("row_no")


def deduplicate(docs: DataFrame, id_col="doc_id", text_col="text", tracked: int = TRACKED) -> DataFrame:
    """The rows of `docs` that stay, with all their columns."""
    decided = decide(_digested(docs, id_col, text_col), tracked)
    return rows_that_stay(docs, id_col, {"digest": text_digest(text_col)}, decided)
