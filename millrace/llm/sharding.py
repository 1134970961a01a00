"""Proportional stratified interleaving into shards of equal row counts.

Within each source the rows are shuffled by a seeded digest and ranked; row r (from 0) of a source
of n rows gets the fractional rank (2r + 1) / 2n. All rows in the order of that number hold every
source at its overall share in any stretch, so cutting the order into equal stretches gives shards
that all match the mixture. Both ranks are exact and found from counts of small parts
(`common.in_order`, `common.ranked`): no source or id, however large, is sorted in one task.

Defined results: a null source is a source of its own; a null text has size 1 and the CRC of the
empty text; rows with the same id are ordered by their text's CRC and size, so only rows equal in
all of these can trade places; an empty table gives no rows; other columns are carried untouched.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import in_order, key_of, ranked, shuffle_partitions, whole_text
from millrace.session import cut_lineage

PARTS_A_PARTITION = 4
PART_ROWS_LOG2 = 16


def assign_shards(docs: DataFrame, shards: int, seed: int = 0, id_col="doc_id", text_col="text",
                  stratum_col="source") -> DataFrame:
    """(doc_id, stratum, size, text_crc32, shard, slot) for every row of `docs`."""
    if shards < 1:
        raise ValueError("shards must be positive")
    text = whole_text(text_col)
    identity = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    rows = cut_lineage(docs.select(
        F.col(id_col).alias("doc_id"), key_of(stratum_col).alias("stratum"),
        F.md5(F.concat(F.lit(f"{seed}:"), identity)).alias("digest"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"), F.monotonically_increasing_id().alias("row_no")), "shard-rows")
    parts = PARTS_A_PARTITION * shuffle_partitions(docs)
    tie = ["digest", "doc_id", "text_crc32", "size"]
    # dealt by ranges of the whole order: rows with one id, or none, share a digest and still spread
    placed = in_order(rows, ["stratum"], [*tie, "row_no"], "shard-order")
    share = (2 * F.col("place") + 1) / (2 * F.col("n_total"))
    spread = cut_lineage(placed.select("doc_id", "stratum", "digest", "size", "text_crc32", share.alias("share")),
                         "shard-shares")
    spread = spread.withColumn("part", F.least(F.floor(F.col("share") * parts), F.lit(parts - 1)))
    whole = ranked(spread, [], "part", ["share", "stratum", *tie])
    shard = F.expr(f"cast((place * {shards}) div n_total as int)")
    first = F.expr(f"(shard * n_total + {shards - 1}) div {shards}")
    return whole.withColumn("shard", shard).withColumn("slot", F.col("place") - first).select(
        "doc_id", "stratum", "size", "text_crc32", "shard", "slot")


def write_shards(docs: DataFrame, assigned: DataFrame, path: str, id_col="doc_id", text_col="text",
                 stratum_col="source") -> None:
    """Write every row once under `path`/shard=k, each file in slot order; `assigned` is that of these `docs`.

    Rows meet their slots by all that the assignment tells apart and, among rows equal in that, which can trade
    places, by their number. Ids may be null or repeated. A row without a slot, or the other way round, is an
    error. A shard is written by as many tasks as its slots need, not by one.
    """
    text = whole_text(text_col)
    numbered = F.monotonically_increasing_id().alias("row_no")
    rows = cut_lineage(docs.select(
        F.struct("*").alias("row"), key_of(id_col).alias("id_key"), key_of(stratum_col).alias("stratum"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"), numbered), "shard-docs")
    slots = cut_lineage(assigned.select(
        key_of("doc_id").alias("id_key"), "stratum", "size", "text_crc32", "shard", "slot", numbered), "shard-slots")
    keys = ["id_key", "stratum", "size", "text_crc32"]

    def placed(some):
        return ranked(some.withColumn("part", F.shiftright("row_no", PART_ROWS_LOG2)), keys, "part", ["row_no"])

    own = placed(rows.select(*keys, "row_no")).select(*keys, "place", "row_no")
    met = own.join(placed(slots).select(*keys, "place", "shard", "slot"), [*keys, "place"], "full")
    differ = F.raise_error(F.lit("docs are not the rows that were assigned")).cast("int")
    where = cut_lineage(met.select("row_no", "slot", F.when(
        F.col("row_no").isNotNull() & F.col("shard").isNotNull(), F.col("shard")).otherwise(differ).alias("shard")),
        "shard-places")
    joined = rows.select("row_no", "row").join(where, "row_no")
    ordered = joined.repartitionByRange(shuffle_partitions(docs), "shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.select("row", "slot", "shard").write.partitionBy("shard").parquet(path)
