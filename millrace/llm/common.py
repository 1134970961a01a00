"""What several of these operators share: null handling, hashes, exact ranks without a one-task sort."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.session import cut_lineage

SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark, folder, name) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole_text(column) -> Column:
    """The text, a null one as the empty text."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def lower_ascii(column) -> Column:
    """Lower case of A-Z alone, every other character as it is."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(column) -> Column:
    return F.regexp_count(whole_text(column), F.lit(WORD)).cast("bigint")


def key_of(column) -> Column:
    """A text key that keeps null apart from every value, so that plain joins and groups include it."""
    value = F.col(column).cast("string")
    return F.when(value.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), value))


def row_fraction(digest: Column) -> Column:
    """The first 32 bits of a hex digest as a number in [0, 1)."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


FEWEST_BITS, MOST_BITS = 1 << 16, 1 << 26


def id_filter(ids: DataFrame, n: int):
    """A function that keeps, or leaves out, the rows of a frame whose id (`id_key`) may be among the `n` ids.

    A bitmap of 16 bits an id, at most `MOST_BITS` (a million words of 64 bits, sent to every task): beyond 4 million
    ids more rows are taken for one of them than are, never fewer.
    """
    bits = min(MOST_BITS, max(FEWEST_BITS, 1 << max(0, 16 * n - 1).bit_length()))
    spot = F.pmod(F.xxhash64("id_key"), F.lit(bits))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(spot, F.lit(64)).cast("int"))
    words = ids.select(F.expr(f"pmod(xxhash64(id_key), {bits}L) div 64").alias("_word"), bit.alias("_bit")).groupBy(
        "_word").agg(F.bit_or("_bit").alias("_bits"))
    words = cut_lineage(words, "id-bits")

    def may_be(rows: DataFrame, wanted: bool) -> DataFrame:
        met = rows.withColumns({"_word": F.expr(f"pmod(xxhash64(id_key), {bits}L) div 64"), "_bit": bit}).join(
            F.broadcast(words), "_word", "left")
        hit = F.coalesce(F.col("_bits").bitwiseAND(F.col("_bit")), F.lit(0)) != 0
        return met.filter(hit if wanted else ~hit).select(*rows.columns)

    return may_be


def rows_that_stay(docs: DataFrame, id_col, marks: dict, decided: DataFrame) -> DataFrame:
    """The rows of `docs`, with all their columns, whose id and `marks` (names to columns over `docs`)
    `decided` (doc_id, the marks, kept) keeps; of rows that agree in all of these one.

    Rows whose id no dropped row has stay where they are: they are read, tested against a bitmap of the
    dropped rows' ids and passed on. Only the others are shuffled, equal ones added up before, and decided exactly.
    """
    keys = ["id_key", *marks]
    decided = cut_lineage(decided.select(key_of("doc_id").alias("id_key"), *marks, "kept"), "decided")
    dropped = decided.filter(~F.col("kept")).select("id_key").distinct()
    may_go = id_filter(dropped, dropped.count())
    tagged = docs.select(F.struct("*").alias("row"), key_of(id_col).alias("id_key"))
    stay = may_go(tagged, False).select("row.*")
    doubtful = may_go(tagged, True).select("row.*").select(
        F.struct("*").alias("row"), key_of(id_col).alias("id_key"), *[mark.alias(name) for name, mark in marks.items()])
    one = doubtful.groupBy(*keys).agg(F.first("row").alias("row"))
    wanted = may_go(decided.filter("kept").drop("kept"), True)
    return stay.unionByName(one.join(wanted, keys, "left_semi").select("row.*"))


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def ranked(rows: DataFrame, groups, bucket: str, order, sums=()) -> DataFrame:
    """Add `place`, the row's exact 0-based rank in its group along (`bucket`, `order`), `before_<s>`,
    the sum of `s` over the rows before it, and the group's totals `n_total` and `<s>_total`.

    `bucket` is a monotone function of the order that cuts every group into small parts. Rows meet
    only inside a part; the parts' totals, one row a part, are put in order per group. `rows` is read
    twice and must be a written table.
    """
    part = [*groups, bucket]
    inside = W.partitionBy(*part).orderBy(*order)
    earlier = inside.rowsBetween(W.unboundedPreceding, -1)
    local = rows.withColumns({
        "_place": F.row_number().over(inside) - 1,
        **{f"_before_{s}": F.coalesce(F.sum(s).over(earlier), F.lit(0)) for s in sums}})
    parts = rows.groupBy(*part).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(s).alias(f"_t_{s}") for s in sums])
    whole = W.partitionBy(*groups) if groups else W.partitionBy(F.lit(0))
    before = whole.orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    names = {"_n": ("_first", "n_total"), **{f"_t_{s}": (f"_shift_{s}", f"{s}_total") for s in sums}}
    shifts = parts.select(
        *part,
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(first) for c, (first, _) in names.items()],
        *[F.sum(c).over(whole).alias(total) for c, (_, total) in names.items()])
    return local.join(shifts, part).select(
        *rows.columns, (F.col("_first") + F.col("_place")).alias("place"),
        *[(F.col(f"_shift_{s}") + F.col(f"_before_{s}")).alias(f"before_{s}") for s in sums],
        "n_total", *[f"{s}_total" for s in sums])


def in_order(rows: DataFrame, groups, order, tag: str, sums=()) -> DataFrame:
    """`ranked` over parts of equal size, whatever ids repeat: `rows` are dealt by ranges of (`groups`, `order`)
    and written with the number of their range. `order` must end in a column that tells all rows apart, and
    `rows` must be cheap to read twice."""
    dealt = rows.repartitionByRange(4 * shuffle_partitions(rows), *groups, *order).withColumn(
        "range_no", F.spark_partition_id())
    return ranked(cut_lineage(dealt, tag), groups, "range_no", order, sums).drop("range_no")


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int, id_col, text_col, label_col, seed: int,
                    parts: int) -> DataFrame:
    """(label, part, text) of about `rows` labelled ids, drawn by a hash of the id; part is 0 .. `parts` - 1.

    One row per id, whatever repeats: null ids and labels, and ids that have both labels, are left out; of
    several texts of an id the one of least hash is taken, before the texts are shuffled."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter(
        "id is not null and label is not null").groupBy("id").agg(
        F.min("label").alias("label"), F.max("label").alias("other")).filter("label = other").drop("other")
    n = known.count()
    share = min(1.0, rows / n) if n else 0.0

    def spot(salt):
        return F.pmod(F.xxhash64(F.lit(salt), F.col("id").cast("string")), F.lit(1 << 32))

    # about `rows` ids at most, whatever the tables: small enough to be sent everywhere
    chosen = known.filter(spot(seed) < int(share * (1 << 32))).withColumn(
        "part", F.pmod(spot(seed + 1), F.lit(parts)).cast("int"))
    texts = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    return texts.join(F.broadcast(chosen), "id").groupBy("id", "label", "part").agg(
        F.min_by("text", F.xxhash64("text")).alias("text")).select("label", "part", "text")
