"""Mixing sources to target weights with a low-discrepancy schedule.

* Targets: every source gets its weight's share of `total` words, at most `most_repeats` times its
  size; what is cut off goes to the others by weight until none is above (water filling).
* Streams: each source's documents, in a seeded shuffle, form one stream of words, read again from its start
  when it ends, and cut into blocks of `block_words`. The mix takes whole documents: the last one of a source is
  taken if the target is nearer with it than without it.
* Schedule: slot i of 2^m stands at its van der Corput point, the bits of i reversed behind the binary point.
  The points in a source's stretch of the cumulative targets are its slots; they are ranked, and the r-th takes
  the source's r-th block. So every beginning of the schedule holds the sources in about their shares. A document
  has the slot of the block in which it begins; slots that a source does not need are left out, and a source
  short of slots, because its share is less than one, gets the missing ones behind all others.

A source's slots are found from its own stretch, in chunks that are spread before they are counted out, so no
task holds a source. Ranks and running sums come from counts of small parts. Only the table of sources (one row
each) is ordered as a whole.

Defined results: a null source is a source, ordered last; a null or empty text has size 0 and is never taken;
equal (source, id) rows are ordered by text hash, and rows equal in all of these are interchangeable; an empty
table gives no rows; sources of size 0 have target 0.
"""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import in_order, key_of, ranked, shuffle_partitions, whole_text, word_count
from millrace.session import cut_lineage

PARTS_A_PARTITION = 4
BLOCK_WORDS = 256
CHUNK_SLOTS = 1 << 16


def source_targets(sizes: DataFrame, weights, share: float, most_repeats: int) -> DataFrame:
    """(key, source_size, target, words) from (key, is_null, source_size); words is the target cut to whole words.

    `weights` repeat along the sources in code point order, null last. Water filling: in the order of
    `most_repeats * size / weight`, sources are full until the level of the rest no longer passes the
    next one's limit. One row per source is ordered in one task, nothing else.
    """
    everything = W.partitionBy(F.lit(0))
    place = F.row_number().over(everything.orderBy("is_null", "key")) - 1
    weight = F.get(F.array(*[F.lit(int(w)) for w in weights]), F.pmod(place, F.lit(len(weights))).cast("int"))
    limits = sizes.withColumn("weight", weight.cast("bigint")).withColumn(
        "full", most_repeats * F.col("source_size")).withColumn("limit", F.col("full") / F.col("weight"))
    before = everything.orderBy("limit", "is_null", "key").rowsBetween(W.unboundedPreceding, -1)

    def rest(column, factor=1):
        return factor * F.sum(column).over(everything), F.coalesce(F.sum(column).over(before), F.lit(0))

    all_words, _ = rest("source_size", share)
    _, full_before = rest("full")
    all_weight, weight_before = rest("weight")
    leveled = limits.withColumn("water", (all_words - full_before) / (all_weight - weight_before))
    reached = F.when(F.col("water") <= F.col("limit"), F.struct("limit", "is_null", "key", "water"))
    leveled = leveled.withColumn("level", F.min(reached).over(everything)["water"])
    target = F.when(F.col("level") < F.col("limit"), F.col("weight") * F.col("level")).otherwise(
        F.col("full").cast("double"))
    return leveled.withColumn("target", target).select(
        "key", "is_null", "source_size", "target", F.floor("target").alias("words"))


def reversed_bits(number, bits: int):
    """The lowest `bits` bits of a number in reverse order."""
    return F.conv(F.reverse(F.lpad(F.bin(number), bits, "0")), 2, 10).cast("bigint")


def schedule(targets: DataFrame, block_words: int) -> DataFrame:
    """(key, place, slot): the slots that every source needs, `place` being the slot's rank in its source.

    `targets` is a written table of sources.
    """
    block = int(block_words)
    everything = W.partitionBy(F.lit(0))
    through = everything.orderBy("is_null", "key")
    needed = targets.filter("words > 0").withColumn("needed", F.expr(f"(words + {block - 1}) div {block}"))
    bounds = cut_lineage(needed.select(
        "key", "needed", F.sum("words").over(through).alias("to"), "words", F.sum("words").over(everything).alias("all"),
        (F.row_number().over(through) - 1).alias("source_no")), "mix-bounds")
    n, sources = bounds.agg(F.coalesce(F.sum("needed"), F.lit(0)), F.count(F.lit(1))).first()  # two numbers
    bits = max(1, (2 * n).bit_length())
    total = 1 << bits
    # points j / 2^bits from the stretch's beginning to its end
    first, end = ((F.ceil(e.cast("double") / F.col("all") * total)).cast("bigint") for e in (F.col("to") - F.col("words"), F.col("to")))
    stretches = bounds.select("key", first.alias("first"), (end - 1).alias("last")).filter("first <= last")
    chunks = stretches.select("key", "first", "last", F.explode(F.expr(
        f"sequence(first div {CHUNK_SLOTS}, last div {CHUNK_SLOTS})")).alias("chunk"))
    spread = chunks.repartition(max(1, min(PARTS_A_PARTITION * shuffle_partitions(targets), total // CHUNK_SLOTS + 1)))
    points = spread.select("key", F.explode(F.expr(
        f"sequence(greatest(first, chunk * {CHUNK_SLOTS}), least(last, chunk * {CHUNK_SLOTS} + {CHUNK_SLOTS - 1}))")).alias("point"))
    parts = PARTS_A_PARTITION * shuffle_partitions(targets)
    slots = points.select("key", reversed_bits(F.col("point"), bits).alias("slot")).withColumn(
        "part", F.floor(F.col("slot") / total * parts))
    placed = cut_lineage(ranked(cut_lineage(slots, "mix-slots"), ["key"], "part", ["slot"]).select(
        "key", "place", "slot", "n_total"), "mix-schedule")
    on_time = placed.join(bounds.select("key", "needed"), "key").filter("place < needed").select("key", "place", "slot")
    met = placed.groupBy("key").agg(F.max("n_total").alias("met"))
    late = bounds.join(met, "key", "left").withColumn("met", F.coalesce("met", F.lit(0))).filter("met < needed").select(
        "key", "met", "source_no", F.explode(F.sequence("met", F.col("needed") - 1)).alias("place")).select(
        "key", "place", (F.lit(total) + (F.col("place") - F.col("met")) * sources + F.col("source_no")).alias("slot"))
    return on_time.unionByName(late)


def _streamed(docs, seed, id_col, text_col, source_col, *more):
    identity = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"), key_of(source_col).alias("key"), F.col(source_col).isNull().alias("is_null"),
        word_count(text_col).alias("size"), F.md5(F.concat(F.lit(f"{seed}:"), identity)).alias("digest"),
        F.xxhash64(whole_text(text_col)).alias("tie"), F.monotonically_increasing_id().alias("row_no"), *more)


def _taken(rows, weights, share, most_repeats, block_words):
    """(row_no, size, source_size, target, passes, starts) of every row: how often it is taken, and the
    (slot, place in the slot) of every time."""
    block = int(block_words)
    sizes = rows.groupBy("key", "is_null").agg(F.sum("size").alias("source_size"))
    targets = cut_lineage(source_targets(sizes, weights, share, most_repeats), "mix-targets")
    streamed = in_order(rows, ["key"], ["digest", "doc_id", "size", "tie", "row_no"], "mix-order", ["size"])
    placed = streamed.select("row_no", "key", "size", "before_size").join(
        targets.select("key", "source_size", "target", "words"), "key")
    # a document is taken in a pass if its middle does not lie behind the target
    passes = F.when((F.col("size") > 0) & (2 * F.col("words") >= 2 * F.col("before_size") + F.col("size")), F.least(
        F.lit(int(most_repeats)), F.expr("(2 * words - 2 * before_size - size) div (2 * source_size) + 1"))).otherwise(0)
    counted = cut_lineage(placed.withColumn("passes", passes.cast("bigint")), "mix-streams")
    starts = counted.filter("passes > 0").select("row_no", "key", "source_size", "before_size", F.explode(F.expr(
        "sequence(0L, passes - 1)")).alias("pass")).withColumn("at", F.expr("pass * source_size + before_size"))
    slots = cut_lineage(schedule(targets, block), "mix-needed")
    # a block meets at most `block_words` documents; a begun block is in the schedule, for its words are
    met = starts.withColumn("place", F.expr(f"at div {block}")).join(slots, ["key", "place"]).groupBy("row_no").agg(
        F.array_sort(F.collect_list(F.struct("slot", F.expr(f"at % {block}").alias("at")))).alias("starts"))
    return counted.select("row_no", "size", "source_size", "target", "passes").join(met, "row_no", "left")


def mix_plan(docs: DataFrame, weights, share=1.5, most_repeats=2, block_words=BLOCK_WORDS, seed=0, id_col="doc_id",
             text_col="text", source_col="source") -> DataFrame:
    """One row per row of `docs`: doc_id, size, source_size, target, taken (words, repeats counted) and first_slot,
    the slot in which the row is taken first, null where it is not."""
    rows = cut_lineage(_streamed(docs, seed, id_col, text_col, source_col), "mix-rows")
    taken = _taken(rows, weights, share, most_repeats, block_words)
    return rows.select("row_no", "doc_id").join(taken, "row_no").select(
        "doc_id", "size", "source_size", "target", (F.col("passes") * F.col("size")).alias("taken"),
        F.get("starts", F.lit(0))["slot"].alias("first_slot"))


def mix(docs: DataFrame, weights, share=1.5, most_repeats=2, block_words=BLOCK_WORDS, seed=0, id_col="doc_id",
        text_col="text", source_col="source", slot_col: str | None = None) -> DataFrame:
    """The rows of the mix, with the columns of `docs` (and the slot as `slot_col`, if named): a row for every
    time that a document is taken. Rows lie in the order of the schedule within each of its stretches."""
    rows = cut_lineage(_streamed(docs, seed, id_col, text_col, source_col, F.struct("*").alias("row")), "mix-rows")
    taken = cut_lineage(_taken(rows.drop("row"), weights, share, most_repeats, block_words).filter("passes > 0").select(
        "row_no", F.explode("starts").alias("start")), "mix-taken")
    last = taken.agg(F.coalesce(F.max("start.slot"), F.lit(0))).first()[0] + 1  # one number
    parts = PARTS_A_PARTITION * shuffle_partitions(docs)
    mixed = rows.select("row_no", "row").join(taken, "row_no").withColumn("part", F.floor(F.col("start.slot") * parts / last))
    ordered = mixed.repartition(shuffle_partitions(docs), "part").sortWithinPartitions("part", "start.slot", "start.at", "row_no")
    slot = [F.col("start.slot").alias(slot_col)] if slot_col else []
    return ordered.select(*[F.col("row")[c].alias(c) for c in docs.columns], *slot)
