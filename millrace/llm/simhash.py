"""SimHash near-dedup with BK-trees.

Fingerprints: 64 bits by majority over the XXH64 of word shingles. Equal fingerprints are one entry, so
exact copies cost nothing further. Entries within `radius` bits are linked, and linked entries form
components whose smallest document stays.

Which trees an entry meets: its 64 bits are cut into `radius` + 1 blocks; two entries within the radius
agree on at least one block, so a shard holds the entries that share a block's value. A shard of more
than `most` entries is cut again: the remaining bits into 4 * radius fine blocks (fewer from radius 4 on, so that
there are at most 250 choices), a key for every choice of all but `radius` of them. Entries that share such a
key can differ in `radius` small blocks only: at radius 2 and 3 that bounds the shard to 2^12 entries whatever
the data. At wider radii every link is found too, but the left-out bits, and with them the bound, grow. A radius
of 64 or more is refused. Nothing of the corpus passes through the driver.

In a shard the entries build one BK-tree, children keyed by their integer Hamming distance to the
parent, and each entry follows only the edges within the radius of its own distance. The links of a
shard leave it as a spanning forest: connectivity is whole, copies are never expanded into pairs.

Defined results: a null text counts as the empty one; a text without words has fingerprint zero; one
of fewer words than a shingle is one shingle; null ids lose against every other id (a component of null
ids has a null id); of rows that repeat an id one stays; an empty table gives no rows; other columns are
carried untouched.
"""

from functools import partial
from itertools import islice
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from millrace.llm.common import rows_that_stay, shuffle_partitions, whole_text
from millrace.operators.components import connected_components
from millrace.session import cut_lineage

SEED = 42
MOST = 512
_MOST_CHOICES = 250
_CHUNK = 1 << 15


def simhash(text: str, shingle: int) -> int:
    """The fingerprint as a signed 64-bit integer."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    shingles = map(b" ".join, zip(*(islice(words, i, None) for i in range(shingle)))) if len(words) >= shingle \
        else iter([b" ".join(words)])
    hashes = map(partial(xxhash.xxh64_intdigest, seed=SEED), shingles)
    ones = np.zeros(64, dtype=np.int64)
    while (part := np.fromiter(islice(hashes, _CHUNK), dtype=np.uint64)).size:
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprints(text_col: str, shingle: int) -> Column:
    @F.pandas_udf(LongType())
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(text, shingle) for text in texts], dtype="int64")

    return of(whole_text(text_col))


def as_hex(fingerprint) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


class BKTree:
    """Values in a metric tree: `children[i]` maps the distance from value i to the subtree at that distance."""

    def __init__(self):
        self.values, self.children = [], []

    def add(self, value: int) -> int:
        new = len(self.values)
        self.values.append(value)
        self.children.append({})
        if new:
            at = 0
            while True:
                distance = (self.values[at] ^ value).bit_count()
                following = self.children[at].setdefault(distance, new)
                if following == new:
                    break
                at = following
        return new

    def within(self, value: int, radius: int):
        """Indexes of the values at most `radius` away: only edges whose distance is within the radius
        of the parent's own distance can lead there."""
        open_, found = [0] if self.values else [], []
        while open_:
            at = open_.pop()
            distance = (self.values[at] ^ value).bit_count()
            if distance <= radius:
                found.append(at)
            children = self.children[at]
            for edge in range(distance - radius, distance + radius + 1):
                child = children.get(edge)
                if child is not None:
                    open_.append(child)
        return found


def forest(values, radius: int):
    """Pairs of indexes within the radius that join the values into their components, one fewer than each has."""
    tree, parent, links = BKTree(), [], []

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for value in values:
        near = tree.within(value, radius)
        new = tree.add(value)
        parent.append(new)
        for other in near:
            a, b = root(new), root(other)
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((new, other))
    return links


def _block(value: Column, start: int, width: int) -> Column:
    return F.shiftrightunsigned(value, start).bitwiseAND(F.lit((1 << width) - 1))


def _widths(bits: int, blocks: int):
    return [bits // blocks + (i < bits % blocks) for i in range(blocks)]


def _coarse_keys(fp: Column, radius: int):
    """One key per block: its number and value; with the bits outside the block, moved together."""
    keys, start = [], 0
    for number, width in enumerate(_widths(64, radius + 1)):
        keys.append(F.struct(F.lit(number).alias("block"), _block(fp, start, width).alias("value")))
        start += width
    return F.array(*keys)


def _fine_blocks(radius: int) -> int:
    """Four fine blocks a bit of the radius, or fewer, but more than the radius, where that gives too many choices."""
    return max([radius + 1, *[n for n in range(radius + 1, 4 * radius + 1) if comb(n, radius) <= _MOST_CHOICES]])


def _fine_keys(fp: Column, number: int, radius: int):
    """Keys over the bits outside block `number`, one for every choice of fine blocks left out."""
    from itertools import combinations

    widths, blocks = _widths(64, radius + 1), _fine_blocks(radius)
    low = sum(widths[:number])
    free = [b for b in range(64) if not low <= b < low + widths[number]]
    cuts, at = [], 0
    for width in _widths(len(free), blocks):
        cuts.append(free[at:at + width])
        at += width
    keys = []
    for left_out in combinations(range(blocks), radius):
        mask = sum(1 << b for i, cut in enumerate(cuts) if i not in left_out for b in cut)
        mask |= sum(1 << b for b in range(low, low + widths[number]))
        mask -= (1 << 64) if mask >> 63 else 0
        keys.append(F.xxhash64(F.lit(number), F.lit(repr(left_out)), fp.bitwiseAND(F.lit(mask).cast("bigint"))))
    return F.array(*keys)


def _search(radius):
    """Links inside every shard of a stream of rows ordered by shard."""
    def links_of(batches):
        held_shard, held = None, []

        def linked(values):
            fps = np.array(values, dtype=np.int64).view(np.uint64).tolist()
            return [(values[a], values[b]) for a, b in forest(fps, radius)]

        out = []
        for batch in batches:
            shards, fps = batch["shard"].to_numpy(), batch["fp"].to_numpy()
            edges = np.flatnonzero(shards[1:] != shards[:-1]) + 1
            for group in np.split(np.arange(len(shards)), edges) if len(shards) else []:
                shard, members = shards[group[0]], fps[group[0]:group[-1] + 1].tolist()
                if shard == held_shard:
                    held.extend(members)
                    continue
                if len(held) > 1:
                    out.extend(linked(held))
                held_shard, held = shard, members
            if out:
                yield pd.DataFrame(out, columns=["u", "v"])
                out = []
        if len(held) > 1:
            out = linked(held)
        yield pd.DataFrame(out, columns=["u", "v"]).astype("int64")

    return links_of


def fingerprint_links(entries: DataFrame, radius: int = 2, most: int = MOST) -> DataFrame:
    """(u, v): links between distinct fingerprints (column fp, a written table) that join every component."""
    if not 0 <= radius < 64:
        raise ValueError("fingerprints of 64 bits can be cut into shards for a radius of 0 to 63 only")
    keyed = entries.select("fp", F.explode(_coarse_keys(F.col("fp"), radius)).alias("k")).select(
        "fp", F.col("k.block").alias("block"), F.xxhash64("k.block", "k.value").alias("shard"))
    sizes = cut_lineage(keyed.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "shards")
    shared = keyed.join(sizes, "shard")
    fine = F.coalesce(*[F.when(F.col("block") == number, _fine_keys(F.col("fp"), number, radius))
                        for number in range(radius + 1)])
    crowded = shared.filter(F.col("n") > most).select("fp", F.explode(fine).alias("shard"))
    members = shared.filter(F.col("n") <= most).select("fp", "shard").unionByName(crowded)
    placed = members.repartition(shuffle_partitions(entries), "shard").sortWithinPartitions("shard", "fp")
    return placed.mapInPandas(_search(radius), "u bigint, v bigint").distinct()


def _decide(rows: DataFrame, radius: int, most: int) -> DataFrame:
    """`rows` with component_id and kept, from a written table (row_no, doc_id, fp, text_hash)."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_no"))
    entries = cut_lineage(rows.groupBy("fp").agg(first.alias("first")), "fingerprints")
    joined = connected_components(entries.select(F.col("fp").alias("node")), fingerprint_links(entries, radius, most))
    linked = entries.join(joined, entries.fp == joined.node).select("fp", "component", "first")
    # written, so that Spark can split the rows of a hot component in the join
    lowest = cut_lineage(linked.groupBy("component").agg(F.min("first").alias("lowest"), F.count(F.lit(1)).alias("n"))
                         .filter("n > 1").drop("n"), "lowest")
    firsts = cut_lineage(linked.join(lowest, "component", "left").select(
        "fp", F.coalesce("lowest", "first").alias("first")), "firsts")
    return rows.join(firsts, "fp").select(
        "doc_id", "fp", "text_hash", F.col("first.doc_id").alias("component_id"),
        (F.col("row_no") == F.col("first.row_no")).alias("kept"))


def _rows(docs, shingle, id_col, text_col):
    return cut_lineage(docs.select(
        F.col(id_col).alias("doc_id"), fingerprints(text_col, shingle).alias("fp"),
        F.xxhash64(whole_text(text_col)).alias("text_hash"), F.monotonically_increasing_id().alias("row_no")), "simhash-rows")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2, most: int = MOST, id_col="doc_id",
                    text_col="text") -> DataFrame:
    """One row per row of `docs`: doc_id, fingerprint (hex), component_id, kept."""
    return _decide(_rows(docs, shingle, id_col, text_col), radius, most).select("doc_id", as_hex("fp").alias("fingerprint"), "component_id", "kept")


def deduplicate(docs: DataFrame, shingle: int = 3, radius: int = 2, most: int = MOST, id_col="doc_id",
                text_col="text") -> DataFrame:
    """The rows of `docs` that stay, one of every component, with all their columns."""
    decided = _decide(_rows(docs, shingle, id_col, text_col), radius, most)
    return rows_that_stay(docs, id_col, {"text_hash": F.xxhash64(whole_text(text_col))}, decided)
