"""The manifest's digests and proofs against a plain recursive version over whole tables."""

import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from millrace.llm import merkle
from millrace.llm.queries import QUERIES

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, lowered=False):
    out = []
    for name in FIELDS:
        value = row[name]
        if value is None:
            out.append("-")
            continue
        value = str(value)
        if lowered and name == "text":
            value = value.encode().lower().decode()
        out.append(f"{len(value.encode())}:{value}")
    return h(*out)


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def walked(all_levels, at, folded):
    siblings = []
    for nodes in all_levels[:-1]:
        first = at // 8 * 8
        run = nodes[first:first + 8]
        siblings += run[:at - first] + run[at - first + 1:]
        run[at - first] = folded
        folded, at = h(*run), at // 8
    return siblings, folded


def plain(rows, tampers=lambda row: row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of every row."""
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for group in order:
        members = sorted(groups[group], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        trees.append((members, levels([leaf_of(r) for r in members])))
    top = levels([tree[-1][0] for _, tree in trees])
    out = []
    for number, (members, tree) in enumerate(trees):
        for i, row in enumerate(members):
            below, folded = walked(tree, i, leaf_of(row, tampers(row)))
            above, folded = walked(top, number, folded)
            out.append((row["doc_id"], tree[0][i], tree[-1][0], top[-1][0], h(*below, *above), folded, folded == top[-1][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_whole_table(spark, folder):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = sorted((tuple(r[n] for n in names) for r in QUERIES["op13_merkle"](spark, folder).collect()), key=str)
    shown = duckdb.sql(f"select * from '{folder}/documents.parquet'")
    assert got == plain([dict(zip(shown.columns, row)) for row in shown.fetchall()])
    assert {r[-1] for r in got} == {True, False}


def test_agrees_with_sql(spark):
    from millrace.llm.queries import ORACLES
    from tools.compare import difference, duck

    folder = "/root/testdata/sf0.01"
    assert difference(QUERIES["op13_merkle"](spark, folder), duck(folder), ORACLES["op13_merkle"]) is None


def manifest(docs):
    claim = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, merkle.leaf_digest(
        [F.translate(f, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz") if f == "text" else F.col(f) for f in FIELDS]))
    true = merkle.leaf_digest([F.col(f) for f in FIELDS])
    return merkle.Manifest.build(docs, FIELDS, claim=F.coalesce(claim, true))


def test_odd_rows(spark, odd):
    """Null ids, texts and sources, repeated rows, long texts, clashing names."""
    docs = odd.withColumn("lang", F.when(F.col("source") == "a", None).otherwise(F.coalesce("source", "lang")))
    made = manifest(docs)
    got = sorted(((r["doc_id"], r["leaf"], r["subroot"], made.root, r["proof_sha256"], r["folded_root"],
                   r["folded_root"] == made.root) for r in made.proofs().collect()), key=str)
    assert got == plain([r.asDict() for r in docs.collect()])


def test_empty_table(spark, empty):
    made = manifest(empty)
    assert made.root is None
    assert made.proofs().count() == 0


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 64, 65, 513, 4096, 4097])
def test_sizes_of_trees(spark, n):
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"))
    made = merkle.Manifest.build(docs, ["doc_id", "lang"])
    leaves = [h(f"{len(str(i))}:{i}", "2:en") for i in range(n)]
    assert made.root == levels(leaves)[-1][0]
    some = made.proofs(F.col("doc_id").isin(0, n // 2, n - 1), siblings=True).collect()
    assert {r["doc_id"] for r in some} == {0, n // 2, n - 1}
    for row in some:
        siblings, folded = walked(levels(leaves), row["doc_id"], leaves[row["doc_id"]])
        assert (row["siblings"], row["folded_root"]) == (siblings, made.root) and folded == made.root


def test_missing_is_minimal():
    """What a set of leaves needs is what their paths touch, less what they derive."""
    n, leaves = 200, [3, 4, 60, 199]
    needed, derived = set(), set()
    for leaf in leaves:
        at = leaf
        for level, width in enumerate(merkle.widths(n)[:-1]):
            derived.add((level, at))
            needed |= {(level, i) for i in range(at // 8 * 8, min(width, at // 8 * 8 + 8))}
            at //= 8
    assert set(merkle.missing(leaves, n)) == needed - derived
    assert len(merkle.missing(leaves, n)) == len(needed - derived)


def test_a_hot_id_is_dealt_over_parts(spark):
    """A third of the rows with one id, another third with none: no part of the order holds more than a few."""
    from millrace.llm.common import in_order

    rows = spark.range(6000).select(
        F.lit("g").alias("tree"), F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id")).alias("doc_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("digest"), F.col("id").alias("row_no"))
    placed = in_order(rows, ["tree"], ["doc_id", "digest", "row_no"], "t")
    assert sorted(r["place"] for r in placed.collect()) == list(range(6000))
    dealt = rows.repartitionByRange(32, "tree", "doc_id", "digest", "row_no").groupBy(F.spark_partition_id()).count()
    assert max(r["count"] for r in dealt.collect()) < 6000 / 32 * 3
