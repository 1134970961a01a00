"""Merkle manifest of a dataset, with proofs for many leaves at once (Octopus multiproofs).

* Leaves: SHA-256 over a row's fields, each with its length, so that no two rows are written alike. Within a
  group leaves ascend by id; every run of `RUN` consecutive nodes becomes the digest of its digests until one
  is left, the group's subroot. Subroots in the order of the groups make the root in the same way.
* Building: leaves are ranked in parts of equal size; then tasks that hold an aligned chunk of 4,096 nodes
  each climb four levels, so a table of n rows takes about log(n) / log(4096) shuffles of ever smaller tables.
* Proofs: the leaves to prove are dealt to the same chunks. A chunk computes the least set of node coordinates
  that its leaves cannot derive from each other, fetches those in one join, derives the interior nodes that its
  proofs share once, and expands the single proofs from them. Other chunks' leaves and texts are not read.

No task holds more than 4,096 leaves and what they miss, however large a group is. The groups themselves, one
row each, are put in order in one task.

Defined results: a null field is written as `-` and so differs from every value; a null group is a group, the
first; null ids come first; rows with one id are ordered by leaf, and rows equal in both are interchangeable; a
lone leaf is its own subroot and a lone subroot the root; an empty table has no rows and no root; columns that
are not named are not read.
"""

import hashlib
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import in_order, key_of
from millrace.session import cut_lineage

RUN = 8
CLIMB = 4  # levels that a chunk climbs
CHUNK = RUN ** CLIMB
TOP = ""  # the tree over the groups: no group's key is empty
_NODE = "tree string, level int, idx bigint, digest string"


def digest_of(parts) -> str:
    """SHA-256 of digests as text, one after the other."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(fields) -> Column:
    """SHA-256 of the fields: `-` for null, else the length in bytes, `:` and the value."""
    def written(field):
        value = field.cast("string")
        return F.when(value.isNull(), F.lit("-")).otherwise(
            F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))

    return F.sha2(F.concat(*[written(field) for field in fields]), 256)


def widths(n: int) -> list:
    """Nodes on every level of a tree of n leaves, leaves first."""
    out = [n]
    while out[-1] > 1:
        out.append(-(-out[-1] // RUN))
    return out


def missing(leaves, n: int) -> list:
    """The least (level, idx) that proofs of all of `leaves` need besides these leaves themselves."""
    out, known = [], sorted(set(leaves))
    for level, width in enumerate(widths(n)[:-1]):
        have, parents = set(known), sorted({i // RUN for i in known})
        out += [(level, i) for p in parents for i in range(p * RUN, min(width, (p + 1) * RUN)) if i not in have]
        known = parents
    return out


def derive(nodes: dict, leaves, n: int) -> dict:
    """`nodes` with every interior node above `leaves`, each derived once from its run."""
    known = sorted(set(leaves))
    for level, width in enumerate(widths(n)[:-1]):
        known = sorted({i // RUN for i in known})
        for p in known:
            nodes[level + 1, p] = digest_of(nodes[level, i] for i in range(p * RUN, min(width, (p + 1) * RUN)))
    return nodes


def path(nodes: dict, leaf: int, claimed: str, n: int):
    """(siblings level by level from left to right, the digest that `claimed` at `leaf` folds to)."""
    siblings, at, folded = [], leaf, claimed
    for level, width in enumerate(widths(n)[:-1]):
        first, end = at // RUN * RUN, min(width, (at // RUN + 1) * RUN)
        before, after = ([nodes[level, i] for i in range(*ends)] for ends in ((first, at), (at + 1, end)))
        siblings += before + after
        folded = digest_of([*before, folded, *after])
        at //= RUN
    return siblings, folded


def _climb(rows: pd.DataFrame) -> pd.DataFrame:
    """The nodes above one chunk of a level, up to its top or to the tree's."""
    tree, level = rows["tree"].iloc[0], int(rows["level"].iloc[0])
    rows = rows.sort_values("idx")
    idx, digests, out = int(rows["idx"].iloc[0]), rows["digest"].tolist(), []
    whole = idx == 0 and len(digests) < CHUNK  # no other chunk on this level
    for step in range(1, CLIMB + 1):
        if whole and len(digests) == 1:
            break
        idx //= RUN
        digests = [digest_of(digests[i:i + RUN]) for i in range(0, len(digests), RUN)]
        out += [(tree, level + step, idx + i, d) for i, d in enumerate(digests)]
    return pd.DataFrame(out, columns=["tree", "level", "idx", "digest"])


def _grown(leaves: DataFrame, largest: int) -> DataFrame:
    """All nodes of the trees with these leaves (tree, idx, digest), the largest of which has `largest`."""
    level = leaves.select("tree", F.lit(0).alias("level"), "idx", "digest")
    nodes, height = level, 0
    while largest > 1:
        chunks = level.withColumn("chunk", F.expr(f"idx div {CHUNK}"))
        several = chunks if height == 0 else chunks.join(
            level.groupBy("tree").agg(F.max("idx").alias("last")).filter("last > 0"), "tree", "left_semi")
        above = cut_lineage(several.groupBy("tree", "chunk").applyInPandas(_climb, _NODE), "merkle-nodes")
        nodes, height, largest = nodes.unionByName(above), height + CLIMB, -(-largest // CHUNK)
        level = above.filter(F.col("level") == height)
    return nodes


@dataclass(frozen=True)
class Manifest:
    """Written tables: leaves (group_key, place, doc_id, leaf, claim), groups (group_key, n, position, subroot)
    and nodes (tree, level, idx, digest) of every tree; the number of groups and the root."""

    leaves: DataFrame
    groups: DataFrame
    nodes: DataFrame
    n_groups: int
    root: str | None

    @classmethod
    def build(cls, docs: DataFrame, fields, group_col="lang", id_col="doc_id", claim: Column | None = None) -> "Manifest":
        """Digests of the `fields` (names or columns) of every row. `claim`, if given, is a leaf that someone
        claims for the row: `proofs` judges it in place of the true one."""
        leaf = leaf_digest([F.col(f) if isinstance(f, str) else f for f in fields])
        rows = cut_lineage(docs.select(
            key_of(group_col).alias("tree"), F.col(id_col).alias("doc_id"), leaf.alias("digest"),
            (leaf if claim is None else claim).alias("claim"), F.monotonically_increasing_id().alias("row_no")), "leaves")
        leaves = cut_lineage(in_order(rows, ["tree"], ["doc_id", "digest", "row_no"], "leaf-order").withColumnRenamed(
            "place", "idx").drop("row_no", "n_total"), "ranked-leaves")
        sizes = leaves.groupBy("tree").agg(F.count(F.lit(1)).alias("n"))
        largest, n_groups = sizes.agg(F.coalesce(F.max("n"), F.lit(0)), F.count(F.lit(1))).first()
        inner = _grown(leaves, largest)
        tops = inner.groupBy("tree").agg(F.max_by("digest", "level").alias("subroot"))  # one node on the last level
        groups = cut_lineage(sizes.join(tops, "tree").withColumn(
            "position", (F.row_number().over(W.partitionBy(F.lit(0)).orderBy("tree")) - 1).cast("bigint")), "groups")
        outer = _grown(groups.select(F.lit(TOP).alias("tree"), F.col("position").alias("idx"),
                                     F.col("subroot").alias("digest")), n_groups)
        last = outer.agg(F.max_by("digest", "level")).first()[0]
        return cls(leaves, groups, inner.unionByName(outer), n_groups, last)

    def proofs(self, wanted: Column | None = None, siblings: bool = False) -> DataFrame:
        """doc_id, group_key, leaf, claim, subroot, proof_sha256, folded_root of the leaves that `wanted` (a
        condition over doc_id, digest and claim) names, of all by default; with the siblings themselves if asked."""
        n_groups, with_siblings = self.n_groups, siblings
        asked = self.leaves if wanted is None else self.leaves.filter(wanted)
        asked = asked.join(self.groups, "tree").withColumn("chunk", F.expr(f"idx div {CHUNK}"))

        def needs(rows: pd.DataFrame) -> pd.DataFrame:
            tree, chunk, n, position = rows[["tree", "chunk", "n", "position"]].iloc[0]
            out = [(tree, chunk, tree, level, i) for level, i in missing(rows["idx"].tolist(), int(n))]
            out += [(tree, chunk, TOP, level, i) for level, i in missing([int(position)], n_groups)]
            return pd.DataFrame(out, columns=["of", "chunk", "tree", "level", "idx"])

        coordinates = asked.select("tree", "chunk", "n", "position", "idx").groupBy("tree", "chunk").applyInPandas(
            needs, "of string, chunk bigint, tree string, level int, idx bigint")
        fetched = coordinates.join(self.nodes, ["tree", "level", "idx"])

        def expand(rows: pd.DataFrame, met: pd.DataFrame) -> pd.DataFrame:
            tree, n, position, subroot = rows[["tree", "n", "position", "subroot"]].iloc[0]
            n, position = int(n), int(position)
            inner = dict(zip(((0, i) for i in rows["idx"].tolist()), rows["digest"]))
            outer = {(0, position): subroot}
            for name, level, i, digest in zip(met["tree"], met["level"], met["idx"], met["digest"]):
                (outer if name == TOP else inner)[level, i] = digest
            derive(inner, rows["idx"].tolist(), n)
            out = []
            for doc_id, leaf, claim, i in zip(rows["doc_id"], rows["digest"], rows["claim"], rows["idx"].tolist()):
                below, folded = path(inner, i, claim, n)
                above, folded = path(outer, position, folded, n_groups)
                out.append((doc_id, tree, leaf, claim, subroot, digest_of(below + above), folded,
                            below + above if with_siblings else None))
            return pd.DataFrame(out, columns=["doc_id", "group_key", "leaf", "claim", "subroot", "proof_sha256",
                                              "folded_root", "siblings"])

        # ids travel as text: pandas would turn integers beside nulls into floating-point numbers
        left = asked.withColumn("doc_id", F.col("doc_id").cast("string")).groupBy("tree", "chunk")
        right = fetched.groupBy("of", "chunk")
        shape = ("doc_id string, group_key string, leaf string, claim string, subroot string, proof_sha256 string, "
                 "folded_root string, siblings array<string>")
        proved = left.cogroup(right).applyInPandas(expand, shape)
        proved = proved.withColumn("doc_id", F.col("doc_id").cast(self.leaves.schema["doc_id"].dataType))
        return proved if siblings else proved.drop("siblings")
