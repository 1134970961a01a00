"""Many tree ensembles over one table, grown together level by level.

The table is binned once (quantiles per feature) and kept in blocks of bounded size. A level of all trees of all
ensembles, parameter maps and folds takes one pass: every block adds up, per tree, node, feature and bin, what
falls there; the sums meet per tree, which picks its nodes' best splits. Sums are whole numbers (class counts, or
gradients in fixed point), so neither the number of blocks nor their order changes a tree.

* A tree is fixed by the seed, its number, the training rows and the smallest leaf, not by the number of
  trees or the depth asked for: a forest of 50 trees and depth 3 is the first 50 trees of one of 200 and depth 10,
  cut at depth 3. Parameter maps that differ in these alone are therefore grown once and read off at their sizes.
* Rows with the same bins stand at the same node of every tree. A task that can keep the binned rows (`TREE_ROWS`,
  `BOOSTED_ROWS`) adds them up by their bins (`Cells`), grows all trees of a group on these and judges them there, so
  neither trees nor scores leave it. Over larger tables the driver starts a pass per level, in which a task adds up a
  range of trees on one block; trees are grown in waves of bounded size, and the driver holds one wave.

Training rows are given by marks: per row and fold a number, -1 for rows to judge, -2 for neither, else the
first step (of a learning curve; 0 in cross-validation) whose training rows include it.
"""

from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import cut_lineage

BINS = 32
BLOCK_ROWS = 1 << 16
TREES_A_TASK = 25
TREE_ROWS = 1 << 23  # at most this many rows (13 bytes and a mark each) are kept by a task that grows whole trees
BOOSTED_ROWS = TREE_ROWS  # the same for a task that boosts: scores belong to cells, not to rows
WAVE_NODES = 1 << 22  # tree nodes that the driver holds and sends out at once, about 20 bytes each
_SALT = np.uint64(0x9E3779B97F4A7C15)
_POISSON = np.cumsum([np.exp(-1.0) / f for f in (1, 1, 2, 6, 24, 120, 720, 5040, 40320)])
_POINT = float(1 << 20)  # fixed point of gradients
_SLICE = 1 << 15  # keys hashed together
_UNSURE = 255
_EDGES = np.arange((1 << 16) + 1) / (1 << 16)
# draws by the first 16 bits of a hash, where they decide
_DRAWN = np.searchsorted(_POISSON, _EDGES[:-1], side="right").astype(np.uint8)
_DRAWN[_DRAWN != np.searchsorted(_POISSON, _EDGES[1:], side="left")] = _UNSURE


@dataclass(frozen=True)
class Forest:
    """`trees` bagged trees of at most `depth` levels, leaves of at least `leaf` rows, and as many features
    tried at a node as `subset` says (all, sqrt or log2). One tree that is not bagged is a decision tree."""

    trees: int = 100
    depth: int = 5
    leaf: int = 1
    subset: str = "sqrt"
    bagged: bool = True
    seed: int = 42

    def tried(self, features: int) -> int:
        wanted = {"all": features, "sqrt": np.ceil(np.sqrt(features)), "log2": np.ceil(np.log2(features))}[self.subset]
        return int(min(features, max(1, wanted)))


@dataclass(frozen=True)
class Boosted:
    """`rounds` of one regression tree a class on the residuals of the softmax of all classes."""

    rounds: int = 100
    depth: int = 3
    leaf: int = 1
    rate: float = 0.1


# --- blocks ------------------------------------------------------------------

@dataclass(frozen=True)
class Blocks:
    """A written table of (block, n, codes, labels, keys, marks) and what it was made with."""

    rows: DataFrame
    count: int
    n: int
    features: int
    classes: int
    folds: int

    @classmethod
    def of(cls, rows: DataFrame, key: str, columns, label: str, marks, block_rows: int = BLOCK_ROWS) -> "Blocks":
        """`marks` are integer columns of `rows`, one a fold; labels are 0, 1, 2, ..."""
        columns, marks = list(columns), list(marks)
        shares = [i / BINS for i in range(1, BINS)]
        facts = rows.agg(
            F.count(F.lit(1)).alias("n"), F.max(F.col(label)).alias("top"),
            *[F.percentile_approx(F.col(c).cast("double"), shares, 20 * BINS).alias(f"_{i}") for i, c in enumerate(columns)]
        ).first()  # one row: BINS numbers a feature
        edges = [np.unique(np.array(facts[f"_{i}"] or [0.0])) for i in range(len(columns))]
        count = max(1, -(-facts["n"] // block_rows))

        def packed(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("key")
            codes = np.stack([np.searchsorted(e, rows[f"f{i}"].to_numpy(), side="left") for i, e in enumerate(edges)], axis=1)
            kept = {"codes": codes.astype(np.uint8), "labels": rows["label"].to_numpy().astype(np.uint8),
                    "keys": rows["key"].to_numpy().astype(np.int64),
                    "marks": rows[[f"m{i}" for i in range(len(marks))]].to_numpy().astype(np.int16)}
            return pd.DataFrame({"block": [int(rows["block"].iloc[0])], "n": [len(rows)],
                                 **{k: [v.tobytes()] for k, v in kept.items()}})

        shaped = rows.select(
            F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(count)).alias("block"),
            F.xxhash64(F.col(key).cast("string")).alias("key"), F.col(label).cast("int").alias("label"),
            *[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))).alias(f"f{i}") for i, c in enumerate(columns)],
            *[F.col(m).cast("int").alias(f"m{i}") for i, m in enumerate(marks)])
        blocks = shaped.groupBy("block").applyInPandas(
            packed, "block bigint, n bigint, codes binary, labels binary, keys binary, marks binary")
        return cls(cut_lineage(blocks, "blocks"), count, int(facts["n"]), len(columns), int(facts["top"] or 0) + 1, len(marks))

    @staticmethod
    def open(row) -> dict:
        n = int(row["n"])
        return {"codes": np.frombuffer(row["codes"], np.uint8).reshape(n, -1),
                "labels": np.frombuffer(row["labels"], np.uint8).astype(np.int64),
                "keys": np.frombuffer(row["keys"], np.int64).view(np.uint64),
                "marks": np.frombuffer(row["marks"], np.int16).reshape(n, -1)}


def _mixed(x):
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _salt(*numbers) -> np.uint64:
    out = 0
    for number in numbers:
        out = int(_mixed(np.array([(out ^ int(number)) * int(_SALT) % (1 << 64)], dtype=np.uint64))[0])
    return np.uint64(out)


def bag(keys, salt):
    """How often each row is drawn with replacement: Poisson with mean 1, by the row's key."""
    out = np.empty(len(keys), np.uint8)
    for at in range(0, len(keys), _SLICE):
        mixed = _mixed(keys[at:at + _SLICE] ^ salt)
        drawn = _DRAWN[(mixed >> np.uint64(48)).astype(np.intp)]
        unsure = np.flatnonzero(drawn == _UNSURE)
        drawn[unsure] = np.searchsorted(_POISSON, (mixed[unsure] >> np.uint64(11)) * 2.0 ** -53, side="right")
        out[at:at + len(drawn)] = drawn
    return out


# --- trees -------------------------------------------------------------------

class Tree:
    """Nodes as arrays: split feature (-1 for a leaf), last bin that goes left, left child (the right one
    follows it), and the sums of the node's rows."""

    def __init__(self, feature, cut, child, sums):
        self.feature, self.cut, self.child, self.sums = feature, cut, child, sums

    @classmethod
    def root(cls, channels: int) -> "Tree":
        return cls(np.array([-1], np.int16), np.zeros(1, np.int16), np.zeros(1, np.int32), np.zeros((1, channels)))

    def split(self, nodes, found):
        """Split `nodes` as `found` says; the new nodes."""
        totals, good, feature, cut, left = found
        self.sums[nodes] = totals
        nodes, totals, left = nodes[good], totals[good], left[good]
        self.feature[nodes], self.cut[nodes] = feature[good], cut[good]
        first = len(self.feature)
        self.child[nodes] = first + 2 * np.arange(len(nodes))
        fresh = np.empty((2 * len(nodes), totals.shape[1]))
        fresh[0::2], fresh[1::2] = left, totals - left
        self.feature = np.append(self.feature, np.full(len(fresh), -1, np.int16))
        self.cut, self.child = (np.append(x, np.zeros(len(fresh), x.dtype)) for x in (self.cut, self.child))
        self.sums = np.concatenate((self.sums, fresh))
        return np.arange(first, first + len(fresh))

    def step(self, codes, at):
        """Where rows at nodes `at` stand one level below."""
        feature = self.feature[at]
        inner = np.flatnonzero(feature >= 0)
        down = at.copy()
        nodes = at[inner]
        down[inner] = self.child[nodes] + (codes[inner, feature[inner]] > self.cut[nodes])
        return down

    def arrays(self):
        """The tree as plain arrays, to be sent to tasks."""
        return self.feature, self.cut, self.child, self.sums

    def shares(self):
        """Class shares of every node."""
        return self.sums / np.maximum(self.sums.sum(axis=1, keepdims=True), 1e-300)


def histogram(codes, local, nodes: int, channels):
    """(node, feature, bin, channel) sums of `channels` (rows x channels) for rows with a local node."""
    rows = np.flatnonzero(local >= 0)
    features = codes.shape[1]
    cells = (local[rows, None] * features + np.arange(features)) * BINS + codes[rows]
    out = np.empty((nodes * features * BINS, channels.shape[1]))
    for c in range(channels.shape[1]):
        out[:, c] = np.bincount(cells.ravel(), np.repeat(channels[rows, c], features), len(out))
    return out.reshape(nodes, features, BINS, -1)


def class_histogram(codes, local, nodes: int, labels, weights, classes: int):
    """The same for class counts: one pass with the class in the cell."""
    rows = np.flatnonzero((local >= 0) & (weights > 0))
    features = codes.shape[1]
    cells = ((local[rows, None] * features + np.arange(features)) * BINS + codes[rows]) * classes + labels[rows, None]
    met = np.bincount(cells.ravel(), np.repeat(weights[rows], features), nodes * features * BINS * classes)
    return met.reshape(nodes, features, BINS, classes)


def _chosen(features: int, tried: int, salt, nodes):
    """The features tried at every node, in their order."""
    if tried == features:
        return np.broadcast_to(np.arange(features), (len(nodes), features))
    draw = _mixed(salt ^ _mixed((nodes[:, None] * features + np.arange(features)).astype(np.uint64)))
    return np.sort(np.argsort(draw, axis=1, kind="stable")[:, :tried], axis=1)


def best_splits(sums, leaf: int, tried: int, salt, nodes, gradients: bool):
    """(totals, worth it, feature, last bin to the left, sums of the left) of every node.

    Gini for class counts; for gradients (count, gradient, ...) the fall of the squared error."""
    features = sums.shape[1]
    totals = sums[:, 0].sum(axis=1)
    chosen = _chosen(features, tried, salt, nodes)
    if tried < features:
        sums = np.take_along_axis(sums, chosen[:, :, None, None], axis=1)
    left = sums.cumsum(axis=2)[:, :, :-1]
    right = totals[:, None, None, :] - left
    if gradients:
        size = lambda x: x[..., 0]
        worth = lambda x: x[..., 1] ** 2 / np.maximum(x[..., 0], 1)
    else:
        size = lambda x: x.sum(axis=-1)
        worth = lambda x: (x * x).sum(axis=-1) / np.maximum(x.sum(axis=-1), 1)
    gain = worth(left) + worth(right)
    gain[(size(left) < leaf) | (size(right) < leaf)] = -np.inf
    flat = gain.reshape(len(nodes), -1)
    best = flat.argmax(axis=1)
    at = np.arange(len(nodes))
    floor = worth(totals)
    good = flat[at, best] > floor + 1e-9 * np.maximum(1.0, np.abs(floor))
    which, cut = best // left.shape[2], best % left.shape[2]
    return totals, good, chosen[at, which].astype(np.int16), cut.astype(np.int16), left[at, which, cut]


_NODES = 256  # nodes whose splits are compared together


def best_class_splits(sums, leaf: int, chosen):
    """`best_splits` for class counts by (class, tried feature, node, bin): the classes lie apart, so that what is added
    up over them is added up in long rows."""
    nodes = sums.shape[2]
    totals = sums[:, 0].sum(axis=-1)
    worth = lambda x: (x * x).sum(axis=0) / np.maximum(x.sum(axis=0), 1)
    floor, found = worth(totals), []
    for at in range(0, nodes, _NODES):
        some = slice(at, min(at + _NODES, nodes))
        left = sums[:, :, some].cumsum(axis=-1)[..., :-1]
        right = totals[:, None, some, None] - left
        gain = worth(left) + worth(right)
        gain[(left.sum(axis=0) < leaf) | (right.sum(axis=0) < leaf)] = -np.inf
        flat = gain.transpose(1, 0, 2).reshape(some.stop - at, -1)
        best, own = flat.argmax(axis=1), np.arange(some.stop - at)
        which, cut = best // left.shape[-1], best % left.shape[-1]
        found.append((flat[own, best], which, cut, left[:, which, own, cut].T))
    gain, which, cut, left = (np.concatenate(x) for x in zip(*found))
    good = gain > floor + 1e-9 * np.maximum(1.0, np.abs(floor))
    return totals.T, good, chosen[np.arange(nodes), which].astype(np.int16), cut.astype(np.int16), left


# --- plans: which trees, on which rows, read off where -----------------------

@dataclass(frozen=True)
class Run:
    """One model to judge: its ensemble, the fold whose marks name its rows, and the last step it trains on."""

    name: str
    model: Forest | Boosted
    fold: int
    step: int = 0


def _grown_together(runs, features: int):
    """Groups of runs that are read off the same trees: [(largest model, fold, step, runs)].

    Subsets by different rules that try as many features give the same trees."""
    groups = {}
    for run in runs:
        m = run.model
        if isinstance(m, Forest):
            groups.setdefault((m.leaf, m.tried(features), m.bagged, m.seed, run.fold, run.step), []).append(run)
        else:
            groups.setdefault((m, run.fold, run.step), []).append(run)
    out = []
    for same in groups.values():
        model = same[0].model
        if isinstance(model, Forest):
            model = replace(model, trees=max(r.model.trees for r in same), depth=max(r.model.depth for r in same))
        out.append((model, same[0].fold, same[0].step, same))
    return out


def _ends(model, same):
    """Numbers of trees at which a task of a forest ends."""
    ends = {r.model.trees for r in same} | set(range(TREES_A_TASK, model.trees, TREES_A_TASK)) | {model.trees}
    return sorted(ends)


def _training(block, fold, step):
    marks = block["marks"][:, fold]
    return (marks >= 0) & (marks <= step)


def _weights(block, model, fold, step, number):
    drawn = bag(block["keys"], _salt(model.seed, number)) if model.bagged else 1
    return np.where(_training(block, fold, step), drawn, 0).astype(np.float64)


def grow_tree(block, model: Forest, fold, step, number, tried, classes, visit):
    """One tree on one block, calling `visit(level, tree, node of every row)` for every level."""
    codes, weights = block["codes"], _weights(block, model, fold, step, number)
    tree, at, frontier = Tree.root(classes), np.zeros(len(codes), np.int64), np.zeros(1, np.int64)
    tree.sums[0] = np.bincount(block["labels"], weights, classes)
    visit(0, tree, at)
    for level in range(model.depth):
        if len(frontier):
            local = np.full(len(tree.feature), -1)
            local[frontier] = np.arange(len(frontier))
            sums = class_histogram(codes, local[at], len(frontier), block["labels"], weights, classes)
            found = best_splits(sums, model.leaf, tried, _salt(model.seed, number, 1), frontier, False)
            frontier = tree.split(frontier, found)
            at = tree.step(codes, at)
        visit(level + 1, tree, at)
    return tree


def confusion(scores, labels, classes: int):
    """Counts of (label, class of the highest score), the smaller class on ties."""
    return np.bincount(labels * classes + scores.argmax(axis=1), minlength=classes * classes)


def _judged(block, fold, step):
    """Rows to judge, by kind."""
    return {"validation": block["marks"][:, fold] == -1, "train": _training(block, fold, step)}


class _Sums:
    """Class shares added up per depth, for the rows to judge of one block."""

    def __init__(self, block, fold, step, depths, classes):
        self.rows = np.flatnonzero(np.logical_or.reduce(list(_judged(block, fold, step).values())))
        self.sums = {d: np.zeros((len(self.rows), classes)) for d in depths}

    def visit(self, level, tree, at):
        if level in self.sums:
            self.sums[level] += tree.shares()[at[self.rows]]


# --- growing: one block a task, or a pass per level --------------------------

_PART = "grp int, upto int, depth int, block bigint, scores binary"


def _dealt(blocks: Blocks, tasks: int) -> DataFrame:
    """Every block beside every task number: the two are spread over the cluster together."""
    wide = blocks.rows.withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))))
    return wide.repartition(tasks * blocks.count)


def _forest_parts(blocks: Blocks, groups) -> DataFrame:
    """Summed class shares of the judged rows of a single block, per (group, task, depth): every task grows its trees."""
    tasks = []
    for g, (model, _, _, same) in enumerate(groups):
        if isinstance(model, Forest):
            ends = _ends(model, same)
            tasks += [(g, a, b) for a, b in zip([0, *ends], ends)]
    classes, features, opened = blocks.classes, blocks.features, blocks.open

    def run(batches):
        for batch in batches:
            for row in batch.to_dict("records"):
                g, first, upto = tasks[row["task"]]
                block, (model, fold, step, same) = opened(row), groups[g]
                sums = _Sums(block, fold, step, {r.model.depth for r in same}, classes)
                for number in range(first, upto):
                    grow_tree(block, model, fold, step, number, model.tried(features), classes, sums.visit)
                yield pd.DataFrame([(g, upto, d, row["block"], s.tobytes()) for d, s in sums.sums.items()],
                                   columns=["grp", "upto", "depth", "block", "scores"])

    return _dealt(blocks, len(tasks)).mapInPandas(run, _PART)


def _drawn(block, model: Forest, fold, step, number):
    """The rows of a block that a tree is grown on."""
    rows = np.flatnonzero(_weights(block, model, fold, step, number))
    return {name: values[rows] for name, values in block.items()}


_TREE = "grp int, number int, feature binary, cut binary, child binary, sums binary"


def _gathered(blocks: Blocks, tasks: int, task: str = "task"):
    """Every block beside every task number, the blocks of a task together."""
    wide = blocks.rows.withColumn(task, F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))))
    return wide.repartitionByRange(tasks, task).groupBy(task)


class Cells:
    """The rows that a group trains on or judges, added up by their bins: a cell is a combination of bins that occurs.

    `counts` are the rows by (cell, class) of either kind. The keys of the training rows, which decide their draws, are
    kept in the order of cell and class."""

    def __init__(self, blocks, fold: int, step: int, classes: int):
        """`blocks` are rows of `Blocks`, in any order."""
        parts = []
        for row in blocks:
            block = Blocks.open(row)
            kinds = _judged(block, fold, step)
            rows = np.flatnonzero(kinds["validation"] | kinds["train"])
            parts.append((block["codes"][rows], block["labels"][rows].astype(np.uint8), block["keys"][rows], kinds["train"][rows]))
        codes, labels, keys, training = (np.concatenate(x) for x in zip(*parts))
        self.codes, slots = self.distinct(codes)
        slots *= classes
        slots += labels
        size, asked = len(self.codes) * classes, slots[~training]
        self.classes, self.columns, self.flat = classes, np.ascontiguousarray(self.codes.T), self.codes.ravel()
        keys, slots = keys[training], slots[training]
        order = np.argsort(slots, kind="stable")
        self.keys, slots = keys[order], slots[order]
        self.first = np.flatnonzero(np.diff(slots, prepend=-1))
        self.slots = slots[self.first]
        self.counts = {"validation": np.bincount(asked, minlength=size).reshape(-1, classes),
                       "train": np.bincount(slots, minlength=size).reshape(-1, classes)}

    @staticmethod
    def distinct(codes):
        """(distinct rows of `codes`, the number of each row's)."""
        ids = first = np.zeros(len(codes), np.int64)
        for at in range(0, codes.shape[1], 7):
            for column in codes[:, at:at + 7].T:
                ids = ids * BINS + column
            _, first, ids = np.unique(ids, return_index=True, return_inverse=True)
        return np.ascontiguousarray(codes[first]), ids.astype(np.int64)

    def weights(self, model: Forest, number: int):
        """Draws of a tree by (class, cell)."""
        out = self.counts["train"].astype(np.float64)
        if model.bagged and len(self.first):
            out.ravel()[self.slots] = np.add.reduceat(bag(self.keys, _salt(model.seed, number)), self.first, dtype=np.int64)
        return np.ascontiguousarray(out.T)


def _descended(cells: Cells, live, local, good, feature, cut):
    """The cells whose nodes were split, the places of their new nodes among these, and which cells these are of `live`."""
    down = slice(None) if good.all() else np.flatnonzero(good.take(local))
    live, local = live[down], local[down]
    right = cells.flat.take(live * len(cells.columns) + feature.take(local)) > cut.take(local)
    return live, (2 * (np.cumsum(good) - 1)).take(local) + right, down


def _class_sums(index, weights, cells: int, most: float):
    """Sums of whole `weights` (class, row) by `index`. No sum is over `most`, so several fit side by side in the 52 bits
    of a number and are added up at once."""
    bits = int(most).bit_length()
    together, out = max(1, 52 // max(1, bits)), []
    for at in range(0, len(weights), together):
        some = weights[at:at + together]
        packed = some[-1]
        for values in some[-2::-1]:
            packed = packed * float(1 << bits) + values
        met = np.bincount(index, packed, cells)
        if len(some) == 1:
            out.append(met)
            continue
        met = met.astype(np.int64)
        for _ in some:
            out.append((met & ((1 << bits) - 1)).astype(np.float64))
            met >>= bits
    return out


def grow_on_cells(cells: Cells, model: Forest, number, visit):
    """`grow_tree` on cells; `visit(level, tree, node of every cell)`."""
    features, classes, weights = len(cells.columns), cells.classes, cells.weights(model, number)
    tried, salt = model.tried(features), _salt(model.seed, number, 1)
    tree, frontier = Tree.root(classes), np.zeros(1, np.int64)
    tree.sums[0] = weights.sum(axis=1)
    at, live = np.zeros(len(cells.codes), np.int64), np.arange(len(cells.codes))
    local = at.copy()
    visit(0, tree, at)
    for level in range(model.depth):
        if len(frontier):
            chosen = _chosen(features, tried, salt, frontier)
            sums = np.empty((classes, tried, len(frontier), BINS))
            own, start, most = live * features, local * BINS, tree.sums[frontier].max()
            for t in range(tried):
                index = start + cells.flat.take(own + np.ascontiguousarray(chosen[:, t]).take(local))
                sums[:, t] = np.reshape(_class_sums(index, weights, len(frontier) * BINS, most), (classes, -1, BINS))
            found = best_class_splits(sums, model.leaf, chosen)
            frontier = tree.split(frontier, found)
            live, local, down = _descended(cells, live, local, *found[1:4])
            weights = [values[down] for values in weights]
            if len(frontier):
                at[live] = frontier[0] + local
        visit(level + 1, tree, at)
    return tree


def _cell_counts(cells: Cells, scores):
    """{kind: confusion counts} of all rows by the scores of their cells."""
    said = scores.argmax(axis=1)
    return {kind: np.concatenate([np.bincount(said, counts[:, c], cells.classes) for c in range(cells.classes)])
            for kind, counts in cells.counts.items()}


def _forest_counts(cells: Cells, model: Forest, same, numbers):
    """Confusion counts of a group's runs. Shares are added up by the ranges of `_ends`, and trees grown no deeper than
    the runs that are read off them ask for."""
    most, out, shape = {}, [], (len(cells.codes), cells.classes)
    for run in same:
        most[run.model.depth] = max(run.model.trees, most.get(run.model.depth, 0))
    total, ends = {depth: np.zeros(shape) for depth in most}, _ends(model, same)
    for first, upto in zip([0, *ends], ends):
        part = {depth: np.zeros(shape) for depth, trees in most.items() if trees >= upto}

        def visit(level, tree, at):
            if level in part:
                part[level] += tree.shares()[at]

        for number in range(first, upto):
            grow_on_cells(cells, replace(model, depth=max(part)), number, visit)
        for depth, shares in part.items():
            total[depth] += shares
            for run in same:
                if (run.model.trees, run.model.depth) == (upto, depth):
                    for kind, counts in _cell_counts(cells, total[depth]).items():
                        out += _cells(numbers[run], kind, counts, cells.classes)
    return out


def _whole_results(blocks: Blocks, runs, groups, which) -> DataFrame:
    """Confusion counts of the groups `which`: a task gathers the binned rows of a group, grows its trees and judges them."""
    which = sorted(which, key=lambda g: -groups[g][0].depth * getattr(groups[g][0], "trees", 0))  # the longest first
    numbers, classes = {r: n for n, r in enumerate(runs)}, blocks.classes

    def counted(rows: pd.DataFrame) -> pd.DataFrame:
        model, fold, step, same = groups[which[int(rows["task"].iloc[0])]]
        cells = Cells(rows.to_dict("records"), fold, step, classes)
        if isinstance(model, Forest):
            out = _forest_counts(cells, model, same, numbers)
        else:
            found = _cell_counts(cells, boost_cells(cells, model))
            out = [cell for run in same for kind, counts in found.items() for cell in _cells(numbers[run], kind, counts, classes)]
        return pd.DataFrame(out, columns=["run", "kind", "label", "prediction", "n"])

    return _gathered(blocks, len(which)).applyInPandas(counted, _JUDGED)


def _level_trees(blocks: Blocks, groups, wave):
    """The same, a pass over all blocks per level: a task adds up a range of trees on one block."""
    spark, classes, features, opened = blocks.rows.sparkSession, blocks.classes, blocks.features, blocks.open
    trees = {(g, i): Tree.root(classes) for g in wave for i in range(groups[g][0].trees)}
    frontier = {job: np.zeros(1, np.int64) for job in trees}
    for level in range(max(groups[g][0].depth for g in wave)):
        jobs = sorted(job for job in trees if len(frontier[job]) and level < groups[job[0]][0].depth)
        if not jobs:
            break
        shared = spark.sparkContext.broadcast((jobs, {j: (*trees[j].arrays()[:3], None) for j in jobs}, {j: frontier[j] for j in jobs}))

        def added(batches):
            jobs, now, open_ = shared.value
            for batch in batches:
                for row in batch.to_dict("records"):
                    block, first = opened(row), row["task"] * TREES_A_TASK
                    for n, job in enumerate(jobs[first:first + TREES_A_TASK], first):
                        model, fold, step, _ = groups[job[0]]
                        some, tree = _drawn(block, model, fold, step, job[1]), Tree(*now[job])
                        at = np.zeros(len(some["codes"]), np.int64)
                        for _ in range(level):
                            at = tree.step(some["codes"], at)
                        local = np.full(len(tree.feature), -1)
                        local[open_[job]] = np.arange(len(open_[job]))
                        sums = class_histogram(some["codes"], local[at], len(open_[job]), some["labels"],
                                               _weights(some, model, fold, step, job[1]), classes).ravel()
                        cells = np.flatnonzero(sums)
                        yield pd.DataFrame({"job": [n], "cells": [cells.tobytes()], "sums": [sums[cells].tobytes()]})

        def chosen(parts: pd.DataFrame) -> pd.DataFrame:
            jobs, _, open_ = shared.value
            job = jobs[int(parts["job"].iloc[0])]
            model, nodes = groups[job[0]][0], open_[job]
            sums = np.zeros(len(nodes) * features * BINS * classes)
            for cells, values in zip(parts["cells"], parts["sums"]):
                sums[np.frombuffer(cells, np.int64)] += np.frombuffer(values)
            found = best_splits(sums.reshape(len(nodes), features, BINS, classes), model.leaf, model.tried(features),
                                _salt(model.seed, job[1], 1), nodes, False)
            return pd.DataFrame({"job": [int(parts["job"].iloc[0])], **{f"x{i}": [x.tobytes()] for i, x in enumerate(found)}})

        splits = _dealt(blocks, -(-len(jobs) // TREES_A_TASK)).mapInPandas(
            added, "job int, cells binary, sums binary").groupBy("job").applyInPandas(
            chosen, "job int, x0 binary, x1 binary, x2 binary, x3 binary, x4 binary")
        for row in splits.collect():  # one row a tree: the model itself
            job = jobs[row["job"]]
            found = (np.frombuffer(row["x0"]).reshape(-1, classes), np.frombuffer(row["x1"], bool),
                     np.frombuffer(row["x2"], np.int16), np.frombuffer(row["x3"], np.int16),
                     np.frombuffer(row["x4"]).reshape(-1, classes))
            frontier[job] = trees[job].split(frontier[job], found)
        shared.unpersist()
    return trees


def _read_off(block, model, same, fold, step, trees, numbers, classes):
    """Confusion counts of a group's runs on one block: the shares are added up by the ranges of `_ends`, as where a
    task grows a range."""
    kinds, out = _judged(block, fold, step), []
    rows = np.flatnonzero(np.logical_or.reduce(list(kinds.values())))
    labels, kinds = block["labels"][rows], {kind: mask[rows] for kind, mask in kinds.items()}
    codes = np.ascontiguousarray(block["codes"][rows])
    flat, start = codes.ravel(), np.arange(len(rows)) * codes.shape[1]
    most = {}
    for run in same:
        most[run.model.depth] = max(run.model.trees, most.get(run.model.depth, 0))
    total = {depth: np.zeros((len(rows), classes)) for depth in most}
    ends = _ends(model, same)
    for first, upto in zip([0, *ends], ends):
        part = {depth: np.zeros((len(rows), classes)) for depth, trees_of in most.items() if trees_of >= upto}
        for number in range(first, upto):
            tree = trees[number]
            # a leaf leads to itself
            leaf = tree.feature < 0
            feature, cut = np.where(leaf, 0, tree.feature), np.where(leaf, BINS, tree.cut)
            child = np.where(leaf, np.arange(len(leaf)), tree.child)
            at, shares = np.zeros(len(rows), np.int64), tree.shares()
            for level in range(max(part) + 1):
                if level:
                    at = child[at] + (flat[start + feature[at]] > cut[at])
                if level in part:
                    part[level] += shares[at]
        for depth, shares in part.items():
            total[depth] += shares
            for run in same:
                if (run.model.trees, run.model.depth) == (upto, depth):
                    for kind, some in kinds.items():
                        out += _cells(numbers[run], kind, confusion(total[depth][some], labels[some], classes), classes)
    return out


def _waves(groups, forests):
    """Yields lists of groups to grow together and takes back the trees of each: nodes a tree are judged by those before."""
    waiting, nodes = list(forests), None
    while waiting:
        some = 24 * TREES_A_TASK if nodes is None else max(1, WAVE_NODES // nodes)
        wave = [waiting.pop(0)]
        while waiting and sum(groups[g][0].trees for g in [*wave, waiting[0]]) <= some:
            wave.append(waiting.pop(0))
        trees = yield wave
        nodes = max(1, sum(len(tree.feature) for tree in trees.values()) // len(trees))


def _wide_results(blocks: Blocks, runs, groups, forests) -> DataFrame:
    """Confusion counts of all forests over more blocks than a task keeps. Trees are grown in waves of bounded size, and a wave's trees
    are read off by tasks of one group and one block before the next is grown."""
    spark, classes, opened = blocks.rows.sparkSession, blocks.classes, blocks.open
    numbers, met, waves, trees = {r: n for n, r in enumerate(runs)}, [], _waves(groups, forests), None
    while True:
        try:
            wave = waves.send(trees)
        except StopIteration:
            break
        trees = _level_trees(blocks, groups, wave)
        shared = spark.sparkContext.broadcast({job: tree.arrays() for job, tree in trees.items()})

        def judged(batches):
            for batch in batches:
                for row in batch.to_dict("records"):
                    g = wave[row["task"]]
                    model, fold, step, same = groups[g]
                    mine = {i: Tree(*shared.value[g, i]) for i in range(model.trees)}
                    yield pd.DataFrame(_read_off(opened(row), model, same, fold, step, mine, numbers, classes),
                                       columns=["run", "kind", "label", "prediction", "n"])

        counts = _dealt(blocks, len(wave)).mapInPandas(judged, _JUDGED).groupBy("run", "kind", "label", "prediction").agg(
            F.sum("n").alias("n"))
        met += [tuple(row) for row in counts.collect()]  # a few rows a run
        shared.unpersist()
    return spark.createDataFrame(met, _JUDGED)


_JUDGED = "run int, kind string, label int, prediction int, n bigint"


def _cells(run, kind, counts, classes):
    return [(run, kind, i // classes, i % classes, int(n)) for i, n in enumerate(counts) if n]


def _forest_results(blocks: Blocks, runs, groups) -> DataFrame:
    """Confusion counts of all forests: the tasks' sums of a block are added in the order of their trees."""
    forests = [g for g, (model, *_) in enumerate(groups) if isinstance(model, Forest)]
    if blocks.count > 1 and blocks.n <= TREE_ROWS:
        return _whole_results(blocks, runs, groups, forests)
    if blocks.count > 1:
        return _wide_results(blocks, runs, groups, forests)
    parts = _forest_parts(blocks, groups)
    numbers, opened, classes = {r: n for n, r in enumerate(runs)}, blocks.open, blocks.classes

    def judged(key, scores: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(scores):
            block, (model, fold, step, same) = opened(block.iloc[0]), groups[int(key[0])]
            kinds = _judged(block, fold, step)
            rows = np.flatnonzero(np.logical_or.reduce(list(kinds.values())))
            for depth, of_depth in scores.sort_values("upto").groupby("depth"):
                total = np.zeros((len(rows), classes))
                for upto, part in zip(of_depth["upto"], of_depth["scores"]):
                    total += np.frombuffer(part).reshape(-1, classes)
                    for run in same:
                        if (run.model.trees, run.model.depth) == (upto, depth):
                            for kind, mask in kinds.items():
                                some = mask[rows]
                                out += _cells(numbers[run], kind, confusion(total[some], block["labels"][rows][some], classes), classes)
        return pd.DataFrame(out, columns=["run", "kind", "label", "prediction", "n"])

    wide = blocks.rows.withColumn("grp", F.explode(F.array(*map(F.lit, forests))))
    return parts.groupBy("grp", "block").cogroup(wide.groupBy("grp", "block")).applyInPandas(judged, _JUDGED)


# --- softmax boosting --------------------------------------------------------

def _whole(x):
    """Fixed point, so that sums do not depend on their order."""
    return np.rint(x * _POINT)


def first_scores(labels, classes: int):
    """Log of the class shares."""
    met = np.asarray(labels, dtype=np.float64)
    return np.log(np.maximum(met, 1e-9) / max(met.sum(), 1.0)) if len(met) == classes else np.zeros(classes)


def _softmax(scores):
    p = np.exp(scores - scores.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    return p


def residuals(scores, labels, classes: int):
    """(residual, weight of the leaf's denominator) per row and class, shared by a round's trees."""
    p = _softmax(scores)
    gap = (labels[:, None] == np.arange(classes)) - p
    return _whole(gap), _whole(np.abs(gap) * (1 - np.abs(gap)))


def _gradient_sums(block, training, tree, frontier, level, gap, bend):
    at = np.zeros(len(block["codes"]), np.int64)
    for _ in range(level):
        at = tree.step(block["codes"], at)
    local = np.full(len(tree.feature), -1)
    local[frontier] = np.arange(len(frontier))
    channels = np.stack((np.ones(len(gap)), gap, bend), axis=1)
    return histogram(block["codes"], np.where(training, local[at], -1), len(frontier), channels)


def leaf_values(tree, model: Boosted, classes: int):
    return model.rate * (classes - 1) / classes * tree.sums[:, 1] / np.maximum(tree.sums[:, 2], 1e-6 * _POINT)


def raised(block, scores, trees, model: Boosted, classes: int):
    """`scores` with a round's trees, one a class."""
    out = scores.copy()
    for k, tree in enumerate(trees):
        at = np.zeros(len(block["codes"]), np.int64)
        for _ in range(model.depth):
            at = tree.step(block["codes"], at)
        out[:, k] += leaf_values(tree, model, classes)[at]
    return out


def boost(block, model: Boosted, fold, step, classes, visit=lambda number, scores: None):
    """Scores of all rows of one block after all rounds, `visit`ed after every round."""
    training = _training(block, fold, step)
    start = first_scores(np.bincount(block["labels"][training], minlength=classes), classes)
    scores = np.tile(start, (len(training), 1))
    visit(0, scores)
    for number in range(model.rounds):
        gap, bend = residuals(scores, block["labels"], classes)
        trees = []
        for k in range(classes):
            tree, frontier = Tree.root(3), np.zeros(1, np.int64)
            for level in range(model.depth):
                if len(frontier):
                    sums = _gradient_sums(block, training, tree, frontier, level, gap[:, k], bend[:, k])
                    frontier = tree.split(frontier, best_splits(
                        sums, model.leaf, sums.shape[1], np.uint64(0), frontier, True))
            trees.append(tree)
        scores = raised(block, scores, trees, model, classes)
        visit(number + 1, scores)
    return scores


def boost_cells(cells: Cells, model: Boosted):
    """Scores of all cells after all rounds: `boost`, with the sums of a cell's training rows in fixed point."""
    counts, classes = cells.counts["train"].astype(np.float64), cells.classes
    size, scores = counts.sum(axis=1), np.tile(first_scores(counts.sum(axis=0), classes), (len(counts), 1))
    for _ in range(model.rounds):
        p, trees = _softmax(scores), []
        for k in range(classes):
            own, others, up, down = counts[:, k], size - counts[:, k], 1 - p[:, k], p[:, k]
            channels = (size, own * _whole(up) - others * _whole(down),
                        own * _whole(up * (1 - up)) + others * _whole(down * (1 - down)))
            tree, frontier = Tree.root(3), np.zeros(1, np.int64)
            at, live = np.zeros(len(size), np.int64), np.arange(len(size))
            local = at.copy()
            for level in range(model.depth):
                if len(frontier):
                    sums = np.empty((len(frontier), len(cells.columns), BINS, 3))
                    for f, column in enumerate(cells.columns):
                        index = local * BINS + (column if len(live) == len(column) else column[live])
                        for c, values in enumerate(channels):
                            sums[:, f, :, c] = np.bincount(index, values, len(frontier) * BINS).reshape(-1, BINS)
                    found = best_splits(sums, model.leaf, len(cells.columns), np.uint64(0), frontier, True)
                    frontier = tree.split(frontier, found)
                    live, local, kept = _descended(cells, live, local, *found[1:4])
                    channels = [values[kept] for values in channels]
                    if len(frontier):
                        at[live] = frontier[0] + local
            trees.append((tree, at))
        for k, (tree, at) in enumerate(trees):
            scores[:, k] += leaf_values(tree, model, classes)[at]
    return scores


_CARRIED = 10  # rounds between two writings of the rows' scores


def _wide_boosted(blocks: Blocks, boosted):
    """The state (task, block, scores) of every block after all rounds, a pass over all blocks per level.

    `boosted` are (group, model, fold, step); scores are written every `_CARRIED` rounds, and rows add the trees since."""
    spark, classes, features, opened = blocks.rows.sparkSession, blocks.classes, blocks.features, blocks.open

    def counted(batches):
        for batch in batches:
            for row in batch.to_dict("records"):
                block = opened(row)
                yield pd.DataFrame([(t, k, int(n)) for t, (_, _, fold, step) in enumerate(boosted) for k, n in enumerate(
                    np.bincount(block["labels"][_training(block, fold, step)], minlength=classes))],
                    columns=["task", "label", "n"])

    met = blocks.rows.mapInPandas(counted, "task int, label int, n bigint").groupBy("task", "label").agg(F.sum("n").alias("n"))
    counts = np.zeros((len(boosted), classes))
    for row in met.collect():
        counts[row["task"], row["label"]] = row["n"]
    starts = [first_scores(c, classes) for c in counts]
    shape = "task int, block bigint, n bigint, codes binary, labels binary, keys binary, marks binary, scores binary"
    names = [field.split()[0] for field in shape.split(", ")]

    def carried(pending, begin):
        def run(batches):
            for batch in batches:
                for row in batch.to_dict("records"):
                    block, model = opened(row), boosted[row["task"]][1]
                    scores = (np.tile(starts[row["task"]], (len(block["labels"]), 1)) if begin
                              else np.frombuffer(row["scores"]).reshape(-1, classes))
                    for trees in pending.value[row["task"]]:
                        scores = raised(block, scores, trees, model, classes)
                    yield pd.DataFrame([[row[n] for n in names[:-1]] + [scores.tobytes()]], columns=names)
        return run

    none = spark.sparkContext.broadcast([[] for _ in boosted])
    state = cut_lineage(_dealt(blocks, len(boosted)).mapInPandas(carried(none, True), shape), "boosting")
    pending = [[] for _ in boosted]
    for number in range(max(model.rounds for _, model, _, _ in boosted)):
        live = [t for t, (_, model, _, _) in enumerate(boosted) if number < model.rounds]
        trees = {(t, k): Tree.root(3) for t in live for k in range(classes)}
        frontier = {job: np.zeros(1, np.int64) for job in trees}
        for level in range(max(boosted[t][1].depth for t in live)):
            jobs = [j for j in sorted(trees) if len(frontier[j]) and level < boosted[j[0]][1].depth]
            if not jobs:
                break
            shared = spark.sparkContext.broadcast((jobs, trees, frontier, pending))

            def added(batches):
                jobs, trees, frontier, pending = shared.value
                for batch in batches:
                    for row in batch.to_dict("records"):
                        block, (_, model, fold, step) = opened(row), boosted[row["task"]]
                        scores = np.frombuffer(row["scores"]).reshape(-1, classes)
                        for done in pending[row["task"]]:
                            scores = raised(block, scores, done, model, classes)
                        gap, bend = residuals(scores, block["labels"], classes)
                        training, out = _training(block, fold, step), []
                        for n, job in enumerate(jobs):
                            if job[0] == row["task"]:
                                sums = _gradient_sums(block, training, trees[job], frontier[job], level, gap[:, job[1]], bend[:, job[1]])
                                out.append((n, sums.tobytes()))
                        yield pd.DataFrame(out, columns=["job", "sums"])

            def chosen(parts: pd.DataFrame) -> pd.DataFrame:
                jobs, _, frontier, _ = shared.value
                job = jobs[int(parts["job"].iloc[0])]
                sums = sum(np.frombuffer(x).astype(np.int64) for x in parts["sums"]).astype(np.float64)
                found = best_splits(sums.reshape(len(frontier[job]), features, BINS, 3), boosted[job[0]][1].leaf, features,
                                    np.uint64(0), frontier[job], True)
                return pd.DataFrame({"job": [int(parts["job"].iloc[0])], **{f"x{i}": [x.tobytes()] for i, x in enumerate(found)}})

            splits = state.mapInPandas(added, "job int, sums binary").groupBy("job").applyInPandas(
                chosen, "job int, x0 binary, x1 binary, x2 binary, x3 binary, x4 binary")
            for row in splits.collect():  # one row a tree
                job = jobs[row["job"]]
                frontier[job] = trees[job].split(frontier[job], (
                    np.frombuffer(row["x0"]).reshape(-1, 3), np.frombuffer(row["x1"], bool), np.frombuffer(row["x2"], np.int16),
                    np.frombuffer(row["x3"], np.int16), np.frombuffer(row["x4"]).reshape(-1, 3)))
        for t in live:
            pending[t].append([trees[t, k] for k in range(classes)])
        if (number + 1) % _CARRIED == 0:
            state = cut_lineage(state.mapInPandas(carried(spark.sparkContext.broadcast(pending), False), shape), "boosting")
            pending = [[] for _ in boosted]
    return state.mapInPandas(carried(spark.sparkContext.broadcast(pending), False), shape)


def _boosted_results(blocks: Blocks, runs, groups) -> DataFrame:
    boosted = [(g, model, fold, step) for g, (model, fold, step, _) in enumerate(groups) if isinstance(model, Boosted)]
    numbers, opened, classes, single = {r: n for n, r in enumerate(runs)}, blocks.open, blocks.classes, blocks.count == 1

    def counted(block, task, scores):
        (g, _, fold, step), out = boosted[task], []
        for kind, mask in _judged(block, fold, step).items():
            counts = confusion(scores[mask], block["labels"][mask], classes)
            for of in groups[g][3]:
                out += _cells(numbers[of], kind, counts, classes)
        return pd.DataFrame(out, columns=["run", "kind", "label", "prediction", "n"])

    if not single and blocks.n <= BOOSTED_ROWS:
        return _whole_results(blocks, runs, groups, [g for g, *_ in boosted])
    state = _dealt(blocks, len(boosted)) if single else _wide_boosted(blocks, boosted)

    def run(batches):
        for batch in batches:
            for row in batch.to_dict("records"):
                block = opened(row)
                yield counted(block, row["task"], boost(block, *boosted[row["task"]][1:], classes) if single
                              else np.frombuffer(row["scores"]).reshape(-1, classes))

    return state.mapInPandas(run, _JUDGED)


# --- results -----------------------------------------------------------------

def judge(blocks: Blocks, runs) -> DataFrame:
    """(run, kind, label, prediction, n): confusion counts of every run, a number in the list `runs`, on its
    validation rows and on its training rows."""
    runs = list(dict.fromkeys(runs))
    groups = _grown_together(runs, blocks.features)
    parts = []
    if any(isinstance(r.model, Forest) for r in runs):
        parts.append(_forest_results(blocks, runs, groups))
    if any(isinstance(r.model, Boosted) for r in runs):
        parts.append(_boosted_results(blocks, runs, groups))
    whole = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return whole.groupBy("run", "kind", "label", "prediction").agg(F.sum("n").alias("n"))


def quality(counts) -> tuple[float, float]:
    """(accuracy, F1 weighted by class size) of {(label, prediction): n}."""
    total, right, weighted = sum(counts.values()), 0, 0.0
    for k in {label for label, _ in counts}:
        hit = counts.get((k, k), 0)
        truth, said = (sum(n for pair, n in counts.items() if pair[side] == k) for side in (0, 1))
        right += hit
        weighted += truth * 2 * hit / (truth + said)
    return (right / total, weighted / total) if total else (0.0, 0.0)


def scores(blocks: Blocks, runs) -> dict:
    """{run: {kind: (accuracy, weighted F1, rows)}}."""
    runs, met = list(dict.fromkeys(runs)), {}
    for row in judge(blocks, runs).collect():  # a few rows a run
        met.setdefault(row["run"], {}).setdefault(row["kind"], {})[row["label"], row["prediction"]] = row["n"]
    return {run: {kind: (*quality(counts), sum(counts.values())) for kind, counts in met.get(n, {}).items()}
            for n, run in enumerate(runs)}
