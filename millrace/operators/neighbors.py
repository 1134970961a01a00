"""Exact k nearest neighbours of many queries among many rows.

The rows are placed around pivots, whose number follows the data: a row goes to the nearest of a few top pivots
and then to the nearest pivot that belongs to that one, so placing it compares it with about twice the root of
their number. Every pivot's rows are cut into blocks of bounded size. By the triangle inequality a
query needs only the blocks that can hold one of its k nearest rows, so queries are sent to those blocks alone,
and a block is copied only to as many chunks as the queries that ask for it need. A block meets its
chunk in one matrix product; what may be among the k nearest by that is measured again exactly. Each group gives
at most k rows per query; the last step merges them.

In few dimensions (`BOX_DIMENSIONS`) the rows are placed in the cells of a tree of median cuts instead, whose boxes
rule out far more. A query first bounds its k-th distance in its own cell and is then sent to the cells whose boxes
come as near as that. Neither way changes what is found.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.session import cut_lineage

BLOCK_ROWS = 50_000
CHUNK_ROWS = 50_000
ROWS_A_PIVOT = 1 << 13
FEWEST_PIVOTS, MOST_PIVOTS = 32, 4096  # the most are kept on the driver and sent to every task
BOX_DIMENSIONS = 8  # up to so many, rows are placed in boxes
ROWS_A_BOX, MOST_BOXES = 1 << 11, 1 << 12
_SEEN_A_BOX = 16  # rows the driver looks at, a box, to choose its cuts
_SLACK = 1e-9  # room for rounding when blocks are ruled out
_TOGETHER = 1 << 22  # distances held at once
_PAIRS = 1 << 18  # pairs measured exactly at once, but for one query's


def _distances(points, centre):
    gap = points - centre
    return np.sqrt(np.einsum("ij,ij->i", gap, gap))


def _all_distances(points, centres):
    """Squared distances of all points to all centres by one matrix product: near the true ones."""
    squares = np.einsum("ij,ij->i", points, points)[:, None] + np.einsum("ij,ij->i", centres, centres)[None]
    return np.maximum(squares - 2 * points @ centres.T, 0)


def _matrix(vectors):
    return np.stack(vectors.to_numpy()).astype(float)


class PivotTree:
    """Pivots, the first rows of a fixed digest order, below the first few of them."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots
        tops = max(1, int(np.ceil(np.sqrt(len(pivots)))))
        self.tops = pivots[:tops]
        owner = _all_distances(pivots, self.tops).argmin(axis=1)
        owner[:tops] = np.arange(tops)
        self.members = [np.flatnonzero(owner == t) for t in range(tops)]

    @classmethod
    def of(cls, train: DataFrame, count: int) -> "PivotTree | None":
        """A tree over `count` rows of (id, v): a bounded number on the driver."""
        rows = train.orderBy(F.xxhash64("id"), "id").limit(count).select("v").collect()
        return cls(np.array([list(row[0]) for row in rows], dtype=float)) if rows else None

    def place(self, points):
        """(pivot, distance to it) of every point."""
        top = _all_distances(points, self.tops).argmin(axis=1)
        cell = np.empty(len(points), dtype=np.int64)
        for t in np.unique(top):
            mine = top == t
            cell[mine] = self.members[t][_all_distances(points[mine], self.pivots[self.members[t]]).argmin(axis=1)]
        return cell, _distances(points, self.pivots[cell])


def knn_topk(train: DataFrame, queries: DataFrame, k: int = 5, key: str = "id", vector: str = "features",
             pivots: int | None = None, block_rows: int = BLOCK_ROWS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(query_id, neighbor_id, distance, rank): the k nearest training rows of every query.

    Euclidean distance, ties by id. Fewer than k rows come back only when the
    training set is smaller than k.
    """
    train = train.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    queries = queries.select(F.col(key).alias("query_id"), F.col(vector).cast("array<double>").alias("v"))
    id_type, query_type = dict(train.dtypes)["id"], dict(queries.dtypes)["query_id"]
    boxes = None
    if pivots is None:
        n = train.count()
        pivots = min(MOST_PIVOTS, max(FEWEST_PIVOTS, -(-n // ROWS_A_PIVOT)))
        boxes = BoxTree.of(train, n)
    tree = PivotTree.of(train, pivots) if boxes is None else None
    if tree is None and boxes is None:
        return queries.sparkSession.createDataFrame(
            [], f"query_id {query_type}, neighbor_id {id_type}, distance double, rank int")
    if boxes is not None:
        return _nearest(_boxed(train, queries, boxes, k, block_rows, chunk_rows), k)
    blocks, routed = _met(train, queries, tree, k, block_rows, chunk_rows)

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "neighbor_id": [], "distance": []})
        if not len(left) or not len(right):
            return empty
        left = left.sort_values("id", kind="stable")
        points, ids, asked = _matrix(left["v"]), left["id"].to_numpy(), _matrix(right["v"])
        longest = float(np.einsum("ij,ij->i", points, points).max())
        near_ids, near_distances, sizes = [], [], []
        step = max(1, _TOGETHER // len(points))
        for at in range(0, len(asked), step):
            some = asked[at:at + step]
            squares = _all_distances(some, points)
            last = min(k, len(points)) - 1
            limit = np.partition(squares, last, axis=1)[:, last]
            limit += 1e-9 * (np.einsum("ij,ij->i", some, some) + longest)  # more than the product's rounding
            for query, row, most in zip(some, squares, limit):
                maybe = np.flatnonzero(row <= most)
                distance = _distances(points[maybe], query)
                # rows are in id order, so a stable sort breaks ties by id
                best = np.argsort(distance, kind="stable")[:k]
                near_ids.append(ids[maybe[best]])
                near_distances.append(distance[best])
                sizes.append(len(best))
        return pd.DataFrame({"query_id": np.repeat(right["query_id"].to_numpy(), sizes),
                             "neighbor_id": np.concatenate(near_ids),
                             "distance": np.concatenate(near_distances)})

    where = ["cell", "part", "chunk"]
    partial = blocks.groupBy(*where).cogroup(routed.groupBy(*where)).applyInPandas(
        search, f"query_id {query_type}, neighbor_id {id_type}, distance double")
    return _nearest(partial, k)


def _nearest(partial: DataFrame, k: int) -> DataFrame:
    best = W.partitionBy("query_id").orderBy("distance", "neighbor_id")
    return (
        partial.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        .select("query_id", "neighbor_id", "distance", "rank")
    )


def _met(train, queries, tree, k, block_rows, chunk_rows):
    """(blocks, routed queries), both by (cell, part, chunk): a block only where a query asks for it."""
    id_type, query_type = dict(train.dtypes)["id"], dict(queries.dtypes)["query_id"]

    def placed(frames):
        for pdf in frames:
            if len(pdf):
                cell, radius = tree.place(_matrix(pdf["v"]))
                yield pdf.assign(cell=cell.astype("int32"), radius=radius)

    # written, since a row between two pivots must not be placed twice in different ways
    rows = cut_lineage(train.mapInPandas(placed, f"id {id_type}, v array<double>, cell int, radius double"), "placed")

    def summarised(frames):
        met = {}
        for pdf in frames:
            if len(pdf):
                cell, radius = pdf["cell"].to_numpy(), pdf["radius"].to_numpy()
                for c in np.unique(cell):
                    own = radius[cell == c]
                    n, near, reach = met.get(c, (0, np.zeros(0), 0.0))
                    met[c] = n + len(own), np.sort(np.append(near, own))[:k], max(own.max(), reach)
        yield pd.DataFrame([(int(c), n, float(reach), near.tolist()) for c, (n, near, reach) in met.items()],
                           columns=["cell", "n", "reach", "near"])

    # per pivot: size, reach, and the k smallest radii, which bound every query's k-th distance
    smallest = F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k)
    layout = rows.select("cell", "radius").mapInPandas(summarised, "cell int, n bigint, reach double, near array<double>").groupBy("cell").agg(
        F.sum("n").alias("n"), F.max("reach").alias("reach"), smallest.alias("near")).orderBy("cell").collect()  # a row a pivot
    cell_ids = np.array([row["cell"] for row in layout])
    reach = np.array([row["reach"] for row in layout])
    near = [np.array(row["near"]) for row in layout]
    parts = np.array([-(-row["n"] // block_rows) for row in layout])
    which = np.repeat(np.arange(len(layout)), [len(x) for x in near])
    every_near = np.concatenate(near)

    def route(frames):
        step = max(1, _TOGETHER // max(1, len(which)))
        for whole in frames:
            for at in range(0, len(whole), step):
                pdf = whole.iloc[at:at + step]
                points = _matrix(pdf["v"])
                to_pivot = np.stack([_distances(points, tree.pivots[c]) for c in cell_ids], axis=1)
                reachable = to_pivot[:, which] + every_near
                last = min(k, len(which)) - 1
                limit = np.partition(reachable, last, axis=1)[:, last]
                wanted = to_pivot - reach[None, :] <= (limit * (1 + _SLACK) + _SLACK)[:, None]
                row, cell = np.nonzero(wanted)
                times = parts[cell]
                part = np.concatenate([np.arange(n) for n in times]) if len(times) else np.zeros(0, dtype=int)
                chosen = pdf.iloc[np.repeat(row, times)]
                yield chosen.assign(cell=np.repeat(cell_ids[cell], times).astype("int32"), part=part.astype("int32"))

    routed = cut_lineage(queries.mapInPandas(route, f"query_id {query_type}, v array<double>, cell int, part int"), "routed")
    asked = {row["cell"]: row["count"] for row in routed.filter("part = 0").groupBy("cell").count().collect()}  # a row a pivot
    sizes = train.sparkSession.createDataFrame(
        [(int(c), int(p), int(-(-asked[c] // chunk_rows))) for c, p in zip(cell_ids, parts) if c in asked],
        "cell int, parts int, chunks int")

    blocks = (
        rows.join(F.broadcast(sizes), "cell")
        .withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("cell", "part", "chunk", "id", "v")
    )
    chunked = routed.join(F.broadcast(sizes.select("cell", "chunks")), "cell").withColumn(
        "chunk", F.pmod(F.xxhash64("query_id"), F.col("chunks")).cast("int")).drop("chunks")
    return blocks, chunked


class BoxTree:
    """A full binary tree of cuts across one coordinate each; its leaves are the cells. Node i has the children
    2 i + 1 and 2 i + 2. The cuts are medians of some rows; the boxes are those of all rows that were placed."""

    def __init__(self, points: np.ndarray, levels: int):
        self.levels, self.first, self.width = levels, (1 << levels) - 1, points.shape[1]
        self.axis, self.cut = np.zeros(self.first, np.int64), np.zeros(self.first)
        held = {0: points}
        for node in range(self.first):
            some = held.pop(node)
            if len(some):
                axis = int(np.argmax(some.max(axis=0) - some.min(axis=0)))
                self.axis[node], self.cut[node] = axis, np.median(some[:, axis])
            right = some[:, self.axis[node]] > self.cut[node]
            held[2 * node + 1], held[2 * node + 2] = some[~right], some[right]

    @classmethod
    def of(cls, train: DataFrame, n: int) -> "BoxTree | None":
        """A tree for the `n` rows of (id, v), None in many dimensions or without rows. The driver looks at a bounded
        number of rows, which decide where the cuts lie and nothing else."""
        first = train.select("v").first()
        if first is None or not first["v"] or len(first["v"]) > BOX_DIMENSIONS:
            return None
        levels = min(MOST_BOXES, max(1, n // ROWS_A_BOX)).bit_length() - 1
        wanted = _SEEN_A_BOX << levels
        some = train.select("v").sample(min(1.0, wanted / n), seed=42).limit(2 * wanted).collect()
        points = np.array([list(row["v"]) for row in some], dtype=float).reshape(len(some), len(first["v"]))
        return cls(points, levels)

    def place(self, points):
        """The cell of every point."""
        node, at = np.zeros(len(points), np.int64), np.arange(len(points))
        for _ in range(self.levels):
            node = 2 * node + 1 + (points[at, self.axis[node]] > self.cut[node])
        return node - self.first

    def fill(self, cells, counts, low, high):
        """Take the sizes and corners of the cells that hold rows; those of the nodes above follow."""
        size = 2 * self.first + 1
        self.n = np.zeros(size, np.int64)
        self.low, self.high = np.full((size, low.shape[1]), np.inf), np.full((size, low.shape[1]), -np.inf)
        at = self.first + np.asarray(cells)
        self.n[at], self.low[at], self.high[at] = counts, low, high
        for node in range(self.first - 1, -1, -1):
            both = slice(2 * node + 1, 2 * node + 3)
            self.n[node], self.low[node], self.high[node] = self.n[both].sum(), self.low[both].min(axis=0), self.high[both].max(axis=0)

    def home(self, points, k: int):
        """(cell with rows, a bound of the k-th distance) of every point: the smallest box on its way that holds k
        rows has them all at most as far as its farthest corner."""
        node, at = np.zeros(len(points), np.int64), np.arange(len(points))
        holder = node
        for level in range(self.levels + 1):
            holder = np.where(self.n[node] >= k, node, holder)
            if level < self.levels:
                child = 2 * node + 1 + (points[at, self.axis[node]] > self.cut[node])
                node = np.where(self.n[child] > 0, child, 4 * node + 3 - child)
        gap = np.maximum(np.abs(points - self.low[holder]), np.abs(points - self.high[holder]))
        return node - self.first, np.where(self.n[holder] >= k, _distances(gap, 0.0), np.inf)

    def reached(self, points, limit):
        """Pairs (point, cell) whose box comes as near as the point's limit."""
        most = (limit * (1 + _SLACK) + _SLACK) ** 2
        point, node = np.arange(len(points)), np.zeros(len(points), np.int64)
        for level in range(self.levels + 1):
            square = np.zeros(len(point))
            for j in range(points.shape[1]):
                x = points[point, j]
                square += np.maximum(np.maximum(self.low[node, j] - x, x - self.high[node, j]), 0) ** 2
            near = (square <= most[point]) & (self.n[node] > 0)
            point, node = point[near], node[near]
            if level < self.levels:
                point, node = np.repeat(point, 2), np.repeat(2 * node, 2) + np.tile([1, 2], len(node))
        return point, node - self.first


def _squares(points, asked):
    """Slices of the queries with their squared distances to all points and what these may be off."""
    longest, step = float(np.einsum("ij,ij->i", points, points).max()), max(1, _TOGETHER // len(points))
    for at in range(0, len(asked), step):
        some = asked[at:at + step]
        yield slice(at, at + len(some)), _all_distances(some, points), _SLACK * (np.einsum("ij,ij->i", some, some) + longest)


def _kth(points, asked, k: int):
    """A bound of the distance of every query to its k-th nearest point, if there are k."""
    out = np.full(len(asked), np.inf)
    if len(points) >= k:
        for where, squares, off in _squares(points, asked):
            out[where] = np.sqrt(np.partition(squares, k - 1, axis=1)[:, k - 1] + off)
    return out


def _within(points, asked, limit, k: int):
    """(query, point, distance) of at most the k first points, by distance and place, within every query's limit."""
    found = []
    for where, squares, off in _squares(points, asked):
        near = squares <= (limit[where] ** 2 * (1 + _SLACK) + 2 * off)[:, None]
        ends = np.cumsum(near.sum(axis=1))
        cuts = [0, *(np.flatnonzero(np.diff(ends // _PAIRS)) + 1), len(ends)]
        for first, last in zip(cuts, cuts[1:]):
            query, point = np.nonzero(near[first:last])
            query += where.start + first
            distance = _distances(points[point], asked[query])
            order = np.lexsort((point, distance, query))
            query, point, distance = query[order], point[order], distance[order]
            kept = np.arange(len(query)) - np.searchsorted(query, query) < k
            found.append((query[kept], point[kept], distance[kept]))
    return [np.concatenate(x) for x in zip(*found)]


def _boxed(train, queries, tree: BoxTree, k, block_rows, chunk_rows) -> DataFrame:
    """(query_id, neighbor_id, distance): of every cell that a query reaches its nearest rows."""
    id_type, query_type = dict(train.dtypes)["id"], dict(queries.dtypes)["query_id"]
    spark, asking = train.sparkSession, f"query_id {query_type}, v array<double>, top double, cell int, part int"

    def placed(frames):
        for pdf in frames:
            if len(pdf):
                points = _matrix(pdf["v"])
                yield pdf.assign(cell=tree.place(points).astype("int32"))[~np.isnan(points).any(axis=1)]  # such a row is near nothing

    rows = cut_lineage(train.mapInPandas(placed, f"id {id_type}, v array<double>, cell int"), "placed")
    corners = [f(F.col("v")[j]).alias(f"{name}{j}") for name, f in (("low", F.min), ("high", F.max)) for j in range(tree.width)]
    layout = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *corners).collect()  # a row a cell
    tree.fill([row["cell"] for row in layout], [row["n"] for row in layout], *(
        np.array([[row[f"{name}{j}"] for j in range(tree.width)] for row in layout]).reshape(-1, tree.width) for name in ("low", "high")))
    parts = np.maximum(1, -(-tree.n[tree.first:] // block_rows))
    cut = rows.join(F.broadcast(spark.createDataFrame([(c, int(n)) for c, n in enumerate(parts)], "cell int, parts int")), "cell").withColumn(
        "part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).drop("parts")

    def sent_home(frames):
        for pdf in frames:
            if len(pdf):
                cell, top = tree.home(_matrix(pdf["v"]), k)
                yield pdf.assign(top=top, cell=cell.astype("int32"), part=(np.arange(len(pdf)) % parts[cell]).astype("int32"))

    def sent_on(frames):
        for whole in frames:
            for at in range(0, len(whole), _PAIRS // 4):
                pdf = whole.iloc[at:at + _PAIRS // 4]
                row, cell = tree.reached(_matrix(pdf["v"]), pdf["top"].to_numpy())
                times = parts[cell]
                part = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                yield pdf.iloc[np.repeat(row, times)].assign(
                    cell=np.repeat(cell, times).astype("int32"), part=part.astype("int32"))

    def together(routed):
        asked = {(row["cell"], row["part"]): row["count"] for row in routed.groupBy("cell", "part").count().collect()}  # a row a block
        sizes = F.broadcast(spark.createDataFrame(
            [(int(c), int(p), int(-(-n // chunk_rows))) for (c, p), n in asked.items()], "cell int, part int, chunks int"))
        blocks = cut.join(sizes, ["cell", "part"]).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("chunks")
        chunked = routed.join(sizes, ["cell", "part"]).withColumn(
            "chunk", F.pmod(F.xxhash64("query_id"), F.col("chunks")).cast("int")).drop("chunks")
        where = ["cell", "part", "chunk"]
        return blocks.groupBy(*where).cogroup(chunked.groupBy(*where))  # a block only where a query asks for it

    def bounded(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = right[["query_id", "v", "top"]]
        if len(left) and len(right):
            out = out.assign(top=np.minimum(out["top"], _kth(_matrix(left["v"]), _matrix(right["v"]), k)))
        return out

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "neighbor_id": [], "distance": []})
        left = left.sort_values("id", kind="stable")
        query, point, distance = _within(_matrix(left["v"]), _matrix(right["v"]), right["top"].to_numpy(), k)
        return pd.DataFrame({"query_id": right["query_id"].to_numpy()[query], "neighbor_id": left["id"].to_numpy()[point],
                             "distance": distance})

    at_home = cut_lineage(queries.mapInPandas(sent_home, asking), "home")
    known = together(at_home).applyInPandas(bounded, f"query_id {query_type}, v array<double>, top double")
    routed = cut_lineage(known.mapInPandas(sent_on, asking), "routed")
    return together(routed).applyInPandas(search, f"query_id {query_type}, neighbor_id {id_type}, distance double")


def knn_vote(neighbors: DataFrame, labels: DataFrame, key: str = "id", label: str = "label") -> DataFrame:
    """(query_id, prediction, votes): the most frequent label among the neighbours, smallest on ties."""
    votes = (
        neighbors.join(labels.select(F.col(key).alias("neighbor_id"), label), "neighbor_id")
        .groupBy("query_id", label).agg(F.count(F.lit(1)).alias("votes"))
    )
    return votes.groupBy("query_id").agg(
        F.min_by(F.struct(F.col(label).alias("prediction"), "votes"), F.struct(-F.col("votes"), F.col(label))).alias("b")
    ).select("query_id", "b.prediction", "b.votes")
