"""DBSCAN in one to three dimensions on a grid.

Cells have the diagonal eps, so all points of one cell are neighbours. A cell
with `min_points` points is therefore all core without comparing anything, and
its core points are one cluster; only the few points of thin cells (fewer than
`min_points` each) are compared with the cells around them. Repeated positions
are merged first and carry their count.
"""

from itertools import product
from math import ceil, sqrt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.components import connected_components
from millrace.operators.frames import union_sets
from millrace.operators.ordered import row_index
from millrace.session import cut_lineage

CELL_ROWS = 100_000
FEW_POSITIONS = 32
MAX_LEVELS = 48


def _cell_of(columns, side):
    return F.struct(*[F.floor(F.col(c) / side).cast("bigint").alias(f"c{i}") for i, c in enumerate(columns)])


def _around(cell, dims, reach, own=False):
    """The cells up to `reach` steps away in every direction, with or without the cell itself."""
    shifts = [s for s in product(range(-reach, reach + 1), repeat=dims) if own or any(s)]
    return F.array(*[F.struct(*[(cell[f"c{i}"] + s).alias(f"c{i}") for i, s in enumerate(shift)]) for shift in shifts])


def _gap(a, b, columns):
    return F.sqrt(sum((F.col(f"{a}.{c}") - F.col(f"{b}.{c}")) ** 2 for c in columns))


def _meet(thin, others, dims, reach, condition, own=False):
    """Pairs of a thin-cell point and a point of the cells around it that meet `condition`.

    A thin cell has fewer than `min_points` positions, so every position of
    `others` meets a bounded number of them. A crowded cell is split into parts
    and its visitors go to every part, so no join key holds more than CELL_ROWS rows.
    """
    sizes = others.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / CELL_ROWS).cast("int").alias("parts"))
    spread = others.join(sizes, "cell").withColumn("part", F.pmod(F.xxhash64("p"), F.col("parts")).cast("int")).select(
        "cell", "part", F.struct(*[c for c in others.columns if c != "cell"]).alias("o"))
    visits = (
        thin.withColumn("cell", F.explode(_around(F.col("cell"), dims, reach, own)))
        .join(sizes, "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    )
    return visits.join(spread, ["cell", "part"]).filter(condition)


def core_points(df: DataFrame, columns, eps: float = 0.5, min_points: int = 5):
    """(positions with cell, weight, is_core): a position is core when at least
    `min_points` rows, itself counted, lie within eps."""
    columns = list(columns)
    dims = len(columns)
    if not 1 <= dims <= 3:
        raise ValueError("the grid serves one to three dimensions; project the points first")
    # a hair under the exact side, so that rounding never puts two points of a cell further apart than eps
    side = eps / sqrt(dims) * (1 - 1e-9)
    reach = ceil(eps / side)
    positions = (
        df.select(*[F.col(c).cast("double").alias(c) for c in columns])
        .groupBy(*columns).agg(F.count(F.lit(1)).alias("weight"))
        .select(F.struct(*columns).alias("p"), "weight", _cell_of(columns, side).alias("cell"))
    )
    positions = cut_lineage(positions, "positions")
    cells = positions.groupBy("cell").agg(F.sum("weight").alias("cell_weight"))
    weighed = positions.join(cells, "cell")
    thin = weighed.filter(F.col("cell_weight") < min_points)
    near = (
        _meet(thin.select("cell", "p", "cell_weight"), positions.select("cell", "p", "weight"), dims, reach,
              _gap("p", "o.p", columns) <= eps)
        .groupBy("p").agg(F.sum("o.weight").alias("near"))
    )
    flagged = weighed.join(near, "p", "left").select(
        "p", "cell", "weight",
        (F.col("cell_weight") + F.coalesce("near", F.lit(0)) >= min_points).alias("is_core"))
    return cut_lineage(flagged, "core"), reach, side


def _sub_of(columns, side, level):
    """Which of the parts, halved `level` times along each axis, a position of a cell is in."""
    return F.struct(*[
        F.floor((F.col(f"p.{c}") / side - F.col(f"cell.c{i}")) * (2 ** level)).cast("bigint").alias(f"s{i}")
        for i, c in enumerate(columns)])


def _boxes(core, columns, side, level):
    """Bounding boxes of the core points, cells halved `level` times along each axis."""
    return core.groupBy("cell", _sub_of(columns, side, level).alias("sub")).agg(
        F.count(F.lit(1)).alias("n"),
        F.struct(*[F.min(f"p.{c}").alias(c) for c in columns]).alias("lo"),
        F.struct(*[F.max(f"p.{c}").alias(c) for c in columns]).alias("hi"))


def _nearest(columns):
    parts = [F.greatest(F.col(f"lo_a.{c}") - F.col(f"hi_b.{c}"), F.col(f"lo_b.{c}") - F.col(f"hi_a.{c}"), F.lit(0.0)) ** 2
             for c in columns]
    return F.sqrt(sum(parts))


def _furthest(columns):
    parts = [F.greatest(F.col(f"hi_b.{c}") - F.col(f"lo_a.{c}"), F.col(f"hi_a.{c}") - F.col(f"lo_b.{c}")) ** 2
             for c in columns]
    return F.sqrt(sum(parts))


def _side_of(boxes, name):
    return boxes.select(F.col("cell").alias(name), F.col("sub").alias(f"sub_{name}"),
                        F.col("n").alias(f"n_{name}"), F.col("lo").alias(f"lo_{name}"), F.col("hi").alias(f"hi_{name}"))


def cell_links(core: DataFrame, columns, eps: float, side: float, reach: int) -> DataFrame:
    """Pairs (u, v) of cells with two core points within eps of each other.

    Pairs of bounding boxes are compared instead of pairs of points: boxes
    wholly within eps link their cells, boxes further apart than eps are
    dropped. Undecided boxes with few positions each are compared position by
    position, the others are halved and judged again. A pair of cells leaves as
    soon as one pair of its boxes links it.
    """
    dims = len(columns)
    boxes = cut_lineage(_boxes(core, columns, side, 0), "boxes")
    pairs = (
        _side_of(boxes, "a").withColumn("b", F.explode(_around(F.col("a"), dims, reach)))
        .filter(F.col("a") < F.col("b")).join(_side_of(boxes, "b"), "b")
    )
    found = []
    for level in range(MAX_LEVELS):
        judged = pairs.withColumn("near", _nearest(columns)).withColumn("far", _furthest(columns)).filter(
            F.col("near") <= eps)
        judged = cut_lineage(judged, "pairs")
        linked = judged.filter(F.col("far") <= eps).select("a", "b").distinct()
        open_pairs = judged.join(linked, ["a", "b"], "left_anti")
        few = (F.col("n_a") <= FEW_POSITIONS) & (F.col("n_b") <= FEW_POSITIONS)
        if level == MAX_LEVELS - 1:
            few = F.lit(True)  # boxes this small hold positions that differ in their last digits only
        found += [linked, _compare_positions(open_pairs.filter(few), core, columns, side, level, eps)]
        crowded = open_pairs.filter(~few)
        if crowded.isEmpty():
            break
        cells = crowded.select(F.col("a").alias("cell")).unionByName(crowded.select(F.col("b").alias("cell"))).distinct()
        finer = cut_lineage(_boxes(core.join(cells, "cell"), columns, side, level + 1), "boxes")
        pairs = (
            crowded.select("a", "b", F.col("sub_a").alias("up_a"), F.col("sub_b").alias("up_b"))
            .join(_halves(finer, "a", dims), ["a", "up_a"]).join(_halves(finer, "b", dims), ["b", "up_b"])
            .drop("up_a", "up_b")
        )
    return union_sets(*found).distinct().select(F.col("a").alias("u"), F.col("b").alias("v"))


def _halves(boxes, name, dims):
    """Boxes with the box of the level above that they came from."""
    above = F.struct(*[F.shiftright(f"sub_{name}.s{i}", 1).alias(f"s{i}") for i in range(dims)])
    return _side_of(boxes, name).withColumn(f"up_{name}", above)


def _compare_positions(pairs, core, columns, side, level, eps):
    inside = core.select("cell", _sub_of(columns, side, level).alias("sub"), "p")
    ends = [inside.select(F.col("cell").alias(n), F.col("sub").alias(f"sub_{n}"), F.col("p").alias(f"p_{n}"))
            for n in ("a", "b")]
    return (
        pairs.select("a", "b", "sub_a", "sub_b").join(ends[0], ["a", "sub_a"]).join(ends[1], ["b", "sub_b"])
        .filter(_gap("p_a", "p_b", columns) <= eps).select("a", "b").distinct()
    )


def dbscan(df: DataFrame, key: str, columns, eps: float = 0.5, min_points: int = 5) -> DataFrame:
    """(key, is_core, cluster): clusters are numbered 0, 1, ... by their first cell; noise is -1.

    A border row goes to the first cluster that has a core point within eps of it.
    """
    columns = list(columns)
    flagged, reach, side = core_points(df, columns, eps, min_points)
    core = flagged.filter("is_core")
    links = cell_links(core, columns, eps, side, reach)
    nodes = core.select(F.col("cell").alias("node")).distinct()
    components = connected_components(nodes, links)
    numbers = row_index(components.select("component").distinct(), ["component"], "cluster")
    labels = components.join(numbers, "component").select(F.col("node").alias("cell"), "cluster")
    labelled = core.join(labels, "cell").select("p", "cell", "cluster")
    border = (
        _meet(flagged.filter(~F.col("is_core")).select("cell", "p"), labelled, len(columns), reach,
              _gap("p", "o.p", columns) <= eps, own=True)
        .groupBy("p").agg(F.min("o.cluster").alias("cluster"))
    )
    found = labelled.select("p", "cluster").unionByName(border)
    placed = flagged.join(found, "p", "left").select(
        *[F.col(f"p.{c}").alias(f"_{c}") for c in columns], "is_core",
        F.coalesce("cluster", F.lit(-1)).alias("cluster"))
    return _rows_at(df, placed, columns).select(key, "is_core", "cluster")


def core_flags(df: DataFrame, key: str, columns, eps: float = 0.5, min_points: int = 5) -> DataFrame:
    """(key, is_core) of every row."""
    columns = list(columns)
    flagged, _, _ = core_points(df, columns, eps, min_points)
    placed = flagged.select(*[F.col(f"p.{c}").alias(f"_{c}") for c in columns], "is_core")
    return _rows_at(df, placed, columns).select(key, "is_core")


def _rows_at(df, placed, columns):
    """All rows of `df` with what is known of their position; a position may hold very many rows."""
    at = [f"_{c}" for c in columns]
    rows = df.withColumns({name: F.col(c).cast("double") for name, c in zip(at, columns)})
    return rows.join(placed, list(at)).drop(*at)


def cluster_counts(labels: DataFrame) -> DataFrame:
    """(n_clusters, n_noise)."""
    per_cluster = labels.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    noise = F.col("cluster") == -1
    return per_cluster.agg(
        F.count_if(~noise).alias("n_clusters"), F.coalesce(F.sum(F.when(noise, F.col("n"))), F.lit(0)).alias("n_noise"))
