"""Row-level operators: derive, filter, project, replicate, union, order."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def derive(df: DataFrame, columns: dict) -> DataFrame:
    """Add columns given as {name: expression or SQL text}."""
    return df.withColumns({n: F.expr(e) if isinstance(e, str) else e for n, e in columns.items()})


def product(a: str, b: str) -> Column:
    return F.col(a).cast("double") * F.col(b).cast("double")


def ratio(a: str, b: str) -> Column:
    """a / b, null where b is zero."""
    return F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))


def isin(df: DataFrame, column: str, members) -> DataFrame:
    return df.filter(F.col(column).isin(list(members)))


def project_rename(df: DataFrame, names: dict) -> DataFrame:
    """Keep the columns named by `names` ({old: new}), renamed."""
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])


def filter_runs(df: DataFrame, metric: str, threshold: float = 0.90) -> DataFrame:
    """Rows whose metric reaches the threshold; a missing metric counts as 0."""
    return df.filter(F.coalesce(F.col(metric), F.lit(0.0)) >= threshold)


def metric_trend(df: DataFrame, metric: str, order, keep=()) -> DataFrame:
    """The metric in run order, without the runs that lack it."""
    return df.filter(F.col(metric).isNotNull()).select(*keep, *order, metric).orderBy(*order)


def low_confidence(df: DataFrame, threshold: float = 0.7, column: str = "max_prob") -> DataFrame:
    """Rows below the threshold; a missing probability counts as 1."""
    return df.filter(F.coalesce(F.col(column), F.lit(1.0)) < threshold)


def union_sets(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def replicate_rows(df: DataFrame, times: int, name: str = "copy") -> DataFrame:
    """Every row `times` times, numbered 1..times; no rows for times = 0."""
    copies = F.sequence(F.lit(1), F.lit(times)) if times else F.array().cast("array<int>")
    return df.withColumn(name, F.explode(copies))


def leaderboard(df: DataFrame, metric: str, *ties) -> DataFrame:
    return df.orderBy(F.desc(metric), *ties)


def head_n(df: DataFrame, n: int, *order) -> DataFrame:
    """First `n` rows of an order, kept as a per-task top-n merged at the end."""
    return df.orderBy(*order).limit(n)


def best_run(df: DataFrame, metric: str, run_id: str, keep, keys=()) -> DataFrame:
    """The run with the greatest metric (smallest id on ties) and its other columns."""
    best = F.min_by(F.struct(run_id, metric, *keep),
                    F.struct(-F.col(metric), F.col(run_id))).alias("_best")
    return df.filter(F.col(metric).isNotNull()).groupBy(*keys).agg(best).select(*keys, "_best.*")
