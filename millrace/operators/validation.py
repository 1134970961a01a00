"""Row rules and data-quality reports."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A named condition a row must meet; null or NaN never meets it."""

    name: str
    condition: Column


def positive_rules(columns, upper: float | None = None) -> list[Rule]:
    """Each column present, a number, greater than 0 and, if given, below `upper`."""
    rules = []
    for c in columns:
        value = F.col(c).cast("double")
        real = value.isNotNull() & ~F.isnan(value)
        rules.append(Rule(f"{c}_positive", real & (value > 0)))
        if upper is not None:
            rules.append(Rule(f"{c}_below_{upper:g}", real & (value < upper)))
    return rules


def check_rows(df: DataFrame, rules, name: str = "failed_rules") -> DataFrame:
    """Add the array of names of the rules a row fails; works on streams too."""
    failed = [F.when(~F.coalesce(r.condition, F.lit(False)), F.lit(r.name)) for r in rules]
    return df.withColumn(name, F.array_compact(F.array(*failed)))


def validate_rows(df: DataFrame, rules):
    """(valid rows, rejected rows with the reasons)."""
    checked = check_rows(df, rules)
    valid = checked.filter(F.size("failed_rules") == 0).drop("failed_rules")
    return valid, checked.filter(F.size("failed_rules") > 0)


def validate_batch(df: DataFrame, batch: str, limit: int = 100) -> DataFrame:
    """Size of every batch and whether it is within the limit."""
    return (
        df.groupBy(batch).agg(F.count(F.lit(1)).alias("n_samples"))
        .withColumn("accepted", F.col("n_samples") <= limit)
    )


def null_report(df: DataFrame) -> DataFrame:
    """(column, n_null) of every column, from one aggregation."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column", "n_null")


def _present(c):
    value = F.col(c).cast("double")
    return value, value.isNotNull() & ~F.isnan(value)


def positive_report(df: DataFrame, columns) -> DataFrame:
    """(column, all_positive); a null or NaN makes it false."""
    flags = []
    for c in columns:
        value, real = _present(c)
        flags.append(F.coalesce(F.bool_and(real & (value > 0)), F.lit(True)).alias(c))
    return df.agg(*flags).unpivot([], list(columns), "column", "all_positive")


def range_report(df: DataFrame, columns, bound: float) -> DataFrame:
    """(column, max_value, within): whether the maximum stays below the bound."""
    peaks = df.agg(*[F.max(F.col(c).cast("double")).alias(c) for c in columns])
    return (
        peaks.unpivot([], list(columns), "column", "max_value")
        .withColumn("within", F.coalesce(F.col("max_value") < bound, F.lit(False)))
    )


def domain_report(df: DataFrame, column: str, allowed) -> DataFrame:
    """How the values of a column compare with an allowed set.

    Counters only, so a column with any number of distinct values is fine: which
    allowed values occur, how many rows fall outside, and the two verdicts.
    """
    allowed = list(allowed)
    value = F.col(column)
    found = [F.coalesce(F.bool_or(value == v), F.lit(False)).alias(f"_f{i}") for i, v in enumerate(allowed)]
    outside = F.count_if(value.isNotNull() & ~value.isin(allowed)).alias("n_outside")
    return df.agg(*found, outside).select(
        F.lit(column).alias("column"),
        sum((F.col(f"_f{i}").cast("int") for i in range(len(allowed))), F.lit(0)).alias("n_allowed_seen"),
        "n_outside",
        (F.col("n_outside") == 0).alias("is_subset"),
        ((F.col("n_outside") == 0)
         & F.forall(F.array(*[F.col(f"_f{i}") for i in range(len(allowed))]), lambda x: x)).alias("is_equal"))


def shape_report(df: DataFrame, rows: int | None = None, columns: int | None = None) -> DataFrame:
    """(n_rows, n_columns, not_empty, as_expected)."""
    n_columns = len(df.columns)
    as_expected = F.lit(columns is None or columns == n_columns)
    if rows is not None:
        as_expected = as_expected & (F.col("n_rows") == rows)
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(n_columns).alias("n_columns"), (F.col("n_rows") > 0).alias("not_empty"),
        as_expected.alias("as_expected"))


@dataclass(frozen=True)
class Check:
    """One expectation: an aggregate value and a test on it."""

    kind: str
    column: str
    value: Column
    passes: object


def no_nulls(column):
    return Check("no_nulls", column, F.count_if(F.col(column).isNull()), lambda v: v == 0)


def all_positive(column):
    value, real = _present(column)
    return Check("positive", column, F.count_if(~F.coalesce(real & (value > 0), F.lit(False))), lambda v: v == 0)


def maximum_below(column, bound):
    return Check("max_below", column, F.max(F.col(column).cast("double")), lambda v: v < bound)


def only_values(column, allowed):
    value = F.col(column)
    return Check("domain", column, F.count_if(value.isNotNull() & ~value.isin(list(allowed))), lambda v: v == 0)


def not_empty():
    return Check("not_empty", "*", F.count(F.lit(1)), lambda v: v > 0)


def row_count(expected):
    return Check("row_count", "*", F.count(F.lit(1)), lambda v: v == expected)


def run_checks(df: DataFrame, checks) -> DataFrame:
    """(check, column, value, passed) of all expectations, from one pass over the data."""
    values = df.agg(*[c.value.cast("double").alias(f"c{i}") for i, c in enumerate(checks)])
    rows = [
        F.struct(F.lit(c.kind).alias("check"), F.lit(c.column).alias("column"),
                 F.col(f"c{i}").alias("value"),
                 F.coalesce(c.passes(F.col(f"c{i}")), F.lit(False)).alias("passed"))
        for i, c in enumerate(checks)
    ]
    return values.select(F.inline(F.array(*rows)))
