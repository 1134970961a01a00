"""Expressions over probability arrays."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def argmax(values: Column) -> Column:
    """Position of the greatest element, counted from 0; the first one on ties."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def normalize(values: Column) -> Column:
    """Divide by the sum; an all-zero array gives nulls."""
    total = F.aggregate(values, F.lit(0.0), lambda a, b: a + b)
    return F.transform(values, lambda v: F.try_divide(v, total))


def named_probabilities(names, values: Column, digits: int = 4) -> Column:
    """Map from class name to rounded probability."""
    keys = F.array(*[F.lit(n) for n in names])
    return F.map_from_arrays(keys, F.transform(values, lambda v: F.round(v, digits)))


def one_hot(label: Column, classes) -> list[Column]:
    """One 0/1 column per class."""
    return [(label == F.lit(c)).cast("int").alias(f"is_{c}") for c in classes]
