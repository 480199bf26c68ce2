"""Array-of-double arithmetic as Column expressions."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column
from pyspark.sql import functions as F


def as_doubles(c: Column) -> Column:
    return c.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x
    )


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(squared_distance(a, b))


def squared_norm(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x)


def unit(a: Column) -> Column:
    """The vector scaled to length 1; a zero vector stays as it is.

    The vector and then its norm are bound by one-element arrays: an expression named
    inside ``transform`` would be worked out again for every element.
    """
    bound = F.transform(
        F.array(a), lambda v: F.struct(v.alias("v"), F.sqrt(squared_norm(v)).alias("n"))
    )
    return F.element_at(F.transform(
        bound,
        lambda s: F.when(s["n"] > 0, F.transform(s["v"], lambda x: x / s["n"])).otherwise(s["v"]),
    ), 1)


def mean_vector(c: Column) -> Column:
    """Per-dimension mean, combined map-side: what moves is one vector per group and task."""
    return vector_to_array(Summarizer.mean(array_to_vector(c)))


def sum_vector(c: Column) -> Column:
    return vector_to_array(Summarizer.sum(array_to_vector(c)))
