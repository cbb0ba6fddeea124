"""Array and vector Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.strings import col, strip


def split_trim(c, sep: str = ",") -> Column:
    parts = F.transform(F.split(col(c), sep), strip)
    return F.filter(parts, lambda p: p != "")


def dot(a, b) -> Column:
    prod = F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prod, F.lit(0.0), lambda s, x: s + x)


def cosine(a, b) -> Column:
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def even_sample(c, n: int = 100) -> Column:
    """At most ``n`` elements at evenly spaced positions, both ends included."""
    arr = col(c)
    size = F.size(arr)
    step = (size - 1) / F.lit(float(n - 1))
    picked = F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)),
        lambda i: F.get(arr, F.least(F.floor(i * step).cast("int"), size - 1)),
    )
    return F.when(size > n, picked).otherwise(arr)
