"""Vector functions as Columns over ARRAY<FLOAT> or ARRAY<DOUBLE>, in DOUBLE."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def dot(a: Column, b: Column) -> Column:
    """The sum of the products; NULL if an element is."""
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(v: Column) -> Column:
    """The length of a vector."""
    return F.sqrt(_sum(F.transform(v, lambda x: x.cast("double") * x.cast("double"))))


def normalized(v: Column) -> Column:
    """The vector at length 1 as ARRAY<FLOAT>; a vector of zeros stays."""
    n = norm(v)
    return F.when(n > 0, F.transform(v, lambda x: (x / n).cast("float"))).otherwise(v)


def cosine(v: Column, query: Sequence[float]) -> Column:
    """The cosine with a given vector; NULL where it has no direction or another number of elements."""
    q = [float(x) for x in query]
    length = math.sqrt(sum(x * x for x in q))
    if length == 0:
        return F.lit(None).cast("double")
    fits = (F.size(v) == len(q)) & (norm(v) > 0)
    return F.when(fits, dot(v, F.array(*map(F.lit, q))) / (norm(v) * F.lit(length)))


def distance(v: Column, query: Sequence[float]) -> Column:
    """1 - cosine, in 9 decimals, so that ties stay ties in any order of summation."""
    return F.round(1 - cosine(v, query), 9) + F.lit(0.0)


def checked(v: Column, dim: int) -> Column:
    """The vector, or an error where it has not `dim` elements."""
    return F.when(F.size(v) == dim, v).otherwise(F.raise_error(F.concat(F.lit(f"vector of {dim} elements expected, found "), F.size(v).cast("string"))))


def literal(v: Column, decimals: int = 8) -> Column:
    """The vector as text: [x, ...] with `decimals` decimals and no blanks; NULL for NULL."""
    return F.concat(F.lit("["), F.array_join(F.transform(v, lambda x: F.format_string(f"%.{decimals}f", x.cast("double"))), ","), F.lit("]"))


def rounded(v: Column, decimals: int = 8) -> Column:
    """The vector as it comes back from its text: each element to `decimals` decimals, as ARRAY<FLOAT>."""
    return F.transform(v, lambda x: F.round(x.cast("double"), decimals).cast("float"))
