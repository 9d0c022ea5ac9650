"""Column expressions over dense vectors stored as ARRAY<FLOAT> or ARRAY<DOUBLE>."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Smallest norm a vector is divided by, so that a zero vector stays zero.
NORM_FLOOR = 1e-12


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    An expression captured by an inner lambda is evaluated once per array element;
    bound as a lambda variable it is evaluated once.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def dot(a: Column, b: Column) -> Column:
    """Inner product in double precision, folded left to right."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def squared_norm(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))


def squared_distance(a: Column, b: Column) -> Column:
    gaps = F.zip_with(a, b, lambda x, y: x.cast("double") - y.cast("double"))
    return F.aggregate(gaps, F.lit(0.0), lambda total, x: total + x * x)


def l2_normalize(v: Column) -> Column:
    """Unit-length copy of ``v`` as ARRAY<DOUBLE>; the zero vector is returned unchanged."""
    length = F.greatest(F.sqrt(squared_norm(v)), F.lit(NORM_FLOOR))
    return bind(length, lambda n: F.transform(v, lambda x: x.cast("double") / n))


def is_zero_vector(v: Column) -> Column:
    return F.forall(v, lambda x: x == 0)


def has_nan(v: Column) -> Column:
    return F.exists(v, lambda x: F.isnan(x) | x.isNull())


def fingerprint(v: Column) -> list[Column]:
    """128-bit identity of a vector as two BIGINT columns."""
    return [F.xxhash64(v), F.xxhash64(F.lit(1), v)]
