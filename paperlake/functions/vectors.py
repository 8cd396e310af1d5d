"""Vector arithmetic as higher-order column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def l2_norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def l2_normalize(v: Column) -> Column:
    """Unit-length copy in double; a zero vector stays zero.

    The scaling sits in the aggregate's final step, so the norm is worked out once per row.
    """
    return F.aggregate(
        v,
        F.lit(0.0),
        lambda acc, x: acc + x.cast("double") * x.cast("double"),
        lambda total: F.transform(
            v,
            lambda x: F.when(total == 0, F.lit(0.0)).otherwise(x.cast("double") / F.sqrt(total)),
        ),
    )


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity in double; 0 when either vector is zero."""
    scale = l2_norm(a) * l2_norm(b)
    return F.when(scale == 0, F.lit(0.0)).otherwise(dot(a, b) / scale)
