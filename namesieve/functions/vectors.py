"""Dense vector arithmetic on array columns, as Spark SQL expressions."""

from __future__ import annotations


def squared_norm(vector: str) -> str:
    return f"aggregate({vector}, 0D, (acc, x) -> acc + CAST(x AS DOUBLE) * CAST(x AS DOUBLE))"


def unit_length(vector: str) -> str:
    """Vector divided by its Euclidean norm; a zero vector stays as it is.

    The outer one-element ``transform`` binds the norm once; inside a lambda it would be
    computed again for every component.
    """
    norm = f"coalesce(nullif(sqrt({squared_norm(vector)}), 0D), 1D)"
    bound = f"array(named_struct('v', {vector}, 'n', {norm}))"
    return f"get(transform({bound}, b -> transform(b.v, x -> CAST(x AS DOUBLE) / b.n)), 0)"


def dot(left: str, right: str) -> str:
    products = f"zip_with({left}, {right}, (x, y) -> CAST(x AS DOUBLE) * CAST(y AS DOUBLE))"
    return f"aggregate({products}, 0D, (acc, x) -> acc + x)"
