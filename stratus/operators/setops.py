"""Set operations between layers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def layer_diff(upstream: DataFrame, downstream: DataFrame, keys) -> DataFrame:
    """Distinct key tuples of ``upstream`` absent from ``downstream`` (SQL EXCEPT).

    NULL keys compare equal, as in EXCEPT; Catalyst plans it as a null-safe
    left-anti join after a distinct, both hash-partitioned on the keys.
    """
    keys = list(keys)
    return upstream.select(*keys).subtract(downstream.select(*keys))
