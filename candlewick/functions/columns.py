"""Column lists as SQL text.

The operators name their columns with SQL expressions: a plan of several
hundred expressions is then sent to the JVM in a few calls.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame


def add(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Append ``name: expression`` columns."""
    return df.selectExpr("*", *[f"{text} as {name}" for name, text in columns.items()])


def choose(df: DataFrame, columns: Iterable[str], renamed: Mapping[str, str] | None = None) -> DataFrame:
    """Keep ``columns`` in order, taking those in ``renamed`` from the given expression."""
    texts = renamed or {}
    return df.selectExpr(*[f"{texts[c]} as {c}" if c in texts else c for c in columns])


def join_per_key(rows: DataFrame, per_key: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join of ``rows`` with a table of one row per key.

    The table is broadcast if its size allows. If not, a hot key must be split: AQE
    does so for a sort-merge join with a shuffle of its own on both sides and none of
    it promised to a later grouping. Joining on the keys as one struct brings that
    about, as the partitioning of neither input nor output carries over.
    """
    key = f"struct({', '.join(keys)}) as _key"
    left = rows.selectExpr("*", key)
    right = per_key.selectExpr(f"* except ({', '.join(keys)})", key)
    return left.join(right, "_key").drop("_key")


def pct_of(part: str, base: str) -> str:
    """``part`` in percent of ``base``, in double; null for a null or zero base."""
    return f"(cast({part} as double) / nullif(cast({base} as double), 0d) * 100)"
