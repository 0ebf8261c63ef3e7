"""Upsert by key: of all versions of a row, the newest counts.

The newest is the one with the largest ``version`` (operators.normalize), however it was written. Rows
without one are older than rows with one, and the last written among themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from candlewick.functions.columns import add

VERSION_ORDER = ("version", "batch_id", "log_position")


def latest_by_key(
    versions: DataFrame, key: str = "event_id", order: Sequence[str] = VERSION_ORDER
) -> DataFrame:
    """One row per ``key``: the version that is last in ``order``, of which columns may be missing; nulls come first.

    The rank filter is applied within each map task ahead of the shuffle
    (WindowGroupLimit), so a key with very many versions sends few of them.
    """
    newest = ", ".join(f"{column} desc nulls last" for column in order if column in versions.columns)
    return (
        add(versions, {"_rank": f"row_number() over (partition by {key} order by {newest})"})
        .filter("_rank = 1")
        .drop("_rank")
    )
