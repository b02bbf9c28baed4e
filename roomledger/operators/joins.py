"""Join of a data-derived lookup table whose size must be checked before it is broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomledger.session import checkpoint_root

# Upper bound on rows of a lookup table that may be broadcast (a few tens of MB at most for the narrow
# tables used here). Above it the join stays a shuffle join, which AQE may still convert at run time.
BROADCAST_MAX_ROWS = 2_000_000


def is_small(stored: DataFrame, max_rows: int | None = None) -> bool:
    """Whether the measured row count of a stored table is within ``max_rows``."""
    return stored.count() <= (BROADCAST_MAX_ROWS if max_rows is None else max_rows)


def measured_broadcast(small: DataFrame, max_rows: int | None = None) -> DataFrame:
    """A stored ``small`` marked for broadcast only when its measured row count is within ``max_rows``."""
    return F.broadcast(small) if is_small(small, max_rows) else small


def checked_broadcast(small: DataFrame, max_rows: int | None = None) -> DataFrame:
    """``small`` checkpointed to the shared folder (computed once, lineage cut, survives executor loss),
    marked for broadcast only when its measured row count is within ``max_rows``."""
    checkpoint_root(small.sparkSession)
    return measured_broadcast(small.checkpoint(eager=True), max_rows)


def lookup_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "left",
                max_rows: int | None = None) -> DataFrame:
    """Join ``big`` to an aggregate-derived ``small`` table, broadcasting it only when it is measured small.

    ``small`` is checkpointed to the shared checkpoint folder (reliable, survives executor loss, and cuts
    its lineage so it is computed once), then counted; the count decides between a broadcast hash join
    and a shuffle join.
    """
    return big.join(checked_broadcast(small, max_rows), on, how)
