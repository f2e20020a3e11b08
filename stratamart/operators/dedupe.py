"""One source row per key, chosen deterministically."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_row_per_key(
    df: DataFrame, key: Sequence[str], order_by: Sequence[str] = (), *, on_duplicate: str = "latest", rows: str | None = None
) -> DataFrame:
    """Keep the greatest row per key by ``order_by``, ties broken by the remaining columns.

    Written as an aggregate, not as a window: each map task sends at most one row per key, so a key with
    a third of all rows costs the reducer no more than any other.  NULL sorts lowest.
    ``on_duplicate="error"`` fails the job if a key has more than one row.  ``rows`` names a further column with the number
    of rows of each key.
    """
    if on_duplicate not in ("latest", "error"):
        raise ValueError(f"on_duplicate must be 'latest' or 'error', not {on_duplicate!r}")
    columns = df.columns
    ranked = [c for c in order_by if c not in key]
    rest = [c for c in columns if c not in key and c not in ranked]
    payload = [*ranked, *rest]
    if not payload:
        payload_agg = []
    else:
        payload_agg = [F.max(F.struct(*payload)).alias("__row")]
    number = [F.count(F.lit(1)).alias(rows)] if rows else []
    if on_duplicate == "error":
        grouped = df.groupBy(*key).agg(*payload_agg, *number, F.count(F.lit(1)).alias("__n"))
        shown = F.to_json(F.struct(*key))
        failure = F.raise_error(F.concat(F.lit("DuplicateKey: "), shown))
        first = key[0]
        checked = F.when(F.col("__n") > 1, failure.cast(df.schema[first].dataType)).otherwise(F.col(first))
        grouped = grouped.withColumn(first, checked)
    elif payload or number:
        grouped = df.groupBy(*key).agg(*payload_agg, *number)
    else:
        return df.distinct()
    picked = {c: F.col(f"__row.{c}") for c in payload}
    return grouped.select(*[picked.get(c, F.col(c)).alias(c) for c in columns], *([rows] if rows else []))
