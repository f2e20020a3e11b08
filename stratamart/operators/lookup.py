"""Joins of the model layer: enrichment, surrogate-key lookup, star joins, conformed unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart.functions.keys import UNKNOWN_KEY, packed, unpacked
from stratamart.operators.conform import current_only, drop_null_keys
from stratamart.operators.dedupe import one_row_per_key
from stratamart.operators.skew import fits_broadcast, heavy_keys, needs_salting, spread_join
from stratamart.spec import SCD_CURRENT


def enrich_left(
    df: DataFrame,
    extra: DataFrame,
    on: Sequence[str],
    *,
    dedupe_right: Sequence[str] | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Add the columns of ``extra`` where its key matches.

    A key that is not unique in ``extra`` multiplies rows; ``dedupe_right`` (an order) keeps its latest row.  Other
    columns of the same name on both sides are an error.
    """
    if dedupe_right is not None:
        extra = one_row_per_key(extra, on, dedupe_right)
    clash = (set(df.columns) & set(extra.columns)) - set(on)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}; drop or rename them in one")
    return spread_join(df, extra, on, "left", hot_rows=hot_rows)


def key_lookup(
    fact: DataFrame,
    dimension: DataFrame,
    natural_key: Sequence[str],
    key: str,
    *,
    unknown: str = UNKNOWN_KEY,
    hot_rows: int | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Add the dimension's current surrogate key; a missing or NULL natural key gives the unknown member.

    Two current members of one natural key would multiply the fact: they fail the job (DuplicateKey).
    ``counted`` as in `spread_join`: in a chain of lookups, the frame the chain starts from.
    """
    members = current_only(dimension) if SCD_CURRENT in dimension.columns else dimension
    members = one_row_per_key(drop_null_keys(members.select(*natural_key, key), natural_key), natural_key, on_duplicate="error")
    found = spread_join(fact.drop(key), members, natural_key, "left", hot_rows=hot_rows, counted=counted)
    return found.withColumn(key, F.coalesce(F.col(key), F.lit(unknown)))


def star_join(
    fact: DataFrame, dimensions: Mapping[str, DataFrame], *, how: str = "inner", hot_rows: int | None = None
) -> DataFrame:
    """Join the fact to dimensions given by surrogate-key column.

    Only current versions take part, otherwise a dimension with history multiplies the fact.  Attributes
    must be selected and renamed by the caller; columns already present are not brought in again.  Hot keys
    of all dimensions that are too large to broadcast are found in one pass over the fact itself.
    """
    members, taken = {}, set(fact.columns)
    for key, dimension in dimensions.items():
        current = current_only(dimension) if SCD_CURRENT in dimension.columns else dimension
        fresh = [c for c in current.columns if c not in taken and not c.startswith("scd_")]
        members[key], taken = current.select(key, *fresh), taken | set(fresh)
    large = {key: [key] for key, current in members.items() if not fits_broadcast(current)}
    salted = {key: [key] for key in large if needs_salting(fact, members[key])}
    # Keys that are shuffled travel packed: hex digits take twice the bytes they stand for.
    text = [key for key in large if fact.schema[key].dataType == members[key].schema[key].dataType == T.StringType()]
    out = fact.withColumns({key: packed(F.col(key)) for key in text}) if text else fact
    heavy = heavy_keys(out, salted, hot_rows) if salted else {}
    columns = list(fact.columns)
    for key, current in members.items():
        fresh = [c for c in current.columns if c != key]
        columns = [*columns, *fresh] if key in heavy else [key, *[c for c in columns if c != key], *fresh]
    # Small dimensions first: their keys are not needed any more when the others are shuffled.
    for key, current in sorted(members.items(), key=lambda m: m[0] in large):
        if key in text:
            current = current.withColumn(key, packed(F.col(key)))
        out = spread_join(out, current, [key], how, heavy=heavy[key], force_salting=True) if key in heavy else out.join(current, key, how)
    return out.select(*[unpacked(F.col(c)).alias(c) if c in text else c for c in columns])


def conformed_union(sources: Mapping[str, DataFrame], tag: str, columns: Sequence[str]) -> DataFrame:
    """Bag union of sources already mapped to common names, each tagged with where it came from."""
    out = None
    for name, df in sources.items():
        tagged = df.withColumn(tag, F.lit(name)).select(*columns)
        out = tagged if out is None else out.unionByName(tagged)
    if out is None:
        raise ValueError("no sources to unite")
    return out
