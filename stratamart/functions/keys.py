"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Key of the member a fact row points to when its natural key is missing or not found.
UNKNOWN_KEY = "-1"


def _key_part(name: str) -> Column:
    # Escaping first, NULL marker last: a text value can then never look like the separator or the marker,
    # so different inputs always give different key texts ((a, NULL, b), (a, b) and (a, '', b) differ).
    text = F.col(name).cast("string")
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit("|"), F.lit("\\|"))
    return F.coalesce(text, F.lit("\\N"))


def surrogate_key(columns: Sequence[str]) -> Column:
    """SHA-256 hex over the given columns; equal inputs give equal keys on every run and cluster."""
    return F.sha2(F.concat_ws("|", *[_key_part(c) for c in columns]), 256)


def member_key(columns: Sequence[str]) -> Column:
    """`surrogate_key`, with the unknown member's key where all columns are NULL."""
    missing = F.lit(True)
    for c in columns:
        missing = missing & F.col(c).isNull()
    return F.when(missing, F.lit(UNKNOWN_KEY)).otherwise(surrogate_key(columns))


def packed(key: Column) -> Column:
    """A text key as bytes: 64 hex digits, as a surrogate key has them, become 32 bytes, other texts keep theirs.

    The first byte tells which, so different keys stay different and `unpacked` gives every key back.
    """
    digits = (F.length(key) == 64) & F.lower(F.hex(F.unhex(key))).eqNullSafe(key)
    return F.when(digits, F.concat(F.lit(b"\x01"), F.unhex(key))).otherwise(F.concat(F.lit(b"\x00"), key.cast("binary")))


def unpacked(key: Column) -> Column:
    """The text of a `packed` key."""
    rest = F.substring(key, 2, 2_147_483_647)
    return F.when(F.substring(key, 1, 1) == F.lit(b"\x01"), F.lower(F.hex(rest))).otherwise(rest.cast("string"))
