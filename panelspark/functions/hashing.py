"""A hash that any SQL engine can reproduce, for seeded and repeatable sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_HEX_DIGITS = 15
HASH_BITS = 4 * HASH_HEX_DIGITS
HASH_RANGE = 1 << HASH_BITS


def row_hash(key_cols: Sequence[str], seed: int | str) -> Column:
    """The first 60 bits of md5 over ``seed|key1|key2|...`` as a BIGINT in [0, 2^60)."""
    parts = [F.lit(str(seed)), *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key_cols)]
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, HASH_HEX_DIGITS), 16, 10).cast("long")


def row_uniform(key_cols: Sequence[str], seed: int | str) -> Column:
    """A repeatable number in [0, 1) per key."""
    return row_hash(key_cols, seed).cast("double") / F.lit(float(HASH_RANGE))
