"""Keyed hashes: the only source of randomness, so retries and re-partitionings repeat it exactly."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def hex_slice(digest: Column, which: int) -> Column:
    """The ``which``-th run of eight hex digits of a digest as a bigint in [0, 2^32)."""
    return F.conv(F.substring(digest, 8 * which + 1, 8), 16, 10).cast("bigint")


def hash32(*parts: Column) -> Column:
    """First eight hex digits of the md5 of the parts joined by ``|``."""
    text = parts[0].cast("string") if len(parts) == 1 else F.concat_ws("|", *[p.cast("string") for p in parts])
    return hex_slice(F.md5(text), 0)
