"""Keyed pseudonyms: equal values keep equal names, which only the key can give."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of HMAC (RFC 2104) with SHA-256: block length and pads.
BLOCK = 64
INNER_PAD, OUTER_PAD = 0x36, 0x5C
SHORTEST_KEY = 16


class Pseudonyms:
    """HMAC-SHA256 by built-in functions, as 64 hexadecimal digits.

    The key comes at run time. It reaches the tasks as the result of a scalar
    subquery over a one-row table, so neither it nor the pads made from it are
    literals: plans, explanations and event logs do not show them.
    """

    def __init__(self, spark: SparkSession, key: bytes) -> None:
        if len(key) < SHORTEST_KEY:
            raise ValueError(f"the key has fewer than {SHORTEST_KEY} bytes")
        block = (hashlib.sha256(key).digest() if len(key) > BLOCK else key).ljust(BLOCK, b"\0")
        pads = tuple(bytearray(byte ^ pad for byte in block) for pad in (INNER_PAD, OUTER_PAD))
        self._pads = spark.createDataFrame([pads], "inner_pad binary, outer_pad binary")

    def of(self, column: str, kind: str) -> Column:
        """The pseudonym of a text column; null stays null. The same text has
        different pseudonyms for different kinds (name, mail, ...), and one
        pseudonym wherever the same kind occurs, so joins still work."""
        inner, outer = (self._pads.select(name).scalar() for name in ("inner_pad", "outer_pad"))
        text = F.concat(F.lit(kind + "\0"), F.col(f"`{column}`").cast("string")).cast("binary")
        once = F.unhex(F.sha2(F.concat(inner, text), 256))
        return F.sha2(F.concat(outer, once), 256)

    def mask(self, df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
        """Replace columns, given with their kinds; columns that ``df`` lacks are an error."""
        missing = set(kinds) - set(df.columns)
        if missing:
            raise ValueError(f"no such columns: {sorted(missing)}")
        return df.withColumns({name: self.of(name, kind) for name, kind in kinds.items()})
