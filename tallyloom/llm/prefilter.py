"""A bitmap that tells rows that may match from rows that cannot, so that the others need not be shuffled.

It has 2**24 bits (2 MB) whatever the number of keys. It only spares work: with very many keys it fills up, and more
rows reach the exact join that follows, with the same result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 24
_BUCKET = 15  # a bitmap aggregate has 2**15 bits


def _slot(*columns: str | Column) -> Column:
    return F.xxhash64(*columns).bitwiseAND(F.lit((1 << BITS) - 1))


def may_match(keys: DataFrame, names: list[str], *columns: str | Column) -> Column:
    """Is the row's key of ``columns`` perhaps one of ``keys`` (its columns ``names``)? True for all that are.

    The driver gets at most 512 bitmaps of 4 KB. Equal types on both sides are the caller's business.
    """
    slots = keys.select(_slot(*names).alias("slot"))
    place = F.col("slot").bitwiseAND(F.lit((1 << _BUCKET) - 1))
    found = slots.groupBy(F.shiftright("slot", _BUCKET).alias("bucket")).agg(F.bitmap_construct_agg(place).alias("bits")).collect()
    bits = np.zeros((1 << BITS) // 8, np.uint8)
    size = (1 << _BUCKET) // 8
    for row in found:
        bits[row["bucket"] * size : (row["bucket"] + 1) * size] = np.frombuffer(row["bits"], np.uint8)

    def marked(slot: pd.Series) -> pd.Series:
        at = slot.to_numpy()
        return pd.Series((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1)

    return F.pandas_udf(marked, "boolean")(_slot(*columns))
