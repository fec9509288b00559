"""Bounded samples by hash, without sending every task's share to one."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import stored


def hash_sample(rows: DataFrame, key: str, size: int, folder: str) -> DataFrame:
    """The ``size`` rows with the least hash of ``key`` (equal hashes by the
    other columns), written to ``folder``. A first pass counts the rows, so
    that only those below a hash bound that about ``size`` of them pass are
    sorted; should equal keys leave too few, all rows are."""
    n = rows.count()
    hashed = F.xxhash64(key)
    order = [hashed, *rows.columns]
    share = (size + 8 * math.sqrt(size) + 64) / max(n, 1)
    if share < 1:
        few = stored(rows.where(hashed < F.lit(int(-2**63 + share * 2**64))).orderBy(*order).limit(size), f"{folder}/few")
        if few.count() == size:
            return few
    return stored(rows.orderBy(*order).limit(size), f"{folder}/all")
