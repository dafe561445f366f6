"""A filter of fixed size that tells which keys can be in a table."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Its size doesn't grow with the data. A full filter lets more rows through, which costs time, not results.
BITS = 1 << 26


def filter_of(keys: DataFrame, name: str, bits: int = BITS) -> Broadcast:
    """A Bloom filter of the (hashed) long column ``name``; the driver gets a row for each word of 64 bits at most."""
    mask = F.lit(bits - 1)
    bit = F.explode(F.array(F.col(name).bitwiseAND(mask), F.shiftrightunsigned(name, 33).bitwiseAND(mask)))
    words = keys.select(bit.alias("b")).groupBy(F.shiftright("b", 6).alias("w")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("b").bitwiseAND(F.lit(63)).cast("int"))).alias("v"))
    out, got = np.zeros(bits >> 6, np.uint64), words.toArrow()
    out[got["w"].to_numpy()] = got["v"].to_numpy().view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(out)


def may_have(words: np.ndarray, value: np.ndarray) -> np.ndarray:
    """For unsigned hashes."""
    mask, six, one = np.uint64(len(words) * 64 - 1), np.uint64(6), np.uint64(1)
    test = lambda b: (words[b >> six] >> (b & np.uint64(63))) & one
    return (test(value & mask) & test((value >> np.uint64(33)) & mask)).astype(bool)


def passes(shared: Broadcast, key: Column) -> Column:
    """Whether a long column's value can be among the keys."""
    @F.pandas_udf("boolean")
    def test(values: pd.Series) -> pd.Series:
        return pd.Series(may_have(shared.value, values.to_numpy(np.int64).view(np.uint64)))

    return test(key)
