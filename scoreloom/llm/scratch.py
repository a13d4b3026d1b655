"""Intermediate tables in the shared folder, and bitmaps of a fixed size."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.storage import new_path

BUCKET_BITS = 32_768


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage: what follows never recomputes ``df``, also after losing an
    executor, because the folder is shared.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bit_index(key: Column, bits: int) -> Column:
    """Bit of a hashed long key, 1 to ``bits``; ``bits`` is a power of two."""
    return key.bitwiseAND(F.lit(bits - 1).cast("long")) + 1


def bitmap(df: DataFrame, key: Column, bits: int) -> np.ndarray:
    """One bit per value of a hashed long key, as ``bits / 8`` bytes.

    The size is the parameter, for any number of rows: the driver receives at
    most ``bits / 32768`` rows of 4 KiB. Different keys may share a bit, so a set
    bit means "perhaps" and a clear one "no".
    """
    index = bit_index(key, bits)
    rows = (
        df.select(
            F.bitmap_bucket_number(index).alias("bucket"), F.bitmap_bit_position(index).alias("bit")
        )
        .groupBy("bucket")
        .agg(F.bitmap_construct_agg("bit").alias("map"))
        .collect()
    )
    out = np.zeros(bits // 8, np.uint8)
    for r in rows:
        at = (r["bucket"] - 1) * (BUCKET_BITS // 8)
        block = np.frombuffer(r["map"], np.uint8)[: max(0, len(out) - at)]
        out[at : at + len(block)] = block
    return out


def has_bit(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which hashed keys (uint64) may be in the bitmap."""
    index = keys & np.uint64(len(bits) * 8 - 1)
    byte = bits[(index >> np.uint64(3)).astype(np.int64)]
    return (byte >> (index & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0


def perhaps_in(bits: np.ndarray, key: Column) -> Column:
    """Whether a hashed long key may be in the bitmap; of a row only the key goes to Python."""

    @F.pandas_udf("boolean")
    def found(keys: pd.Series) -> pd.Series:
        return pd.Series(has_bit(bits, keys.to_numpy().view(np.uint64)))

    return found(key)
