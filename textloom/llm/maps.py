"""Bit maps of the keys that occur, of a fixed size whatever the input; a full map only tells less."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAP_BITS = 26
#: Bits of maps that are part of an expression; they only say which keys are dealt by salts or split.
HOT_BITS = 16


def bit_maps(df: DataFrame, key: str, *where: Column, bits: int = MAP_BITS) -> list[np.ndarray]:
    """For each condition one bit for each value of the low bits of the key that occurs in such a row: 2**bits bits."""
    place = F.col(key).bitwiseAND(F.lit((1 << bits) - 1))
    bit = F.expr("shiftleft(1L, cast(p & 63 as int))")
    marked = df.select(place.alias("p"), *[w.alias(f"w{k}") for k, w in enumerate(where)])
    words = marked.groupBy(F.shiftright("p", 6).cast("int").alias("w")).agg(*[F.bit_or(F.when(F.col(f"w{k}"), bit).otherwise(0)).alias(f"b{k}") for k in range(len(where))])
    got, out = words.toArrow(), []
    for k in range(len(where)):
        out.append(np.zeros(1 << (bits - 6), np.int64))
        out[k][got.column("w").to_numpy()] = got.column(f"b{k}").to_numpy()
    return out


def bit_map(df: DataFrame, key: str) -> np.ndarray:
    return bit_maps(df, key, F.lit(True))[0]


def hot_map(df: DataFrame, key: str) -> np.ndarray:
    return bit_maps(df, key, F.lit(True), bits=HOT_BITS)[0]


def in_hot(bits: np.ndarray, key: str) -> Column:
    """Whether the key may be in a map of HOT_BITS bits; false for all if it is empty."""
    if not bits.any():
        return F.lit(False)
    # One literal: each of 2048 would be a node of every plan that the driver parses, copies and keeps.
    words = ",".join(map(str, bits.view("<u4").tolist()))
    return F.expr(f"getbit(cast(split('{words}', ',') as array<bigint>)[cast(shiftright(`{key}` & {(1 << HOT_BITS) - 1}, 5) as int)], cast(`{key}` & 31 as int)) = 1")


def in_map(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    p = keys & ((1 << MAP_BITS) - 1)
    return (bits[p >> 6] >> (p & 63) & 1).astype(bool)


def maybe_in(spark, bits: np.ndarray):
    held = spark.sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def test(keys: pd.Series) -> pd.Series:
        return pd.Series(in_map(held.value, keys.to_numpy()))

    return test


#: Rows of one key that a join meets in one task; keys with more are dealt to SALTS tasks.
HOT_ROWS, SALTS = 1 << 12, 64


def joined(many: DataFrame, few: DataFrame, on: list[str], hot: np.ndarray, key: str, spread: Column, how: str = "inner") -> DataFrame:
    """A join by sorting, in which keys in the map of hot ones are dealt by ``spread`` and their rows of ``few`` go to all salts."""
    if not hot.any():
        return many.join(few.hint("merge"), on, how)
    many = many.withColumn("_salt", F.when(in_hot(hot, key), F.pmod(spread, F.lit(SALTS))).otherwise(0))
    few = few.withColumn("_salt", F.explode(F.when(in_hot(hot, key), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))).cast("array<long>")))
    return many.join(few.hint("merge"), [*on, "_salt"], how).drop("_salt")
