"""Reproducible sampling and splitting.

``df.sample`` and ``randomSplit`` draw per partition, so the same seed
gives different rows after a repartition. These operators decide from the
row's key alone: ``h = ((key mod p) * A + B) mod p`` with p = 2^31 - 1. A and
B are derived from the seed and the operation, so two seeds, or a sample and a
split under one seed, are independent. Products stay below 2^62, so every
engine computes the same number.
"""
from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPACE = 2 ** 31 - 1
#: Prefixes of the hash space that sample_n counts.
PREFIXES = 4096


def hash_terms(seed: int, operation: str) -> tuple[int, int]:
    """Multiplier and offset for a seed and an operation."""
    raw = hashlib.sha256(f"{operation}:{int(seed)}".encode()).digest()
    return (1 + int.from_bytes(raw[:8], "big") % (SPACE - 1), int.from_bytes(raw[8:16], "big") % SPACE)


def key_hash(key: str, seed: int = 0, operation: str = "sample") -> Column:
    a, b = hash_terms(seed, operation)
    k = F.pmod(F.col(key).cast("long"), F.lit(SPACE))
    return F.pmod(k * F.lit(a) + F.lit(b), F.lit(SPACE))


def key_hash_sql(key: str, seed: int = 0, operation: str = "sample") -> str:
    """The same hash as SQL text, for non-negative keys."""
    a, b = hash_terms(seed, operation)
    return f"(({key} % {SPACE}) * {a} + {b}) % {SPACE}"


def sample_fraction(df: DataFrame, fraction: float, key: str, seed: int = 0,
                    method: str = "hash") -> DataFrame:
    """The rows whose key hash falls in the first ``fraction`` of the
    hash space; a pure filter, pushed into the scan's stage.
    ``method="random"`` is ``df.sample`` (Bernoulli per partition: the same
    seed picks other rows after a repartition)."""
    if method == "random":
        return df.sample(fraction=fraction, seed=seed)
    return df.filter(key_hash(key, seed) < F.lit(int(fraction * SPACE)))


def sample_n(df: DataFrame, n: int, key: str, seed: int = 0) -> DataFrame:
    """At most ``n`` rows, those with the smallest key hash (ties by
    key). Rows are counted per hash prefix first; only prefixes that are
    needed for ``n`` rows go on, so little more than ``n`` rows in all meet in
    the final top-k, however many tasks there are."""
    hashed = df.withColumn("_h", key_hash(key, seed, "sample_n"))
    prefix = F.floor(F.coalesce("_h", F.lit(0)) / F.lit(SPACE // PREFIXES + 1))
    counts = hashed.groupBy(prefix.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    last = (counts.withColumn("_b", F.coalesce(before, F.lit(0))).filter(F.col("_b") < n)
            .agg(F.max("_p"))).scalar()
    return hashed.filter(prefix <= last).orderBy("_h", key).limit(n).drop("_h")


def split(df: DataFrame, train_fraction: float, key: str, seed: int = 0,
          label: str = "split") -> DataFrame:
    """Tag every row ``train`` or ``test``; disjoint and complete."""
    cut = F.lit(int(train_fraction * SPACE))
    return df.withColumn(label, F.when(key_hash(key, seed, "split") < cut, F.lit("train"))
                         .otherwise(F.lit("test")))


def train_test(df: DataFrame, train_fraction: float, key: str, seed: int = 0,
               method: str = "hash"):
    """(train, test). ``method="random"`` is ``randomSplit`` (layout
    dependent, like ``df.sample``)."""
    if method == "random":
        train, test = df.randomSplit([train_fraction, 1 - train_fraction], seed=seed)
        return train, test
    tagged = split(df, train_fraction, key, seed, "_split")
    return (tagged.filter(F.col("_split") == "train").drop("_split"),
            tagged.filter(F.col("_split") == "test").drop("_split"))


def preview(df: DataFrame, n: int = 5, sample_fraction_of: float | None = None,
            key: str | None = None, seed: int = 0) -> DataFrame:
    """The first ``n`` rows, optionally of a key-hash sample."""
    if sample_fraction_of is not None and key is not None:
        df = sample_fraction(df, sample_fraction_of, key, seed)
    return df.limit(n)
