"""Exact distinct counts of whole-number ids as bitmaps that add up.

Ids fall into buckets of 32,768; a bucket's bitmap is 4 KB. States of days, runs or regions are united later without going
back to rows, which counts cannot be. Meant for dense ids; ids spread thinly cost a bitmap each.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_bitmaps(df: DataFrame, ids: str, groups: Sequence[str] = ()) -> DataFrame:
    """States (groups, bucket, bitmap) of the distinct ``ids`` of each group; missing ids are left out."""
    present = df.where(F.col(ids).isNotNull())
    placed = present.select(*groups, F.bitmap_bucket_number(ids).alias("bucket"), F.bitmap_bit_position(ids).alias("_at"))
    return placed.groupBy(*groups, "bucket").agg(F.bitmap_construct_agg("_at").alias("bitmap"))


def unite(states: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """States of fewer groups: an id counts once however many of the united states have it."""
    return states.groupBy(*groups, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def count_ids(states: DataFrame, groups: Sequence[str] = (), into: str = "n") -> DataFrame:
    """Distinct ids of each group of united states."""
    return states.groupBy(*groups).agg(F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).cast("bigint").alias(into))


def distinct_where(df: DataFrame, ids: str, conditions: Mapping[str, Column]) -> DataFrame:
    """One row: for each name the distinct ids of the rows that meet its condition.

    All conditions share one aggregate by bucket, where ``count(DISTINCT)`` under several conditions would copy every
    row once for each of them.
    """
    at = F.bitmap_bit_position(ids)
    bitmaps = [F.bitmap_construct_agg(F.when(condition, at)).alias(name) for name, condition in conditions.items()]
    buckets = df.where(F.col(ids).isNotNull()).groupBy(F.bitmap_bucket_number(ids).alias("_bucket")).agg(*bitmaps)
    return buckets.agg(*[F.coalesce(F.sum(F.bitmap_count(name)), F.lit(0)).cast("bigint").alias(name) for name in conditions])
