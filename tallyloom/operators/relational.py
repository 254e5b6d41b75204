"""Dedup, duplicate, orphan, lookup and classification operators over DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.text import contains_any_case, normal_key
from tallyloom.session import materialize


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the first by ``order``, then by all other columns so reruns agree.

    The ``rank <= 1`` filter lets Spark drop losers in every map task before the shuffle
    (``WindowGroupLimit``), so a hot key sends one row per task.
    """
    rest = [c for c in df.columns if c not in {*keys, *order}]
    window = Window.partitionBy(*keys).orderBy(*order, *rest)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def keep_ties(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """All rows per key that share the smallest ``order``.

    Distinct keys and orders come from a hash aggregate, the smallest per key from a rank that drops losers
    in every map task; rows are then kept by a semi join, whose hot partitions adaptive execution can
    split, which one window partition could not be.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    best = df.select(*keys, *order).distinct().withColumn("_rank", F.row_number().over(first)).where("_rank = 1")
    best = best.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(o).alias(f"_o_{o}") for o in order])
    same = [df[k].eqNullSafe(best[f"_k_{k}"]) for k in keys]
    same += [df[o].eqNullSafe(best[f"_o_{o}"]) for o in order]
    return df.join(best, reduce(Column.__and__, same), "left_semi")


def duplicates(df: DataFrame, keys: Sequence[str], count: str = "copies") -> DataFrame:
    """Keys that occur more than once, with the number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count)).where(F.col(count) > 1)


def variants(df: DataFrame, key: str, value: str) -> DataFrame:
    """Rows whose key has more than one distinct ``value``; a missing value is one of them.

    Distinct pairs are taken first, then counted per key: two hash aggregates with partial results, in
    which a missing value is a group. The rows themselves are then kept by a semi join.
    """
    mixed = df.groupBy(key, value).agg(F.lit(1).alias("_one")).groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return df.join(mixed.select(key), key, "left_semi")


def orphans(df: DataFrame, parent: DataFrame, keys: Mapping[str, str]) -> DataFrame:
    """Rows without a parent; ``keys`` maps child to parent columns. A missing key is an orphan."""
    known = parent.select(*[F.col(p).alias(f"_p_{c}") for c, p in keys.items()])
    same = reduce(Column.__and__, [df[c] == known[f"_p_{c}"] for c in keys])
    return df.join(known, same, "left_anti")


def with_parents(df: DataFrame, parents: Sequence[tuple[DataFrame, Mapping[str, str]]]) -> DataFrame:
    """Left outer join of one or more parents; ``keys`` maps child to parent columns."""
    for parent, keys in parents:
        same = reduce(Column.__and__, [df[c] == parent[p] for c, p in keys.items()])
        df = df.join(parent, same, "left")
    return df


def full_outer_lookup(facts: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Full outer join of facts with a lookup on a shared key.

    Built from a left join and the lookup rows no fact uses. Facts may have few, very hot keys:
    a left join can broadcast the lookup or split hot partitions, a full outer join cannot.
    """
    used = facts.select(key).where(F.col(key).isNotNull()).distinct()
    unused = lookup.join(used, key, "left_anti")
    return facts.join(lookup, key, "left").unionByName(unused, allowMissingColumns=True)


def lookup_set(df: DataFrame, column: str) -> DataFrame:
    """Distinct lookup spellings of a sheet column, blanks left out, as column ``entry``."""
    spelled = df.select(normal_key(F.col(column).cast("string")).alias("entry"))
    present = df[column].isNotNull() & (df[column].cast("string") != "")
    return spelled.where(present).distinct()


def flag_membership(df: DataFrame, value: Column, lookup: DataFrame, flag: str) -> DataFrame:
    """Add a boolean column: is ``value`` one of the distinct entries of ``lookup``?

    No broadcast is forced. Spark broadcasts the list while its size is below the threshold and
    otherwise shuffles, splitting hot values of the left side.
    """
    marked = lookup.select(F.col("entry").alias("_entry"), F.lit(True).alias("_hit"))
    joined = df.withColumn("_value", value).join(marked, F.col("_value") == F.col("_entry"), "left")
    return joined.withColumn(flag, F.coalesce("_hit", F.lit(False))).drop("_value", "_entry", "_hit")


def flag_memberships(df: DataFrame, value: Column, lookups: Mapping[str, DataFrame]) -> DataFrame:
    """Add a boolean column per lookup for the same value: the lists are merged, so one join answers all."""
    marked = [lookup.select("entry", *[F.lit(n == name).alias(n) for n in lookups]) for name, lookup in lookups.items()]
    merged = reduce(DataFrame.union, marked).groupBy(F.col("entry").alias("_entry"))
    merged = merged.agg(*[F.max(n).alias(f"_{n}") for n in lookups])
    joined = df.withColumn("_value", value).join(merged, F.col("_value") == F.col("_entry"), "left")
    flags = {n: F.coalesce(f"_{n}", F.lit(False)) for n in lookups}
    return joined.withColumns(flags).drop("_value", "_entry", *[f"_{n}" for n in lookups])


def classify(
    df: DataFrame, name: str, rules: Sequence[tuple[int, str]], otherwise: int, into: str
) -> DataFrame:
    """One row per matching rule ``(class, contained text)``, or the fallback class when none does.

    A single pass: the matched classes of a row form an array that is exploded.
    """
    hits = [F.when(contains_any_case(F.col(name), text), F.lit(code)) for code, text in rules]
    found = F.array_compact(F.array(*hits))
    classes = F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(otherwise)))
    return df.withColumn(into, F.explode(classes))


def number_rows(
    df: DataFrame, order: Sequence[str], into: str, start: int = 0, unique: bool = False
) -> DataFrame:
    """Consecutive numbers in the order of ``order``, then of all other columns unless it is ``unique``.

    Rows are range-partitioned and sorted, written once, and numbered by the position inside their
    range plus the size of the ranges before it. No task sees more than one range, and the numbers
    do not depend on where the range borders fall.
    """
    rest = [] if unique else [c for c in df.columns if c not in order]
    ordered = df.repartitionByRange(*order, *rest).sortWithinPartitions(*order, *rest)
    placed = materialize(ordered.withColumn("_place", F.monotonically_increasing_id()), "numbered")
    split = placed.select(
        *df.columns,
        F.shiftright("_place", 33).alias("_range"),
        F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)).alias("_offset"),
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        split.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    )
    return split.join(starts, "_range").select(
        *df.columns, (F.col("_start") + F.col("_offset") + F.lit(start)).cast("bigint").alias(into)
    )
