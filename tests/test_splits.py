import datetime as dt
import random

import pytest

from pyspark.sql import functions as F

from tallyloom.operators import splits
from tallyloom.operators.splits import find_splits, splits_summary

SCHEMA = "row_index bigint, cardholder string, merchant string, date timestamp_ntz, total double"
DAY = dt.timedelta(days=1)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        previous, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(previous[j] + 1, row[-1] + 1, previous[j - 1] + (x != y)))
    return row[-1]


def expected_groups(rows):
    """First-fit grouping stated directly: row_index -> row_index of the group's first row."""
    leaders, home = {}, {}
    for index, holder, merchant, date, _ in sorted(rows):
        for leader in leaders.setdefault(holder, []):
            old, gap = leader[1], 0
            if date and leader[2]:
                gap = (date - leader[2]).days
            a, b = old or "", merchant or ""
            longest = max(1, len(a), len(b))
            if gap <= 4 and 5 * distance(a, b) <= 2 * longest:
                home[index] = leader[0]
                break
        else:
            leaders[holder].append((index, merchant, date))
            home[index] = index
    return home


def found_groups(spark, rows, **options):
    result = find_splits(spark.createDataFrame(rows, SCHEMA), None, **options)
    return {r.row_index: r.split_index for r in result.collect()}


def test_four_rows_give_two_splits(spark):
    day = dt.datetime(2022, 3, 24)
    rows = [
        (2, "CH1", "MCH1", day, 4100.01),
        (3, "CH1", "MCH1", day, 1200.01),
        (4, "CH1", "MCH 12345", day, 2200.01),
        (5, "CH1", "MCH 12346", day, 3200.01),
    ]
    members = find_splits(spark.createDataFrame(rows, SCHEMA), 5000.0)
    got = {tuple(r) for r in splits_summary(members).collect()}
    assert got == {("CH1", 2, 2, 5300.02), ("CH1", 4, 2, 5400.02)}


def test_total_reaches_limit(spark):
    day = dt.datetime(2020, 5, 16)
    rows = [(1, "Me", "Merchant", day, 4100.01), (2, "Me", "Merchant", day, 4100.01)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert find_splits(df, 200.0, max_days=2, similarity=90).count() == 2
    assert find_splits(df, 8200.03).count() == 0


def random_rows(seed, count, ordered, day_step, blanks):
    pick = random.Random(seed)
    names = ["ACME", "ACME 1", "ACME 12", "Acne", "BOLT CO", "BOLT C0", "BELT CO", "", "Ünïon", "UNION", "cafe", "café"]
    date, rows = dt.datetime(2024, 1, 1), []
    for index in range(count):
        step = pick.choice(day_step) if ordered else pick.choice(day_step) - 3
        date += dt.timedelta(days=step, hours=pick.choice([0, 0, 5, 23]))
        merchant = None if pick.random() < 0.05 else pick.choice(names)
        when = None if blanks and pick.random() < 0.05 else date
        holder = "hot" if pick.random() < 0.6 else f"h{pick.randrange(6)}"
        rows.append((index, holder, merchant, when, float(pick.randrange(1, 900))))
    return rows


@pytest.mark.parametrize("ordered", [True, False])
@pytest.mark.parametrize("blanks", [True, False])
@pytest.mark.parametrize("fold_limit,batch", [(1000, 1000), (4, 12)])
def test_matches_direct_loop(spark, ordered, blanks, fold_limit, batch):
    for seed, steps in [(1, [0, 0, 1, 7])] if fold_limit < 1000 else [(1, [0, 0, 1, 7]), (2, [0, 3, 5, 9])]:
        rows = random_rows(seed, 60 if fold_limit < 1000 else 150, ordered, steps, blanks)
        got = found_groups(spark, rows, fold_limit=fold_limit, batch=batch)
        assert got == expected_groups(rows)


def test_partitioning_does_not_matter(spark):
    rows = random_rows(9, 100, False, [0, 1, 4], True)
    df = spark.createDataFrame(rows, SCHEMA)
    results = [
        sorted(map(tuple, find_splits(df.repartition(n), 900.0, fold_limit=20, batch=30).collect()))
        for n in (1, 4, 64)
    ]
    assert results[0] == results[1] == results[2]
    assert results[0]


def test_repeated_rows_of_a_hot_purchase(spark):
    day = dt.datetime(2024, 5, 1)
    rows = [(i, "hot", "SHOP", day, 1.0) for i in range(500)] + [(500 + i, "x", "SHOP", day, 1.0) for i in range(5)]
    members = find_splits(spark.createDataFrame(rows, SCHEMA), 400.0)
    assert members.count() == 500
    assert {r.split_total for r in members.select("split_total").distinct().collect()} == {500.0}


def test_tiny_and_huge_totals(spark):
    day = dt.datetime(2024, 5, 1)
    rows = [(1, "tiny", "S", day, 0.0000004), (2, "tiny", "S", day, 0.0000004), (3, "huge", "S", day, 6e22), (4, "huge", "S", day, 4e22)]
    rows += [(5, "none", "S", day, None), (6, "none", "S", day, None)]
    groups = find_splits(spark.createDataFrame(rows, SCHEMA), None).select("cardholder", "split_total").distinct()
    assert {tuple(r) for r in groups.collect()} == {("tiny", 0.0000008), ("huge", 1e23), ("none", None)}


def clique_rows(seed, count, ordered, days, blanks=0.0, holders=1):
    """Merchants of three families, all names of a family similar, over so many days without a five-day gap."""
    pick = random.Random(seed)
    names = [f"{stem} {k}" for stem in ("GROCERY MART", "FUEL AND GO", "HARDWARE XX") for k in range(30)]
    rows = []
    for index in range(count):
        day = days * index / count if ordered else pick.uniform(0, days)
        date = dt.datetime(2020, 1, 1) + dt.timedelta(days=int(day), hours=int(24 * (day % 1)) if ordered else pick.choice([0, 7, 23]))
        when = None if pick.random() < blanks else date
        rows.append((index, f"h{index % holders}", pick.choice(names), when, float(pick.randrange(1, 900))))
    return rows


@pytest.mark.parametrize("ordered", [True, False])
@pytest.mark.parametrize("blanks", [0.0, 0.1])
def test_long_sessions_of_cliques_match_the_loop(spark, ordered, blanks):
    rows = clique_rows(5, 700, ordered, 200, blanks, holders=2)
    assert found_groups(spark, rows, fold_limit=50) == expected_groups(rows)


def test_first_purchase_without_a_date_takes_all(spark):
    rows = clique_rows(6, 300, True, 100)
    rows = [(-1, "h0", "FUEL AND GO 7", None, 1.0), *rows]
    assert found_groups(spark, rows, fold_limit=50) == expected_groups(rows)


def test_tangled_families_beside_cliques(spark):
    """Similar to neighbours only: such a chain of names is no clique and is folded or peeled as before."""
    pick = random.Random(4)
    chain = ["abcdefghij", "abcdefghXY", "abcdefPQXY", "abcdRSPQXY", "abTURSPQXY"]
    rows = [(k, i, m if pick.random() < 0.5 else pick.choice(chain), d, t) for k, i, m, d, t in clique_rows(7, 500, True, 150)]
    for fold_limit in (400, 60):
        assert found_groups(spark, rows, fold_limit=fold_limit, batch=40) == expected_groups(rows)


def test_default_options_reach_long_sessions(spark):
    rows = clique_rows(8, 2500, True, 400)
    assert found_groups(spark, rows) == expected_groups(rows)


def test_jobs_grow_with_the_logarithm_of_the_days(spark):
    def jobs(days):
        context = spark.sparkContext
        context.setJobGroup(f"days-{days}", "")
        find_splits(spark.createDataFrame(clique_rows(9, 600, True, days), SCHEMA), None, fold_limit=50).count()
        context.setLocalProperty("spark.jobGroup.id", None)
        return len(context.statusTracker().getJobIdsForGroup(f"days-{days}"))

    short, long, longer = jobs(40), jobs(400), jobs(800)
    assert longer - long <= (long - short) / 2 + 4 and long <= 2 * short


def test_merchants_are_compared_and_not_purchases(spark):
    rows = clique_rows(10, 3000, True, 60)
    df = spark.createDataFrame(rows, SCHEMA).select(F.col("cardholder").alias("holder"), F.lit(1).alias("session"), F.col("merchant").alias("shop"))
    shops = df.distinct()
    m = shops.count()
    calls = splits._compared(shops).agg(F.sum(F.size("others"))).first()[0]
    assert calls == m * m and calls < len(rows) * 3 * m
    families = {r["shop"]: r["family"] for r in splits.merchant_families(df).collect()}
    names = sorted(families)
    for a in names:
        near = [b for b in names if 5 * distance(a, b) <= 2 * max(len(a), len(b))]
        assert families[a] == min(near)


def test_families_do_not_depend_on_blocks(spark, monkeypatch):
    pick = random.Random(2)
    names = ["".join(pick.choice("abc") for _ in range(pick.randint(1, 6))) for _ in range(120)]
    df = spark.createDataFrame([("h", 1, n) for n in names], "holder string, session int, shop string")
    want = {tuple(r) for r in splits.merchant_families(df).collect()}
    monkeypatch.setattr(splits, "FAMILY_BLOCK", 7)
    assert {tuple(r) for r in splits.merchant_families(df).collect()} == want
    alone = {n for n in names if all(n == o or 5 * distance(n, o) > 2 * max(len(n), len(o)) for o in names)}
    assert alone <= {shop for *_, shop, family in want if family == shop}
