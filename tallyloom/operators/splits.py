"""Split purchases: greedy grouping of a cardholder's transactions by date and merchant.

Per cardholder and in sheet order, a row joins the first group whose first row (its *leader*) is at
most four whole days older and has a merchant at least 60 % similar; otherwise it opens a group. The
outcome depends on the order, so it is neither a join nor a graph component. These exact facts keep
the ordered part small and everything else parallel:

* Rows that repeat a cardholder's merchant and date end up in the group of the first of them, so
  they are aggregated to one *purchase* before anything else, map-side first.
* Where all later purchases are at least five days after all earlier ones in time and in the sheet,
  no group crosses the gap. Such *sessions* are found on one row per cardholder and day.
* A session up to ``fold_limit`` purchases is folded as one array, inside the JVM.
* Merchants of a longer session fall into families: the components of their similarity. No group crosses
  a family, and where all merchants of a family are similar to each other (a clique), only dates decide: the next leader
  is the first purchase five days or more after the last one, which makes leaders the orbit of the first purchase under one
  function. It is followed by pointer doubling, so the jobs grow with the logarithm of a session's days, and
  each purchase then finds its leader by an equal join on five-day periods. Rows may be in any order: leaders' dates ascend
  in every order, as an earlier-dated row always joins an existing group.
* The other families are cut into sessions of their own, mostly short ones. What stays long is peeled in rounds: the leaders among its first undecided purchases are folded
  from a bounded batch, then every undecided purchase is tested against them in parallel. A purchase
  no earlier leader took can only be taken by these, in their order, so each round is final.
* When a long session runs forward in time, a leader reaches no further than the next five-day
  period. Its periods are then peeled one after the other, all cardholders together, and each
  purchase takes part only in the rounds of its own period.

No step collects an unbounded group, and each cut of the lineage is a table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType

from tallyloom.functions.cells import DAY_MICROS, micros
from tallyloom.functions.text import similar_at_least
from tallyloom.session import materialize, scratch_path

MAX_DAYS = 4
SIMILARITY = 60
FAMILY_BLOCK = 200  # merchants that one row is compared with
LARGEST_BATCH = 1000  # up to here Spark applies a rank limit before the shuffle
_EXACT = "decimal(28,12)"  # what fits is added exactly, in any order; the rest as floating point
_LEADER = "struct<pos:bigint,shop:string,at:bigint>"


def _takes(leader: Column, row: Column, max_days: int, similarity: int) -> Column:
    """Does the group of ``leader`` accept ``row``? A missing date counts as no gap."""
    gap = F.coalesce(row["at"] - leader["at"], F.lit(0))
    near = gap < F.lit((max_days + 1) * DAY_MICROS)
    return near & similar_at_least(leader["shop"], row["shop"], similarity)


def _first_taker(leaders: Column, row: Column, max_days: int, similarity: int) -> Column:
    takers = F.filter(leaders, lambda leader: _takes(leader, row, max_days, similarity))
    return F.get(takers, F.lit(0))["pos"]


def _fold(purchases: Column, max_days: int, similarity: int) -> Column:
    """Leaders and, per purchase of the ordered array, the position of its group's leader."""

    def step(state: Column, row: Column) -> Column:
        home = F.coalesce(_first_taker(state["leaders"], row, max_days, similarity), row["pos"])
        opened = F.array(F.struct(row["pos"].alias("pos"), row["shop"].alias("shop"), row["at"].alias("at")))

        def settle(place: Column) -> Column:
            grown = F.concat(state["leaders"], opened)
            leaders = F.when(place == row["pos"], grown).otherwise(state["leaders"])
            return F.struct(
                leaders.alias("leaders"), F.concat(state["homes"], F.array(place)).alias("homes")
            )

        # Binding the group through a one-element array evaluates the search once per step.
        return F.get(F.transform(F.array(home), settle), F.lit(0))

    start = F.struct(
        F.array().cast(f"array<{_LEADER}>").alias("leaders"), F.array().cast("array<bigint>").alias("homes")
    )
    return F.aggregate(purchases, start, step)


def _ordered(*extra: str) -> Column:
    return F.sort_array(F.collect_list(F.struct("pos", "shop", "at", *extra)))


def _purchases(rows: DataFrame) -> DataFrame:
    """One row per cardholder, merchant and date: first position, rows, total."""
    return rows.groupBy("holder", "shop", "at").agg(
        F.min("pos").alias("pos"), F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"), F.sum("rest").alias("rest")
    )


def _with_sessions(purchases: DataFrame, max_days: int) -> DataFrame:
    """Number the independent sessions of each cardholder and add their sizes.

    The windows run over one row per cardholder and day, so the calendar bounds them.
    """
    dated = purchases.withColumn("day", F.floor(F.col("at") / DAY_MICROS))
    days = dated.groupBy("holder", "day").agg(
        F.min("at").alias("first_at"),
        F.max("at").alias("last_at"),
        F.min("pos").alias("first_pos"),
        F.max("pos").alias("last_pos"),
        F.count(F.lit(1)).alias("purchases"),
    )
    up = Window.partitionBy("holder").orderBy(F.asc_nulls_first("day"))
    down = Window.partitionBy("holder").orderBy(F.desc_nulls_last("day"))
    so_far = up.rowsBetween(Window.unboundedPreceding, 0)
    earlier = up.rowsBetween(Window.unboundedPreceding, -1)
    from_here = down.rowsBetween(Window.unboundedPreceding, 0)
    gap = F.col("first_at") - F.max("last_at").over(earlier)
    in_order = F.max("last_pos").over(earlier) < F.min("first_pos").over(from_here)
    forward = F.coalesce(F.max("last_pos").over(earlier) < F.col("first_pos"), F.lit(True))
    undated = F.max(F.col("day").isNull()).over(Window.partitionBy("holder"))
    cut = (gap >= (max_days + 1) * DAY_MICROS) & in_order & ~undated
    whole = Window.partitionBy("holder", "session")
    sessions = (
        days.withColumns({"cut": F.coalesce(cut.cast("int"), F.lit(0)), "forward": forward & ~undated})
        .withColumn("session", F.sum("cut").over(so_far))
        .withColumns({"size": F.sum("purchases").over(whole), "forward": F.min("forward").over(whole)})
        .select(F.col("holder").alias("_holder"), F.col("day").alias("_day"), "session", "size", "forward")
    )
    same = (dated["holder"] == sessions["_holder"]) & dated["day"].eqNullSafe(sessions["_day"])
    return dated.join(sessions, same).drop("_holder", "_day", "day")


def _fold_sessions(purchases: DataFrame, max_days: int, similarity: int) -> DataFrame:
    """Groups of sessions whose size is bounded: one array per session.

    The partition count is given so that adaptive execution does not merge these small but
    computation-heavy partitions; the aggregate then needs no shuffle of its own.
    """
    parts = int(purchases.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread_out = purchases.repartition(parts, "holder", "session")
    arrays = spread_out.groupBy("holder", "session").agg(_ordered("n", "amount", "rest").alias("rows"))
    folded = arrays.withColumn("homes", _fold(F.col("rows"), max_days, similarity)["homes"])
    pairs = F.arrays_zip("rows", "homes")
    return folded.select("holder", F.explode(pairs).alias("pair")).select(
        "holder", "pair.rows.*", F.col("pair.homes").alias("home")
    )


def _compared(shops: DataFrame) -> DataFrame:
    """Each merchant of a session with blocks of the session's merchants, itself among them.

    Merchants, not purchases, are compared, so a pair is measured once in each direction however often it is bought from.
    """
    sizes = shops.groupBy("holder", "session").agg(F.ceil(F.count(F.lit(1)) / FAMILY_BLOCK).alias("blocks"))
    dealt = shops.join(sizes, ["holder", "session"]).withColumn("block", F.pmod(F.xxhash64("shop"), F.col("blocks")))
    blocks = dealt.groupBy("holder", "session", "block").agg(F.collect_list("shop").alias("others"))
    return shops.join(blocks, ["holder", "session"])


def merchant_families(purchases: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """holder, session, shop, family: the smallest merchant of a clique, or NULL where similarity is not transitive.

    A merchant's neighbourhood is kept as its size, smallest member and a checksum that adds up over blocks. Merchants form a
    clique of their own exactly if as many share a neighbourhood as it has members.
    """
    shops = materialize(purchases.select("holder", "session", "shop").distinct(), "merchants")
    near = F.filter("others", lambda other: similar_at_least(F.col("shop"), other, similarity))
    summed = F.transform(
        F.array(near),
        lambda found: F.struct(
            F.size(found).alias("n"),
            F.array_min(found).alias("low"),
            F.aggregate(found, F.lit(0).cast("bigint"), lambda seen, shop: seen.bitwiseXOR(F.xxhash64(shop))).alias("sum"),
        ),
    )
    around = _compared(shops).select("holder", "session", "shop", F.get(summed, F.lit(0)).alias("part"))
    around = around.groupBy("holder", "session", "shop").agg(
        F.sum("part.n").alias("n"), F.min("part.low").alias("low"), F.bit_xor("part.sum").alias("sum")
    )
    around = materialize(around, "neighbourhoods")
    shared = around.groupBy("holder", "session", "n", "low", "sum").agg(F.count(F.lit(1)).alias("members"))
    joined = around.join(shared, ["holder", "session", "n", "low", "sum"])
    return joined.select("holder", "session", "shop", F.when(F.col("members") == F.col("n"), F.col("low")).alias("family"))


_FAMILY = ["holder", "session", "family"]


def _orbit_leaders(purchases: DataFrame, max_days: int) -> DataFrame:
    """Leaders (family, pos, at) of cliques: from the first purchase always the first one far enough ahead.

    The window runs over the distinct dates of a family. Rounds double the number of known leaders.
    """
    span = (max_days + 1) * DAY_MICROS
    times = purchases.where("at IS NOT NULL").groupBy(*_FAMILY, "at").agg(F.min("pos").alias("pos"))
    ahead = Window.partitionBy(*_FAMILY).orderBy(F.desc("at")).rangeBetween(Window.unboundedPreceding, -span)
    jumps = times.withColumn("to", F.min(F.struct("pos", "at")).over(ahead)).where("to IS NOT NULL")
    jumps = materialize(jumps.select(*_FAMILY, "pos", F.col("to.pos").alias("to_pos"), F.col("to.at").alias("to_at")), "jumps")
    leaders = purchases.groupBy(*_FAMILY).agg(F.min(F.struct("pos", "at")).alias("first")).select(*_FAMILY, "first.pos", "first.at")
    leaders = materialize(leaders, "leaders")
    while True:
        dated = leaders.where("at IS NOT NULL").select(*_FAMILY, "pos")  # an undated leader takes everything
        more = dated.join(jumps, [*_FAMILY, "pos"]).select(*_FAMILY, F.col("to_pos").alias("pos"), F.col("to_at").alias("at"))
        more = materialize(more, "more-leaders")
        if more.isEmpty():
            return leaders
        leaders = materialize(leaders.union(more), "leaders")
        beyond = jumps.select(*_FAMILY, F.col("pos").alias("to_pos"), F.col("to_pos").alias("_pos"), F.col("to_at").alias("_at"))
        twice = jumps.drop("to_at").join(beyond, [*_FAMILY, "to_pos"])
        jumps = materialize(twice.select(*_FAMILY, "pos", F.col("_pos").alias("to_pos"), F.col("_at").alias("to_at")), "jumps")


def _clique_groups(purchases: DataFrame, max_days: int) -> DataFrame:
    """Groups of families in which all merchants are similar: a purchase joins the first leader less than the span before it."""
    span = (max_days + 1) * DAY_MICROS
    leaders = _orbit_leaders(purchases, max_days)
    bounds = purchases.groupBy(*_FAMILY).agg(F.min("at").alias("least"), F.max("at").alias("most"), F.min("pos").alias("first"))
    bounds = materialize(bounds, "family-bounds")
    before = F.lag("at").over(Window.partitionBy(*_FAMILY).orderBy("pos"))
    reach = leaders.withColumn("after", before + F.lit(span)).join(bounds, _FAMILY)
    reach = reach.select(
        *_FAMILY,
        F.col("pos").alias("home"),
        F.coalesce("after", "least").alias("low"),
        F.least(F.col("at") + F.lit(span - 1), F.col("most")).alias("high"),  # LEAST skips a missing date
    )
    period = lambda name: F.floor(F.col(name) / span)
    reach = reach.where("low IS NOT NULL").withColumn("period", F.explode(F.sequence(period("low"), period("high"))))
    columns = ["holder", "pos", "shop", "at", "n", "amount", "rest", "home"]
    dated = purchases.where("at IS NOT NULL").withColumn("period", period("at")).join(reach, [*_FAMILY, "period"])
    dated = dated.where(F.col("at").between(F.col("low"), F.col("high"))).select(*columns)
    undated = purchases.where("at IS NULL").join(bounds.withColumnRenamed("first", "home"), _FAMILY).select(*columns)
    return dated.unionByName(undated)


def _first_leaders(undecided: DataFrame, max_days: int, similarity: int, batch: int) -> DataFrame:
    """Leaders among the first ``batch`` undecided purchases of each session, as an array.

    The rank limit is applied in every map task, so a hot session sends ``batch`` rows per task.
    """
    by_position = Window.partitionBy("holder", "session").orderBy("pos")
    head = undecided.withColumn("rank", F.row_number().over(by_position)).where(F.col("rank") <= batch)
    folded = _fold(_ordered(), max_days, similarity)["leaders"]
    return head.groupBy("holder", "session").agg(folded.alias("leaders"))


def _settle(undecided: DataFrame, leaders: DataFrame, path: str, max_days: int, similarity: int) -> DataFrame:
    """Test undecided purchases against a block of leaders, store the answers, return the rest."""
    earlier = F.filter("leaders", lambda leader: leader["pos"] <= F.col("pos"))
    home = _first_taker(earlier, F.struct("shop", "at"), max_days, similarity)
    tested = undecided.join(leaders, ["holder", "session"], "left").withColumn("home", home).drop("leaders")
    tested = tested.withColumn("decided", F.col("home").isNotNull())
    tested.write.partitionBy("decided").parquet(path)
    stored = undecided.sparkSession.read.schema(tested.schema).parquet(path)
    return stored.where("NOT decided").select(undecided.columns)


def _peel_sessions(purchases: DataFrame, max_days: int, similarity: int, batch: int) -> DataFrame:
    """Groups of sessions of any size, in rounds of at most ``batch`` purchases per session.

    Sessions that run forward in time are worked through by periods of ``max_days + 1`` days, all
    sessions of a period together; the others form one period of their own. The periods listed on
    the driver are bounded by the calendar. Purchases are stored by period, in balanced files, so a
    round reads its period only.
    """
    spark = purchases.sparkSession
    source, base, rounds = scratch_path(spark, "periods"), scratch_path(spark, "peeled"), 0
    span = (max_days + 1) * DAY_MICROS
    period = F.when(F.col("forward"), F.floor(F.col("at") / span))
    columns = ["holder", "session", "pos", "shop", "at", "n", "amount", "rest"]
    by_period = purchases.select(*columns, period.alias("period"))
    by_period.hint("rebalance", "period").write.partitionBy("period").parquet(source)
    dated = spark.read.schema(by_period.schema).parquet(source)
    periods = [row.period for row in dated.select("period").distinct().orderBy("period").collect()]
    previous, carried = None, []
    for current in periods:
        rest = dated.where(F.col("period").eqNullSafe(F.lit(current))).select(*columns)
        in_reach = carried if previous is not None and current == previous + 1 else []
        for leaders in in_reach:
            rest = _settle(rest, leaders, f"{base}/round={rounds}", max_days, similarity)
            rounds += 1
        opened = []
        while not rest.isEmpty():
            leaders = materialize(_first_leaders(rest, max_days, similarity, batch), "leaders")
            rest = _settle(rest, leaders, f"{base}/round={rounds}", max_days, similarity)
            rounds += 1
            opened.append(leaders)
        previous, carried = current, opened
    stored = [*dated.select(*columns, F.col("pos").alias("home")).schema.fields]
    stored += [StructField("decided", BooleanType()), StructField("round", IntegerType())]
    done = spark.read.schema(StructType(stored)).parquet(base).where("decided")
    return done.select("holder", "pos", "shop", "at", "n", "amount", "rest", "home")


def _rows(df: DataFrame, order: str, cardholder: str, merchant: str, date: str, total: str) -> DataFrame:
    paid = F.col(total).cast("double")
    exact = paid.try_cast(_EXACT)
    return df.where(F.col(cardholder).isNotNull()).select(
        F.col(order).cast("bigint").alias("pos"),
        F.col(cardholder).alias("holder"),
        F.coalesce(merchant, F.lit("")).alias("shop"),
        micros(F.col(date)).alias("at"),
        exact.alias("amount"),
        F.when(exact.isNull(), paid).alias("rest"),
    )


def split_purchases(
    df: DataFrame,
    limit: float | None,
    *,
    order: str = "row_index",
    cardholder: str = "cardholder",
    merchant: str = "merchant",
    date: str = "date",
    total: str = "total",
    max_days: int = MAX_DAYS,
    similarity: int = SIMILARITY,
    fold_limit: int = 1000,
    batch: int = LARGEST_BATCH,
) -> DataFrame:
    """Purchases in valid splits: more than one row and a total of at least ``limit``.

    Columns: ``holder``, ``shop`` and ``at`` identify the purchase (:func:`mark_splits` joins rows to
    them), ``split_index`` is the ``order`` of the group's first row, then ``split_rows`` and
    ``split_total``. ``order`` must be a unique whole number. With ``limit=None`` all groups are
    valid. Totals of up to 16 digits before and 12 behind the point are added exactly, so they do not
    depend on partitioning; larger ones are added as floating point numbers instead of failing.
    """
    if not 1 <= batch <= LARGEST_BATCH:
        raise ValueError(f"batch must be between 1 and {LARGEST_BATCH}")
    rows = _rows(df, order, cardholder, merchant, date, total)
    purchases = materialize(_purchases(rows), "purchases")
    staged = materialize(_with_sessions(purchases, max_days), "sessions")
    alone = staged.where("size = 1").select("holder", "pos", "shop", "at", "n", "amount", "rest", F.col("pos").alias("home"))
    short = staged.where(F.col("size").between(2, fold_limit))
    grouped = alone.unionByName(_fold_sessions(short, max_days, similarity))
    long = staged.where(F.col("size") > fold_limit)
    if not long.isEmpty():
        families = merchant_families(long, similarity)
        long = materialize(long.join(families, ["holder", "session", "shop"]), "long-sessions")
        grouped = grouped.unionByName(_clique_groups(long.where("family IS NOT NULL"), max_days))
        tangled = long.where("family IS NULL")
        if not tangled.isEmpty():
            tangled = materialize(_with_sessions(tangled.select(purchases.columns), max_days), "tangled-sessions")
            grouped = grouped.unionByName(_fold_sessions(tangled.where(F.col("size") <= fold_limit), max_days, similarity))
            peeled = tangled.where(F.col("size") > fold_limit)
            if not peeled.isEmpty():
                grouped = grouped.unionByName(_peel_sessions(peeled, max_days, similarity, batch))
    grouped = materialize(grouped, "groups")

    exact, rest = F.sum("amount").cast("double"), F.sum("rest")
    groups = grouped.groupBy("holder", "home").agg(
        F.sum("n").alias("split_rows"), F.coalesce(exact + rest, exact, rest).alias("split_total")
    )
    if limit is not None:
        groups = groups.where((F.col("split_rows") > 1) & (F.col("split_total") >= limit))
    return grouped.join(groups, ["holder", "home"]).select(
        "holder", "shop", "at", F.col("home").alias("split_index"), "split_rows", "split_total"
    )


def mark_splits(
    df: DataFrame,
    purchases: DataFrame,
    applies: Column | None = None,
    how: str = "left",
    cardholder: str = "cardholder",
    merchant: str = "merchant",
    date: str = "date",
) -> DataFrame:
    """Add ``split_index``, ``split_rows`` and ``split_total`` to the rows of split purchases.

    Rows outside any split, or for which ``applies`` is not true, get NULL, or vanish with ``inner``.
    """
    holder = F.col(cardholder) if applies is None else F.when(applies, F.col(cardholder))
    keyed = df.withColumns(
        {"_holder": holder, "_shop": F.coalesce(merchant, F.lit("")), "_at": micros(F.col(date))}
    )
    same = (
        (keyed["_holder"] == purchases["holder"])
        & (keyed["_shop"] == purchases["shop"])
        & keyed["_at"].eqNullSafe(purchases["at"])
    )
    return keyed.join(purchases, same, how).drop("_holder", "_shop", "_at", "holder", "shop", "at")


def find_splits(df: DataFrame, limit: float | None, **options) -> DataFrame:
    """Member rows of all valid splits, with the options of :func:`split_purchases`.

    Columns: ``order``, ``cardholder``, ``split_index``, ``split_rows``, ``split_total``.
    """
    names = {k: options.get(k, k) for k in ("cardholder", "merchant", "date")}
    members = mark_splits(df, split_purchases(df, limit, **options), how="inner", **names)
    order = options.get("order", "row_index")
    return members.select(order, names["cardholder"], "split_index", "split_rows", "split_total")


def splits_summary(members: DataFrame) -> DataFrame:
    """One row per split from its member rows."""
    return members.select("cardholder", "split_index", "split_rows", "split_total").distinct()
