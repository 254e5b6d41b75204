"""The trie of rebuilt conversations, from adaptive radix trees over turn ids.

A turn's id is the 16 big-endian bytes of the MD5 of its role and text. A conversation is the bytes of its ids, a trie node a
prefix of whole ids; a node's name is its depth and the exclusive or of two 64-bit hashes of (depth, id) along its path, so the names
of any stretch of turns combine in any order.

1. Turns are numbered by a range partitioning, not by a window over a conversation, and every conversation is rebuilt from the
   first turns of its hundred's first conversation and its own: two joins, as one conversation gives its head to 99 others at most.
2. Conversations are cut into segments of ``SEGMENT`` turns. A segment knows the name at its start and the characters after it,
   from running totals over segments. So no task holds a conversation, whatever its length.
3. A task enters its segments into radix trees (``radix``), one for each name a segment starts at, and gives out the totals of
   turn-aligned depths once ``LIMIT`` turns are in. Trees of several tasks add up by name: members, smallest member, and the
   characters from the node to the end of every member.
4. The smallest member of a node represents it, and then it represents the rest of its path too. A second pass
   over the representing conversations adds up the characters and leaves that each represents below a node. Members' characters minus
   represented ones are the saved ones, since (n - 1) = n members - 1 representative.
5. Ends of a node are sorted over all tasks, joined to pieces of bounded length, and hashed piece by piece.

The order of turns is by number, none first, and among equal numbers by id. Names have 128 bits: two of 10**13 nodes are equal
with a chance of 10**-13.

Defined results: a missing role or text is empty; rows without a conversation id belong to none; repeated turns are turns;
other columns are ignored; an empty table gives no rows, not even the root.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.radix import RadixTree
from tallyloom.operators.relational import number_rows
from tallyloom.session import materialize

WIDTH = 16
SEGMENT = 64
LIMIT = 100_000
PIECE = 1 << 16
MOST_HEAD = 5

NAME = ["depth", "a", "b"]


def rebuilt_turns(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, depth, id, size) of all rebuilt conversations, and the conversations (conv_id, length)."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    turns = df.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("id"), F.length(text).alias("size"),
    )
    numbered = materialize(number_rows(turns, ["conv_id", "turn", "id"], "number", unique=True), "turns")
    convs = numbered.groupBy("conv_id").agg(F.min("number").alias("first"), F.count(F.lit(1)).alias("n"))
    convs = convs.withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_HEAD + 1)).cast("int"))
    convs = materialize(convs.withColumn("source", F.col("conv_id") - F.col("conv_id") % 100), "conversations")
    sources = convs.select(F.col("conv_id").alias("source"), F.col("first").alias("source_first"), F.col("n").alias("source_n"))
    heads = convs.join(sources, "source", "left").withColumn("m", F.least("h", F.coalesce("source_n", F.lit(0))))
    heads = materialize(heads, "heads")
    own = numbered.join(heads.select("conv_id", "first", "h", "m"), "conv_id").withColumn("k", F.col("number") - F.col("first") - F.col("h")).where("k >= 0")
    own = own.select("conv_id", (F.col("m") + F.col("k") + 1).alias("depth"), "id", "size")
    asked = heads.where("m > 0").select("conv_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)).alias("k"), (F.col("source_first") + F.col("k")).alias("number"))
    early = numbered.join(sources.select(F.col("source").alias("conv_id"), "source_first"), "conv_id").where(F.col("number") < F.col("source_first") + MOST_HEAD)
    given = asked.join(early.select("number", "id", "size"), "number").select("conv_id", (F.col("k") + 1).alias("depth"), "id", "size")
    lengths = heads.select("conv_id", (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    return own.union(given), lengths


def segments(turns: DataFrame, lengths: DataFrame, segment: int) -> DataFrame:
    """conv_id, segment, its turns in order, name (a, b) at its start, characters after it; one empty segment without turns."""
    part = lambda k: F.xxhash64(F.lit(k), "depth", "id")
    marked = turns.withColumns({"segment": F.floor((F.col("depth") - 1) / segment), "a": part(1), "b": part(2)})
    cut = marked.groupBy("conv_id", "segment").agg(
        F.sort_array(F.collect_list(F.struct("depth", "id", "a", "b", "size"))).alias("turns"),
        F.bit_xor("a").alias("xa"), F.bit_xor("b").alias("xb"), F.sum("size").alias("chars"),
    )
    before = Window.partitionBy("conv_id").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("conv_id").orderBy(F.desc("segment")).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    cut = cut.select("conv_id", "segment", "turns", F.coalesce(F.bit_xor("xa").over(before), zero).alias("a"), F.coalesce(F.bit_xor("xb").over(before), zero).alias("b"),
                     F.coalesce(F.sum("chars").over(after), zero).alias("after"))
    nothing = lengths.where("length = 0").select("conv_id", zero.alias("segment"), F.array().cast(cut.schema["turns"].dataType).alias("turns"), zero.alias("a"), zero.alias("b"), zero.alias("after"))
    return cut.unionByName(nothing)


class _Totals:
    """Of one node: name, parent's name, characters of its last text, members, smallest member, two sums."""

    __slots__ = ("name", "parent", "size", "n", "conv", "chars", "leaves")

    def __init__(self, name, parent, size):
        self.name, self.parent, self.size = name, parent, size
        self.n, self.conv, self.chars, self.leaves = 0, None, 0, 0

    def add(self, conv, chars, leaves):
        self.n += 1
        self.conv = conv if self.conv is None or conv < self.conv else self.conv
        self.chars += chars
        self.leaves += leaves


NODE = "depth long, a long, b long, pa long, pb long, size long, n long, conv_id long, chars long, leaves long"


def _node_batches(batches, segment: int, limit: int):
    """Totals of turn-aligned depths from radix trees over segments; columns from, rest and leaf may weigh a conversation's turns."""
    forest: dict[tuple, tuple[RadixTree, _Totals | None]] = {}
    held = 0

    def out():
        rows = [t for tree, top in forest.values() for t in ([top] if top else []) + list(tree.totals())]
        columns = [[*t.name, *t.parent, t.size, t.n, t.conv, t.chars, t.leaves] for t in rows]
        names = [c.split()[0] for c in NODE.split(", ")]
        return pa.record_batch({name: pa.array([c[i] for c in columns], pa.int64()) for i, name in enumerate(names)})

    for batch in batches:
        turns = batch.column("turns")
        bounds, items = turns.offsets.to_numpy() - int(turns.offsets[0].as_py()), turns.flatten()
        ids = b"".join(items.field("id").to_pylist())
        xa, xb, sizes = (items.field(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in ("a", "b", "size"))
        weighed = "from" in batch.schema.names
        plain = {c: batch.column(c).to_pylist() for c in batch.schema.names if c != "turns"}
        for i in range(batch.num_rows):
            low, high = int(bounds[i]), int(bounds[i + 1])
            conv, start, begin = plain["conv_id"][i], (plain["segment"][i], plain["a"][i], plain["b"][i]), plain["segment"][i] * segment
            if start not in forest:
                forest[start] = RadixTree(WIDTH), _Totals((0, 0, 0), (None, None), 0) if begin == 0 else None
            tree, top = forest[start]
            na, nb = (np.bitwise_xor.accumulate(np.concatenate([[first], own[low:high]])).tolist() for first, own in ((start[1], xa), (start[2], xb)))
            tail = (np.cumsum(sizes[low:high][::-1])[::-1] + plain["after"][i]).tolist()
            leaf = plain["leaf"][i] if weighed else 0
            if weighed:  # only turns from this depth on count, their characters being ``rest``
                tail = [plain["rest"][i] if begin + d < plain["from"][i] else t for d, t in enumerate(tail, 1)]
            size = sizes[low:high].tolist()
            if top:
                top.add(conv, plain["rest"][i] if weighed else (tail[0] if tail else 0), leaf)
            new = lambda d: _Totals((begin + d, na[d], nb[d]), (na[d - 1], nb[d - 1]), size[d - 1])  # noqa: E731, B023
            tree.insert(ids[WIDTH * low : WIDTH * high], new, lambda t, d: t.add(conv, tail[d - 1], leaf))  # noqa: B023
            held += high - low + 1
            if held > limit:
                yield out()
                forest, held = {}, 0
    yield out()


def _piece_batches(batches, most: int):
    """Conversation ids of one node after the other, joined to pieces of bounded length."""
    name, first, held, size = None, None, [], 0

    def piece():
        values = [[name[0]], [name[1]], [name[2]], [first], [",".join(held)]]
        return pa.record_batch({c: pa.array(v, pa.string() if c == "ends" else pa.int64()) for c, v in zip([*NAME, "first", "ends"], values)})

    for batch in batches:
        for own in zip(*(batch.column(c).to_pylist() for c in (*NAME, "conv_id"))):
            if held and (own[:3] != name or size > most):
                yield piece()
                held, size = [], 0
            if not held:
                name, first = own[:3], own[3]
            held.append(str(own[3]))
            size += len(held[-1]) + 1
    if held:
        yield piece()


def _hash_batches(batches):
    """Checksum of each node's pieces, which arrive in order; a piece is dropped once it is hashed."""
    name, digest, done = None, None, []

    def rows():
        return pa.record_batch({c: pa.array([d[i] for d in done], pa.string() if c == "ends_sha256" else pa.int64()) for i, c in enumerate([*NAME, "ends_sha256"])})

    for batch in batches:
        for own in zip(*(batch.column(c).to_pylist() for c in (*NAME, "ends"))):
            if own[:3] != name:
                if name:
                    done.append((*name, digest.hexdigest()))
                name, digest = own[:3], hashlib.sha256(own[3].encode())
            else:
                digest.update(b"," + own[3].encode())
        yield rows()
        done = []
    if name:
        done.append((*name, digest.hexdigest()))
    yield rows()


def ends_of(turns: DataFrame, lengths: DataFrame, piece: int) -> DataFrame:
    """depth, a, b, ends_sha256 of all nodes at which conversations end."""
    full = turns.groupBy("conv_id").agg(*[F.bit_xor(F.xxhash64(F.lit(k), "depth", "id")).alias(x) for k, x in ((1, "a"), (2, "b"))])
    zero = F.lit(0).cast("long")
    ends = lengths.join(full, "conv_id", "left").select(F.col("length").cast("long").alias("depth"), F.coalesce("a", zero).alias("a"), F.coalesce("b", zero).alias("b"), "conv_id")
    ordered = ends.repartitionByRange(*NAME, "conv_id").sortWithinPartitions(*NAME, "conv_id")
    joined = ordered.mapInArrow(functools.partial(_piece_batches, most=piece), "depth long, a long, b long, first long, ends string")
    dealt = joined.repartition(*NAME).sortWithinPartitions(*NAME, "first")
    return dealt.mapInArrow(_hash_batches, "depth long, a long, b long, ends_sha256 string")


def conversation_trie(df: DataFrame, segment: int = SEGMENT, limit: int = LIMIT, piece: int = PIECE) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns, lengths = rebuilt_turns(df)
    turns, lengths = materialize(turns, "rebuilt-turns"), materialize(lengths, "lengths")
    cut = materialize(segments(turns, lengths, segment), "segments")
    run = functools.partial(_node_batches, segment=segment, limit=limit)
    partial = cut.mapInArrow(run, NODE)
    nodes = partial.groupBy(*NAME).agg(
        F.first("pa").alias("pa"), F.first("pb").alias("pb"), F.first("size").alias("size"), F.sum("n").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.sum("chars").alias("chars"),
    )
    nodes = materialize(nodes, "nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = materialize(nodes.join(children, NAME, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "nodes-children")
    # "from" is where a conversation's represented nodes begin; the root counts as turn 0.
    own = nodes.groupBy("conv_id").agg(F.min("depth").alias("from"), F.sum("size").alias("rest"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    below = cut.join(own, "conv_id").mapInArrow(run, NODE).groupBy(*NAME).agg(F.sum("chars").alias("represented"), F.sum("leaves").alias("n_leaves"))
    found = nodes.join(below, NAME).join(ends_of(turns, lengths, piece), NAME, "left")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    found = found.join(parents, ["depth", "pa", "pb"], "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", (F.col("chars") - F.col("represented")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )


ORACLE = """
WITH crc AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))) AS t),
own AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS p
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, n, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda x, y: xor(x >> 8, t[xor(x & 255, y) + 1]))) % 6 AS h
  FROM (SELECT c, count(*) AS n FROM own GROUP BY c), crc),
plan AS (SELECT l.c, l.h, least(l.h, coalesce(r.n, 0)) AS m FROM convs l LEFT JOIN convs r ON r.c = l.c - l.c % 100),
rebuilt AS (
  SELECT plan.c, p + 1 AS d, role, text FROM plan JOIN own ON own.c = plan.c - plan.c % 100 AND p < m
  UNION ALL SELECT plan.c, m + p - h + 1, role, text FROM plan JOIN own USING (c) WHERE p >= h),
named AS (SELECT c, d, length(text) AS size, string_agg(md5(length(role) || ':' || role || text), ',') OVER (PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING) AS name FROM rebuilt),
path AS (SELECT c, 0 AS d, 0 AS size, '' AS name FROM plan UNION ALL SELECT * FROM named),
stepped AS (SELECT *, lag(name) OVER (PARTITION BY c ORDER BY d) AS parent, d = max(d) OVER (PARTITION BY c) AS ends FROM path),
nodes AS (
  SELECT name, d, min(c) AS conv_id, any_value(parent) AS parent, any_value(size) AS size, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256 FROM stepped GROUP BY name, d),
families AS (SELECT parent AS name, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY parent),
counted AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN families USING (name)),
below AS (
  SELECT path.name, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * counted.size) AS saved
  FROM counted JOIN path ON path.c = conv_id AND path.d <= counted.d GROUP BY path.name)
SELECT l.conv_id, CAST(l.d AS BIGINT) AS depth, r.conv_id AS parent_conv_id, l.n_convs, l.n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens, l.ends_sha256
FROM counted l JOIN below USING (name) LEFT JOIN nodes r ON r.name = l.parent AND l.d > 0
"""
