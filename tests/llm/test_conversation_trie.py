"""The conversation trie against a plain one, its radix tree against dictionaries."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import conversation_trie, queries, radix
from tests.check_catalog import compare, database

ROW = "conv_id long, turn long, role string, text string"


def direct(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest(), role, text))
    for c in own:
        own[c] = [(r, t) for *_, r, t in sorted(own[c])]
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 6
        whole = tuple(own.get(c - c % 100, [])[:h] + own[c][h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
        ends[whole].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, own_members in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(own_members) - 1) * (len(p[-1][1]) if p else 0)
    return sorted(((m[0], len(p), members[p[:-1]][0] if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest()) for p, m in members.items()), key=repr)


def talks(seed, n=250):
    """Conversations with shared beginnings, copies, single and repeated turns, missing numbers, roles and texts."""
    r, rows = random.Random(seed), []
    known = [[("user", "hello"), ("assistant", "hi 😀")], [("user", "hello")], [("user", None), (None, "x")]]
    for _ in range(n):
        c = r.choice([r.randrange(400), r.randrange(10**6, 10**6 + 300), 7, 200])
        turns = list(r.choice(known))
        for _ in range(r.randint(0, 5)):
            turns.append((r.choice(["user", "assistant", None]), r.choice(["a", "bb", "", None, f"own {r.randrange(50)}"])))
        known.append(turns[: r.randint(1, len(turns))])
        rows += [(c, None if r.random() < 0.1 else k, role, text) for k, (role, text) in enumerate(turns)]
    return rows


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, ROW).withColumns({x: F.lit("clash") for x in ("depth", "a", "id", "size", "segment", "h", "first", "n")})
    return sorted((tuple(x) for x in conversation_trie.conversation_trie(df.repartition(5), **options).collect()), key=repr)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.mark.parametrize("segment,limit,piece", [(64, 100_000, 1 << 16), (2, 7, 5), (1, 1, 1)])
def test_equals_a_plain_trie(spark, segment, limit, piece):
    rows = talks(segment) + [(None, 1, "user", "of none"), (-150, 0, "user", "before zero"), (-250, 1, None, None)]
    assert found(spark, rows, segment=segment, limit=limit, piece=piece) == direct(rows)


def test_one_long_conversation_and_many_copies(spark):
    """A third of all turns are one conversation's, another third of all conversations are copies."""
    rows = [(101, k, "user", f"turn {k % 90}") for k in range(500)] + [(102, k, "user", f"turn {k % 90}") for k in range(230)]
    rows += [(10_000 + i, k, "user", f"copy {k}") for i in range(300) for k in range(2)]
    assert found(spark, rows) == direct(rows)


def test_empty_table_and_turnless_conversations(spark):
    df = spark.createDataFrame([], ROW)
    done = conversation_trie.conversation_trie(df)
    assert done.columns == COLUMNS and done.count() == 0
    c = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 0)
    rows = [(c, 0, "user", "its first turn is given away")]
    assert found(spark, rows) == direct(rows) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


@pytest.mark.parametrize("width,letters", [(1, 256), (1, 40), (2, 3), (4, 17), (16, 256)])
def test_radix_tree_counts_aligned_prefixes(width, letters):
    r = random.Random(width * letters)
    ids = [bytes(r.randrange(letters) for _ in range(width)) for _ in range(300)]
    keys = [b"".join(r.choice(ids[: r.choice([2, 300])]) for _ in range(r.randint(0, 6))) for _ in range(3000)]
    tree, want = radix.RadixTree(width), Counter(k[:d] for k in keys for d in range(width, len(k) + 1, width))
    for key in keys:

        def add(total, depth, key=key):
            total[0] = total[0] or key[: depth * width]
            assert total[0] == key[: depth * width]
            total[1] += 1

        tree.insert(key, lambda d: [None, 0], add)
    assert {p: n for p, n in tree.totals()} == want


def test_layouts_grow():
    children, kinds = radix.Sorted(), []
    for k, byte in enumerate(random.Random(1).sample(range(256), 256)):
        children = children.put(byte, k)
        assert children.get(byte) == k and len(list(children)) == k + 1
        kinds.append((type(children).__name__, getattr(children, "most", None)))
    assert kinds[3] == ("Sorted", 4) and kinds[4] == kinds[15] == ("Sorted", 16)
    assert kinds[16][0] == kinds[47][0] == "Indexed" and kinds[48][0] == "Full"
    assert [b for b, _ in children] == list(range(256))


def test_query_matches_sql_on_more_rows(spark):
    folder = "/root/testdata/sf0.01"
    assert compare(spark, database(folder), folder, queries.QUERIES["op13_conversation_trie"], queries.ORACLES["op13_conversation_trie"]) is None
