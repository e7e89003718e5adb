"""Trie of conversation prefixes against a trie of dictionaries."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tapeloom.llm import conversation_trie as ct


def by_dictionaries(paths):
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved, ends) of all nodes; paths: conv_id to its (role, text) turns."""
    members = {}
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = {p: [q for q in members if len(q) == len(p) + 1 and q[: len(p)] == p] for p in members}

    def below(p):
        n, saved = (0, 0) if children[p] else (1, 0)
        for q in children[p]:
            x, y = below(q)
            n, saved = n + x, saved + y
        return n, saved + (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)

    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), *below(p), hashlib.sha256(",".join(map(str, sorted(c for c in m if len(paths[c]) == len(p)))).encode()).hexdigest()) for p, m in members.items()
    )


def result(nodes, endings):
    ends = ct.ends_sha256(endings).withColumnRenamed("node", "ended")
    rows = nodes.join(ends, F.col("node") == F.col("ended"), "left").collect()
    nothing = hashlib.sha256(b"").hexdigest()
    assert len({r.node for r in rows}) == len(rows)
    return sorted((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256 or nothing) for r in rows)


def table(spark, paths):
    rows = [(c, 10 * d, role, text, b"x") for c, turns in paths.items() for d, (role, text) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, node binary")


def grown(seed, n=120):
    """Conversations of which many branch off from others or equal them; some are long."""
    rng = random.Random(seed)
    say = lambda: (rng.choice(["user", "assistant", ""]), rng.choice(["", "yes", "no", "é漢", "a longer text"]))
    paths = {}
    for c in rng.sample(range(-1000, 1000), n):
        old = list(paths.values())
        base = rng.choice(old) if old and rng.random() < 0.8 else ()
        turns = base[: rng.randrange(len(base) + 1)] if rng.random() < 0.7 else base
        paths[c] = turns + tuple(say() for _ in range(rng.choice([0, 0, 1, 2, 5, 40])))
    return {c: t for c, t in paths.items() if t}


@pytest.mark.parametrize(("segment", "tasks"), [(1024, 1 << 18), (16, 20)])
def test_equals_dictionaries(spark, segment, tasks):
    paths = {c: t[:50] for c, t in grown(5).items()}
    assert max(map(len, paths.values())) > 32  # three segments of 16
    got = ct.prefix_trie(ct.ordered(table(spark, paths)), segment=segment, task_turns=tasks)
    assert result(*got) == by_dictionaries(paths)


def test_a_first_turn_and_a_whole_conversation_of_most(spark):
    """Half of all conversations begin alike and a quarter are one conversation, over many ranges."""
    rng = random.Random(2)
    start = (("user", "the same"), ("assistant", "answer"))
    paths = {c: start + tuple(("user", str(rng.randrange(6))) for _ in range(rng.randrange(5))) for c in range(300)}
    paths |= {c: start + (("user", "copied"),) * 3 for c in range(300, 450)}
    paths |= {c: tuple(("user", str(rng.randrange(99))) for _ in range(3)) for c in range(450, 600)}
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        assert result(*ct.prefix_trie(ct.ordered(table(spark, paths)))) == by_dictionaries(paths)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_order_of_turns_and_odd_rows(spark):
    rows = [(1, 5, "user", "b"), (1, None, "user", "a"), (1, 2000, None, None), (2, None, "user", "a"), (2, 7, "user", "b"), (2, 9000, "", ""), (None, 1, "user", "lost"), (3, 1, "user", "x"), (3, 1, "user", "x"), (4, -5000, "user", "x")]
    paths = {1: (("user", "a"), ("user", "b"), ("", "")), 2: (("user", "a"), ("user", "b"), ("", "")), 3: (("user", "x"),) * 2, 4: (("user", "x"),)}
    turns = ct.ordered(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert result(*ct.prefix_trie(turns)) == by_dictionaries(paths)


def test_rebuilt_conversations(spark):
    own = {c: tuple((("user", "assistant")[d % 2], f"{c % 7}-{d}") for d in range(c * 13 % 9 + 1)) for c in [*range(195, 330), *range(-5, 12), 700, 900]}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        donor = own.get(c - (abs(c) % 100) * (1 if c >= 0 else -1), ())
        paths[c] = donor[:h] + turns[h:]
    assert any(not p for p in paths.values())
    turns, members = ct.rebuilt(ct.ordered(table(spark, own)))
    assert result(*ct.prefix_trie(turns, members)) == by_dictionaries(paths)


def test_no_conversations_and_only_the_root(spark):
    empty = ct.ordered(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    nodes, endings = ct.prefix_trie(empty)
    assert nodes.collect() == [] == endings.collect()
    members = spark.createDataFrame([(3,), (1,), (1,), (None,)], "conv_id long")
    assert result(*ct.prefix_trie(empty, members)) == by_dictionaries({1: (), 3: ()})
