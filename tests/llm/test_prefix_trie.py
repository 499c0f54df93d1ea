"""The trie against a plain one; op11 on the given tables is compared with SQL in test_llm_queries."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from shelfcast.llm import prefix_trie as P

COLUMNS = "conv_id long, turn long, role string, text string, k1 long, depth string"


def plain(rows, shared):
    """Nodes of the trie of (conv_id, turn, role, text) rows, by prefixes as tuples."""
    own = {}
    for c, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        if c is not None:
            own.setdefault(c, []).append((role or "", text or ""))
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9 if shared else 0
        paths[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:]) if shared else tuple(turns)
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)

    def saved(node):
        return (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0

    leaves, below = {}, {}
    for node in sorted(members, key=len, reverse=True):
        kids = children.get(node, [])
        leaves[node] = sum(leaves[k] for k in kids) or 1
        below[node] = saved(node) + sum(below[k] for k in kids)
    return sorted(
        (min(m), len(node), min(members[node[:-1]]) if node else -1, len(m),
         len(children.get(node, [])), leaves[node], below[node],
         hashlib.sha256(",".join(map(str, sorted(c for c in m if paths[c] == node))).encode()).hexdigest())
        for node, m in members.items()
    )


def trie(spark, rows, shared=False, **limits):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], COLUMNS).repartition(5)
    if shared:
        limits |= {"donor": F.col("conv_id") - F.col("conv_id") % 5,
                   "taken": F.crc32(F.col("conv_id").cast("string")) % 9}
    out = P.prefix_trie(df, **limits)
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                           "saved_tokens", "ends_sha256"]
    return sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in out.collect())


def made(n, seed, words=3):
    rng = random.Random(seed)
    return [
        (c, t, rng.choice(["user", "assistant", None]), rng.choice(["é", "b", None, "long " * 9][:words]))
        for c in range(n) for t in range(rng.randrange(1, 14))
    ]


@pytest.mark.parametrize("limits", [
    {}, {"shard_conversations": 2, "top_nodes": 100_000}, {"queue": 1, "shard_conversations": 5},
])
def test_against_plain(spark, limits):
    rows = made(60, 1)
    assert trie(spark, rows, **limits) == plain(rows, False)
    assert trie(spark, rows, shared=True, **limits) == plain(rows, True)


def test_absent_donors_and_turnless(spark):
    rows = [r for r in made(90, 2) if r[0] % 5 or r[0] % 3]
    assert trie(spark, rows, shared=True) == plain(rows, True)
    turnless = [n for n in trie(spark, [(c, 0, "u", "t") for c in (1, 2, 3, 4)], shared=True)]
    assert turnless[0][:3] == (1, 0, -1) and turnless[0][3] == 4


def test_copies_nulls_ties_and_a_long_conversation(spark):
    copies = [(c, t, "user", "same") for c in range(10, 400) for t in range(3)]
    odd = [(None, 1, "user", "x"), (500, None, None, None), (500, 2, "a", "b"), (501, 1, "q", "same"),
           (501, 1, "q", "same"), (502, 0, "", "")]
    long = [(503, t, "user", "same") for t in range(3_000)] + [(504, 0, "user", "z" * 1_000_000)]
    rows = copies + odd + long
    assert trie(spark, rows, shard_conversations=50) == plain(rows, False)


def test_no_rows(spark):
    assert trie(spark, []) == [] and trie(spark, [(None, 1, "a", "b")]) == []


def test_pieces_of_ends(spark, monkeypatch):
    rows = [(c, 0, "user", "same") for c in range(3 * P.PIECE + 7)]
    assert trie(spark, rows) == plain(rows, False)


def test_queue_spills_in_order():
    rng = random.Random(3)
    sent = [(-rng.randrange(9), rng.randrange(4), 0, k, 1) for k in range(500)]
    queue = P.SpillingQueue(limit=7)
    for m in sent:
        queue.push(m)
    assert len(queue.runs) > 3
    got = [(a, sorted(queue.take(a))) for a in sorted({m[:3] for m in sent})]
    assert got == [(a, sorted(m for m in sent if m[:3] == a)) for a in sorted({m[:3] for m in sent})]
    assert queue.held == [] and queue.runs == []
