"""The prefix trie of conversations against a plain dictionary of prefixes."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from conftest import SF001

from tidemark.llm import catalog, prefix_trie
from tidemark.llm.tables import read

WORD = re.compile("[^\x20\x09-\x0D]+")
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(convs):
    """All nodes of {id: [(role, text), ...]}."""
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    children, leaves, saved = defaultdict(list), {}, {}
    for node in members:
        if node:
            children[node[:-1]].append(node)
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[b] for b in below) or 1
        words = len(WORD.findall(node[-1][1])) if node else 0
        saved[node] = (len(members[node]) - 1) * words + sum(saved[b] for b in below)
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in m if len(convs[c]) == len(p)).encode()).hexdigest())
                  for p, m in members.items()) if convs else []


def found(df):
    assert df.columns == NAMES
    return sorted(tuple(r) for r in df.collect())


def turns_of(spark, convs):
    rows = [(c, t, role, text) for c, turns in convs.items() for t, (role, text) in enumerate(turns)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def shared(seed, n):
    rng = random.Random(seed)
    convs = {}
    for c in range(n):
        from_old = rng.choice(list(convs.values()))[: rng.randrange(6)] if convs else []
        convs[c * 7] = from_old + [(rng.choice("ua"), " ".join(rng.choices("pqr", k=rng.randrange(3)))) for _ in range(rng.randrange(1, 4))]
    return convs


@pytest.mark.parametrize("seed,n,block_turns", [(1, 200, 10**6), (2, 300, 20), (3, 60, 1), (4, 1, 1), (5, 2, 1)])
def test_nodes_equal_plain_prefixes(spark, seed, n, block_turns):
    convs = shared(seed, n)
    got = prefix_trie.trie(prefix_trie.sequences(turns_of(spark, convs)), block_turns=block_turns)
    assert found(got) == plain(convs)


def test_hot_sequences_span_blocks(spark):
    convs = {c: [("u", "hello there"), ("a", "general")] for c in range(300)}
    convs |= {c: convs[0] + [("u", f"{c % 5} more words")] for c in range(300, 400)}
    convs |= {c: convs[0][:1] for c in range(400, 500)} | {c: [("z", str(c))] * 40 for c in range(500, 540)}
    got = prefix_trie.trie(prefix_trie.sequences(turns_of(spark, convs)), block_turns=25)
    assert found(got) == plain(convs)


def rebuilt(rows):
    """The query's conversations: up to three turns come from the first of twenty."""
    own = defaultdict(list)
    for c, t, role, text in rows:
        own[c].append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def test_query_equals_plain_prefixes(spark, tmp_path):
    got = found(catalog.QUERIES["op13_prefix_trie"](spark, SF001))
    assert got == plain(rebuilt([tuple(r) for r in read(spark, SF001, "conversations").collect()]))
    rows = [(21, 0, "u", "a b"), (21, None, None, None), (22, 5, "u", "x"), (40, 1, "s", "one"), (40, 2, "s", "two"),
            (41, 1, "q", "own"), (59, 1, "q", "own"), (45, 1, "s", "one")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert found(catalog.QUERIES["op13_prefix_trie"](spark, str(tmp_path))) == plain(rebuilt(rows))


def test_odd_rows(spark):
    rows = [(1, None, None, "x y", 9), (1, None, None, "x y", 9), (None, 1, "u", "lost", 9), (2, 3, "u", None, 9)]
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, depth int")
    got = found(prefix_trie.trie(prefix_trie.sequences(turns)))
    assert got == plain({1: [("", "x y"), ("", "x y")], 2: [("u", "")]})
    assert found(prefix_trie.trie(prefix_trie.sequences(turns.limit(0)))) == []
