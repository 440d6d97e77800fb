"""The trie of conversation prefixes against nested dictionaries."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from cardloom.llm import prefixtrie, queries

TURNS = "conv_id long, turn long, role string, text string, conv string, depth int, d1 long"


def plain_rebuilt(rows):
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            talks[conv].append((turn is not None, turn or 0, role or "", text or ""))
    talks = {c: [t[2:] for t in sorted(turns)] for c, turns in talks.items()}
    made = {}
    for c, own in talks.items():
        h = zlib.crc32(str(c).encode()) % 9
        made[c] = talks.get(c - (abs(c) % 5) * (1 if c > 0 else -1), [])[:h] + own[h:]
    return made


def plain_nodes(talks):
    members = defaultdict(list)
    for c, turns in sorted(talks.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children, found = defaultdict(list), []
    for node in members:
        if node:
            children[node[:-1]].append(node)

    sums = {}
    for node in sorted(members, key=len, reverse=True):
        below = [sums[x] for x in children[node]]
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        sums[node] = sum(x[0] for x in below) or 1, own + sum(x[1] for x in below)
    for node, who in members.items():
        ends = ",".join(str(c) for c in who if len(talks[c]) == len(node))
        found.append((who[0], len(node), members[node[:-1]][0] if node else None, len(who), len(children[node]), *sums[node], hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(found)


@pytest.fixture(scope="module")
def odd_rows():
    rng = random.Random(6)
    rows = []
    for c in range(-7, 90):
        if c % 13 == 4:
            continue
        rows += [(c, i, rng.choice(["user", "assistant"]), rng.choice(["a", "b", "é", ""])) for i in range(rng.randrange(1, 9))]
    same = [(i, "user" if i % 2 else "assistant", f"turn {i}") for i in range(12)]
    rows += [(c, *t) for c in range(200, 320) for t in same]  # many equal conversations
    rows += [(400, i, "user", "again") for i in range(1500)] + [(405, i, "user", "again") for i in range(1200)]  # long ones
    rows += [(500, None, None, None), (500, None, None, None), (500, 0, "", ""), (501, None, "user", "long " * 50_000), (None, 0, "user", "lost"), (None, None, None, None)]
    return [(*r, "other", 9, None) for r in rows]


@pytest.mark.parametrize("largest", [prefixtrie.LARGEST, 1024])  # in the small one most counters are taken
def test_the_query_equals_nested_dictionaries(spark, odd_rows, largest, tmp_path):
    table = spark.createDataFrame(odd_rows, TURNS).repartition(5)
    coded = prefixtrie.coded_turns(table)
    wanted = plain_nodes(plain_rebuilt([r[:4] for r in odd_rows]))
    got = prefixtrie.prefix_nodes(*prefixtrie.rebuilt(coded), largest=largest)
    assert got.columns == prefixtrie.COLUMNS and Counter(map(tuple, got.collect())) == wanted
    table.write.parquet(f"{tmp_path}/conversations.parquet")
    assert Counter(map(tuple, queries.QUERIES["op13_prefix_trie"](spark, str(tmp_path)).collect())) == wanted


def test_conversations_as_they_are(spark, odd_rows):
    coded = prefixtrie.coded_turns(spark.createDataFrame(odd_rows, TURNS))
    talks = defaultdict(list)
    for conv, turn, role, text, *_ in odd_rows:
        if conv is not None:
            talks[conv].append((turn is not None, turn or 0, role or "", text or ""))
    wanted = plain_nodes({c: [t[2:] for t in sorted(turns)] for c, turns in talks.items()})
    assert Counter(map(tuple, prefixtrie.prefix_nodes(coded, prefixtrie.lengths(coded)).collect())) == wanted


def test_one_and_no_conversation(spark):
    for rows in ([], [(None, 1, "user", "x")], [(7, 1, "user", "x")], [(5, 1, "user", "x"), (6, 1, "user", "y")]):
        table = spark.createDataFrame([(*r, None, None, None) for r in rows], TURNS)
        got = prefixtrie.prefix_nodes(*prefixtrie.rebuilt(prefixtrie.coded_turns(table)))
        assert Counter(map(tuple, got.collect())) == plain_nodes(plain_rebuilt(rows))


def test_a_sketch_never_estimates_too_low(spark):
    rng = np.random.default_rng(2)
    values = rng.integers(-2**63, 2**63, (4000, 2))
    d = np.concatenate([values, values[:1500], values[:10]])
    table = spark.createDataFrame(d.tolist(), "d1 long, d2 long").repartition(6)
    width = prefixtrie.sketch_width(len(d))
    stored = prefixtrie.opened(prefixtrie.sketch(table, width), width)
    found = prefixtrie.estimates(stored, width, values[:, 0].copy(), values[:, 1].copy())
    assert (found[:1500] == 2).all() and (found[1500:] == 1).mean() > 0.99 and found.min() == 1
