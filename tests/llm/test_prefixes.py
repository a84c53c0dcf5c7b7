"""Tree contraction and the trie of conversations against plain Python."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from pulsegrid.llm import prefixes
from pulsegrid.llm.contraction import subtree_totals


def plain_totals(parent, value):
    out = dict(value)
    kids = defaultdict(list)
    for x, p in parent.items():
        kids[p].append(x)
    order, stack = [], list(kids[None])
    while stack:
        x = stack.pop()
        order.append(x)
        stack += kids[x]
    for x in reversed(order):
        if parent[x] is not None:
            out[parent[x]] += out[x]
    return out


def forest(kind, n, r):
    if kind == "chain":
        return {i: i - 1 if i else None for i in range(n)}
    if kind == "star":
        return {i: 0 if i else None for i in range(n)}
    if kind == "broom":  # a chain with many leaves on its end, and a second root
        return {i: (i - 1 if i else None) if i < n // 2 else n // 2 - 1 for i in range(n)} | {n: None}
    return {i: r.randrange(max(0, i - 6), i) if i else None for i in range(n)}


@pytest.mark.parametrize("kind,n", [("chain", 400), ("star", 300), ("broom", 120), ("random", 300), ("chain", 1)])
def test_subtree_totals(spark, kind, n, monkeypatch):
    r = random.Random(n)
    parent = forest(kind, n, r)
    names = dict(zip(parent, r.sample(range(-5000, 5000), len(parent))))
    value = {x: r.randrange(-9, 100) for x in parent}
    rows = [(names[x], names.get(p), value[x], 1) for x, p in parent.items()]
    rounds = []
    from pulsegrid.llm import contraction
    rake = contraction._rake
    monkeypatch.setattr(contraction, "_rake", lambda *a: (rounds.append(1), rake(*a))[1])
    got = {x.id: (x.v, x.size) for x in subtree_totals(spark.createDataFrame(rows, "id long, parent long, v long, size long"),
                                                       ["v", "size"]).collect()}
    totals, sizes = plain_totals(parent, value), plain_totals(parent, dict.fromkeys(parent, 1))
    assert got == {names[x]: (totals[x], sizes[x]) for x in parent}
    assert len(rounds) <= 18  # a chain of 400 is contracted by a third in each round, not link by link


def test_no_nodes_and_a_cycle(spark):
    schema = "id long, parent long, v long"
    assert subtree_totals(spark.createDataFrame([], schema), ["v"]).count() == 0
    with pytest.raises(ValueError):
        subtree_totals(spark.createDataFrame([(1, 2, 1), (2, 1, 1)], schema), ["v"])


def plain_trie(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}
    built = {}
    for c, ts in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = convs.get(c - c % 5, [])[:h] + ts[h:]
    members = defaultdict(list)
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, cs in members.items():
        cost = (len(cs) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += cost
    return Counter((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), kids[p], leaves[p], saved[p], hashlib.sha256(
        ",".join(str(c) for c in sorted(cs) if len(built[c]) == len(p)).encode()).hexdigest()) for p, cs in members.items())


def got_trie(df):
    return Counter(tuple(r) for r in prefixes.trie(df).collect())


SCHEMA = "conv_id long, turn long, role string, text string"


def test_trie_of_all_conversations(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    assert got_trie(df) == plain_trie([(r.conv_id, r.turn, r.role, r.text) for r in df.collect()])


def test_trie_of_odd_conversations(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "BLOCK", 8)
    r = random.Random(5)
    rows = [(c, t, r.choice(["user", None, ""]), r.choice(["é", "", None, "a b"])) for c in range(40) for t in range(r.randrange(1, 6))]
    rows += [(50 + c, None, None, None) for c in range(6)] + [(None, 1, "user", "x")] * 4
    rows += [(c, 1, "u", "absent source") for c in (63, 64, 1004)]  # some of these become turnless
    rows += [(70, t, "user", "same") for t in range(60)]  # one long conversation
    rows += [(80 + c, t, "user", "same") for c in range(30) for t in range(3)]  # a third are copies
    got = got_trie(spark.createDataFrame(rows, SCHEMA))
    assert got == plain_trie(rows)
    clash = spark.createDataFrame([(*x, "n", 1, 2) for x in rows], SCHEMA + ", c string, i long, depth long")
    assert got_trie(clash) == got


def test_repeated_turns_and_no_conversations(spark):
    rows = [(5, 1, "a", "b")] * 12 + [(6, 1, "a", "b")] * 3
    assert got_trie(spark.createDataFrame(rows, SCHEMA)) == plain_trie(rows)
    assert got_trie(spark.createDataFrame([], SCHEMA)) == Counter()
    assert got_trie(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)) == Counter()


def test_ids_of_a_crowded_end_are_hashed_in_order(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "IDS", 3)
    ids = random.Random(1).sample(range(10_000), 500)
    df = spark.createDataFrame([(c % 2, c) for c in ids], "k long, c long").repartition(5)
    got = {r.k: r.sha for r in prefixes.digest_of_ids(df, ["k"]).collect()}
    assert got == {k: hashlib.sha256(",".join(str(c) for c in sorted(ids) if c % 2 == k).encode()).hexdigest() for k in (0, 1)}
