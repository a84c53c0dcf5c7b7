"""Vector codes against plain Python with whole numbers of any size."""

import math
import random
from collections import Counter
from fractions import Fraction

import numpy as np

from pulsegrid.llm import codes


def plain(rows, parts=4, entries=256, rounds=4):
    """rows: (id, label, vector); as the docstring says, with exact arithmetic."""
    rows = [r for r in rows if r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])]
    if not rows:
        return [], []
    lengths = Counter(len(r[2]) for r in rows)
    dim = max(lengths, key=lambda d: (lengths[d], d))
    rows = [(i, label, [math.floor(Fraction(x) * 1024) for x in v]) for i, label, v in rows if len(v) == dim]
    cuts = [(p * dim // parts, (p + 1) * dim // parts) for p in range(parts)]
    first = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    books = [[r[2][a:b] for r in first] for a, b in cuts]

    def best(book, x):
        return min((sum((u - w) ** 2 for u, w in zip(x, y)), e) for e, y in enumerate(book))

    for _ in range(rounds):
        for (a, b), book in zip(cuts, books):
            members = {}
            for _, _, v in rows:
                members.setdefault(best(book, v[a:b])[1], []).append(v[a:b])
            for e, xs in members.items():
                book[e] = [sum(c) // len(xs) for c in zip(*xs)]
    out = []
    for i, label, v in rows:
        found = [best(book, v[a:b]) for (a, b), book in zip(cuts, books)]
        out.append((i, label, "".join(f"{e:02x}" for _, e in found), min(sum(d for d, _ in found), codes.LARGEST)))
    return out, books


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>, code string, row int, v string")
    coded, books = codes.compress(df, columns=["vec_id", "label"], **options)
    got = codes.label_errors(coded).select("row.*", "code", "error", "label_error").collect()
    want, want_books = plain([r[:3] for r in rows], **options)
    assert Counter((r.vec_id, r.label, r.code, r.error) for r in got) == Counter(want)
    sums = Counter()
    for _, label, _, error in want:
        sums[label] += error
    assert all(r.label_error == min(sums[r.label], codes.LARGEST) for r in got)
    assert [b.tolist() for b in books] == want_books or not want


def row(i, label, v):
    return (i, label, v, "clash", 1, "v")


def test_codes_equal_plain_python(spark):
    r = random.Random(4)
    grid = lambda d: [r.choice([-1.5, -0.25, 0.0, 0.001, 2.0]) for _ in range(d)]  # many ties and shared prefixes
    rows = [row(i, r.choice([1, 2, None]), grid(8)) for i in r.sample(range(1000), 60)]
    rows += [row(2000, 1, rows[0][2])] * 30  # a third are copies
    bad = [row(1, 1, None), row(2, 1, [1.0] * 7 + [None]), row(3, 1, [float("nan")] + [0.0] * 7), row(4, 2, [float("inf")] * 8),
           row(None, None, grid(8)), row(5, 1, grid(9)), row(6, 1, [])]
    check(spark, rows + bad, entries=7)
    check(spark, rows + bad)  # fewer vectors than entries
    check(spark, [row(i, 1, grid(6)) for i in range(12)], entries=3, rounds=2)  # 6 dimensions, 4 parts
    check(spark, [row(i, 1, grid(2)) for i in range(12)], entries=3, rounds=2)  # parts without dimensions
    check(spark, [], entries=3)
    check(spark, bad[:4])


def test_very_large_components(spark):
    rows = [row(i, i % 2, [1e300 * (i - 2), 0.5, 3e40, -1e18 * i]) for i in range(6)] + [row(9, 1, [0.1, 0.2, 0.3, 0.4])]
    check(spark, rows, entries=3)


def test_trie_equals_all_distances():
    r = np.random.default_rng(1)
    for dtype in (np.int64, object):
        x = r.integers(-3, 4, (1500, 6)).astype(dtype)
        book = r.integers(-3, 4, (40, 6)).astype(dtype)
        leaves, number = codes.distinct(x)
        assert (leaves[number] == x).all()
        assert [tuple(v) for v in leaves.tolist()] == sorted({tuple(v) for v in x.tolist()})
        far = ((leaves[:, None, :] - book[None]) ** 2).sum(2)
        entry, least = codes.nearest(leaves, book)
        assert (entry == far.argmin(axis=1)).all() and (least == far.min(axis=1)).all()
