"""Fingerprints of versions against plain set differences."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from pulsegrid.llm import fingerprints as P
from tests.llm.conftest import ODD


def plain_edit(texts, i):
    t, f = texts[i], texts[(i + 1) % len(texts)]
    return t[:len(t) - len(t) // 2] + f[:len(t) // 2]


def plain_likeness(a, b):
    a, b = (Counter(re.findall(P.PARAGRAPH, t)) for t in (a, b))
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 1.0


def check(frame, rows):
    """``rows``: (id, text) in the order of ids."""
    texts = [t or "" for _, t in rows]
    want = Counter()
    for i, (key, _) in enumerate(rows):
        new = plain_edit(texts, i)
        want[key, len(texts[i]), hashlib.sha256(new.encode()).digest(), round(plain_likeness(texts[i], new), 12),
             round(plain_likeness(texts[i], texts[(i + 1) % len(rows)]), 12)] += 1
    got = frame.collect()
    assert Counter((r.id, r.n_chars, bytes(r.edited_sha256), round(r.near_edited, 12), round(r.near_next, 12)) for r in got) == want
    return got


def test_all_documents(docs):
    rows = [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()]
    got = check(P.versions(docs), rows)
    of_text, by_id = {}, {r.id: r for r in got}
    for key, t in rows:
        assert of_text.setdefault(t or "", by_id[key].fingerprint) == by_id[key].fingerprint  # equal texts
    assert len(set(of_text.values())) == len(of_text)


def test_odd_documents(spark, odd, empty):
    ids = [r for r in ODD if r[0] is not None]
    rows = [(r[0], r[1]) for r in ODD if r[0] is None] + sorted(((r[0], r[1]) for r in ids), key=lambda r: r[0])
    check(P.versions(odd), rows)
    check(P.versions(odd.repartition(7)), rows)
    assert P.versions(empty).count() == 0
    (alone,) = P.versions(odd.where("doc_id = 11")).collect()
    assert alone.near_next == 1.0 and alone.n_chars == len(ODD[-1][1])


def test_many_ranges_and_a_hot_id(spark):
    """A third of all rows have one id and one text; ranges without rows are skipped."""
    rows = sorted([(i, f"line {i}.\nand {i % 3}. end") for i in range(200)] + [(77, "copy. copy. other")] * 100,
                  key=lambda r: r[0])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        got = P.versions(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert Counter(r.id for r in got) == Counter(r[0] for r in rows)
    # within an id the order is that of hashes: the copies stand together, so all but one are followed by a copy
    assert sum(r.near_next == 1.0 for r in got if r.id == 77) == 99


def test_recovered_digests_equal_the_plain_difference(spark):
    r = random.Random(3)
    make = lambda n: "".join(f"sentence {r.randrange(4000)} of some." for _ in range(n))
    pairs = [(make(n), make(m)) for n, m in ((0, 0), (0, 5), (1, 1), (30, 1), (400, 300), (3000, 10))]
    long = make(2000)
    pairs += [(long, long + "one more."), (long, long.replace("7", "8")), ("a.a.a.", "a.a.b."), (None, "x"), ("same", "same")]
    got = P.compared(spark.createDataFrame(pairs, "row string, only_a string"), "row", "only_a").collect()
    assert len(got) == len(pairs)
    for x in got:
        a, b = (set(P.paragraph_keys([t or ""])[0].tolist()) for t in (x.row.row, x.row.only_a))
        assert x.only_a == sorted(f"{k:016x}" for k in a - b) and x.only_b == sorted(f"{k:016x}" for k in b - a)
        assert x.likeness == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)


def test_a_sketch_too_small_fails_and_says_so():
    keys, owner = P.paragraph_keys(["".join(f"{i}." for i in range(200)), ""])
    s = P.Sketches(keys, owner, 2, 5)
    assert not s.subtract(np.array([0]), np.array([1])).peel()[3].any()
    s = P.Sketches(keys, owner, 2, 200)
    key, _, side, empty = s.subtract(np.array([0]), np.array([1])).peel()
    assert empty.all() and sorted(key.tolist()) == sorted(keys.tolist()) and (side == 1).all()
