"""Near duplicates, components, archives and the pipeline, against plain Python."""

import base64
import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from pulsegrid.llm import embeddings, hnsw, lines, quality, secret_scans, simhash, warc
from pulsegrid.llm.components import components
from tests.llm.conftest import ODD, SF
from tests.llm.test_text_rules import LOWER, WORD, plain_line_dedup, plain_spans
from tests.llm.test_tokens import check_packing


def plain_components(pairs):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {x: find(x) for x in up}


def test_components(spark):
    r = random.Random(2)
    chain = [(i, i + 1) for i in range(1000, 1300)]
    star = [(5000 + i, 4999) for i in range(300)]
    pairs = chain + star + [(r.randrange(200), r.randrange(200)) for _ in range(110)] + [(7, 7), (9000, 9001), (9001, 9000)]
    r.shuffle(pairs)
    got = {x.node: x.component for x in components(spark.createDataFrame(pairs + [(None, 3)], "a long, b long")).collect()}
    assert got == {k: v for k, v in plain_components([p for p in pairs if p[0] != p[1]]).items()}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_rounds_grow_with_the_logarithm_of_a_chain(spark, monkeypatch):
    """A sorted chain of 1,024 links, and one whose numbers are shuffled."""
    from pulsegrid.llm import components as module

    rounds, rooted = [], module._rooted
    monkeypatch.setattr(module, "_rooted", lambda p: (rounds.append(1), rooted(p))[1])
    for names in (list(range(1025)), random.Random(3).sample(range(5000), 1025)):
        rounds.clear()
        pairs = list(zip(names, names[1:]))
        got = {x.node: x.component for x in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
        assert got == dict.fromkeys(names, min(names)) and len(rounds) <= 12


def plain_fingerprint(t):
    w = WORD.findall(t.translate(LOWER))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_golay_code():
    table = simhash.corrections()
    assert len(np.unique(table)) == 2048 and max(int(x).bit_count() for x in table) == 3
    r = np.random.default_rng(1)
    words = r.integers(0, 1 << 23, 500)
    near = words ^ (1 << r.integers(0, 23, 500))
    ball = simhash.codeword_index(words[:, None] ^ np.array([0, *(1 << i for i in range(23))])[None, :])
    assert (ball == simhash.codeword_index(near)[:, None]).any(axis=1).all()


def test_links_are_complete(spark):
    r = random.Random(4)
    fps = [r.getrandbits(64) for _ in range(60)]
    for f in list(fps):
        for _ in range(6):
            g = f
            for b in r.sample(range(64), r.randint(1, 5)):
                g ^= 1 << b
            fps.append(g)
    fps = sorted({f - (1 << 64) if f >> 63 else f for f in fps})
    want = {(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    got = {(x.a, x.b) for x in simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long")).collect()}
    assert got == want and len(want) > 100


def test_near_duplicates(docs, odd, empty, texts):
    ids = sorted(texts)
    fp = {i: plain_fingerprint(texts[i]) for i in ids}
    want = plain_components([(a, b) for a in ids for b in ids if a <= b and (fp[a] ^ fp[b]).bit_count() <= 3])
    got = {r.id: (r.fp & (1 << 64) - 1, r.component) for r in simhash.near_duplicates(docs).collect()}
    assert got == {i: (fp[i], want[i]) for i in ids}
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == len(ODD)
    assert {r.component for r in rows if r.id in (1, 2, 3)} == {1} and {r.component for r in rows if r.id in (5, 6)} == {5}
    kept = [r.doc_id for r in simhash.one_of_each(odd).collect()]
    assert kept.count(5) == 2 and 6 not in kept and 2 not in kept and None in kept
    assert simhash.one_of_each(empty).count() == 0 and simhash.one_of_each(odd).schema == odd.schema


def near_vectors_by_force(rows, least=0.9):
    ok = [(i, np.array(v, float) / max(map(abs, v))) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    pairs = [(a, b) for a in range(len(ok)) for b in range(a + 1, len(ok)) if len(ok[a][1]) == len(ok[b][1])
             and ok[a][1] @ ok[b][1] / np.linalg.norm(ok[a][1]) / np.linalg.norm(ok[b][1]) >= least]
    n, c = {}, plain_components([(ok[a][0], ok[b][0]) for a, b in pairs])
    for a, b in pairs:
        for x in (a, b):
            n[ok[x][0]] = n.get(ok[x][0], 0) + 1
    return {i: (n.get(i, 0), c.get(i, i)) for i, _ in rows}


def test_near_vectors(spark):
    r = np.random.default_rng(7)
    centres = r.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] * r.uniform(0.5, 2) + r.normal(size=16) * 0.35).tolist()) for i in range(400)]
    rows += [(400 + i, rows[3][1]) for i in range(30)]
    rows += [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] * 16), (904, [None] * 16), (905, [float("inf")] * 16),
             (906, [1.0, 0.0]), (907, [1.0, 0.1]), (908, [1e200, 1e199]), (None, rows[0][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {x.id: (x.n_links, x.component) for x in embeddings.near_vectors(df, shards=3).collect()}
    assert got == near_vectors_by_force(rows)
    assert embeddings.near_vectors(df.limit(0)).count() == 0


def test_beams_widen_until_all_is_found():
    r = np.random.default_rng(3)
    x = np.concatenate([r.normal(size=(600, 8)), r.normal(size=(1, 8)) * 3 + r.normal(size=(500, 8)) * 0.1])
    x /= np.linalg.norm(x, axis=1)[:, None]
    a, b = embeddings._linked(hnsw.Graph(x), x, x, 0.9, 4, 1.0)
    want = set(zip(*map(np.ndarray.tolist, np.nonzero(x @ x.T >= 0.9))))
    assert len(set(zip(a.tolist(), b.tolist())) ^ want) <= 0.001 * len(want)


def test_full_beams_of_all_blocks_widen_together(monkeypatch):
    """A few queries of each block have more hits than a beam holds: they are searched again at once, not block by block."""
    r = np.random.default_rng(5)
    n = 8 * hnsw.BLOCK
    x = r.normal(size=(n, 32))
    x[::64] = r.normal(size=32) * 2 + r.normal(size=(n // 64, 32)) * 0.1
    x /= np.linalg.norm(x, axis=1)[:, None]
    g = hnsw.Graph(x)
    ground, beam = [], hnsw.Graph._beam
    monkeypatch.setattr(hnsw.Graph, "_beam", lambda self, q, start, k, width: (k or ground.append(width), beam(self, q, start, k, width))[1])
    a, b = g.search(x, 0.9, 8)
    want = set(zip(*map(np.ndarray.tolist, np.nonzero(x @ x.T >= 0.9))))
    assert set(zip(a.tolist(), b.tolist())) == want and len(want) == n - n // 64 + (n // 64) ** 2
    assert ground == [8] * 8 + [32, 128]


def test_beams_hold_the_nearest():
    """Wide and narrow beams, best first, against all similarities; no node stands twice; missing nodes are -1 with -2."""
    r = np.random.default_rng(6)
    x = r.normal(size=(300, 12))
    x = (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)
    g = hnsw.Graph(x)
    for width in (8, 120, 300, 310):
        ids, sims = g._beam(x[:40], np.repeat(g.entry[None, :1], 40, axis=0), 0, width)
        held = min(width, 300)
        assert ids.shape == (40, width) and (ids[:, held:] == -1).all() and (sims[:, held:] == -2).all()
        assert all(len(set(i[:held].tolist())) == held for i in ids) and (np.diff(sims[:, :held]) <= 0).all()
        assert np.abs(np.einsum("nd,nkd->nk", x[:40], x[ids[:, :held]]) - sims[:, :held]).max() < 1e-5
        assert (ids[:, 0] == np.arange(40)).mean() > 0.9
        if width >= 120:
            best = np.sort(x[:40] @ x.T, axis=1)[:, ::-1][:, :held]
            assert np.abs(best - sims[:, :held]).max(axis=1).mean() < 0.02


def test_warc(spark):
    rows = [(1, "http://a/", "<p>x</p>"), (2, "http://b/\r\nX: y", "<p>x</p>"), (3, None, None), (4, "u", ""), (5, "v", "é\r\n\r\nWARC/1.1" * 9),
            (5, "v", "é\r\n\r\nWARC/1.1" * 9), (6, "w", "y" * 300_000), (None, "n", "lonely"), (None, "m", "<p>x</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    index = warc.write_archives(df, warc.shared_folder(spark))
    got = warc.read_records(index).collect()
    assert len(got) == len(rows)
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    want = set()
    for i, u, h in rows:
        p, f = (h or "").encode(), first.get(h or "")
        again = f is not None and f != i
        want.add((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if again else "response", f if again else None, None if again else p))
    assert {(r.page_id, r.payload_bytes, r.digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got} == want
    some = warc.read_records(index.where("page_id in (5, 6)")).collect()
    assert sorted(r.page_id for r in some) == [5, 5, 6]
    assert {r.record_type for r in warc.read_records(warc.write_archives(df, warc.shared_folder(spark), least=9)).where("page_id in (3, 4)").collect()} == {"response"}
    assert warc.archive_and_read(df.limit(0)).count() == 0


def test_a_broken_record_fails():
    good = warc.record(1, "u", b"payload", "D", None, "response")
    assert warc.parse(good)["block"] == b"payload"
    with pytest.raises(Exception):
        warc.parse(good[:-12])


def test_pipeline(spark, docs):
    df, stages = docs, dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "line_dedup", "simhash_near_dedup", "secret_scans", "packing"]
    step = lambda name, x: corpus_pipeline.staged(stages[name](spark, x, SF))
    rows = lambda x: {r.doc_id: r for r in x.collect()}
    kept = step("quality_rules", df)
    assert set(rows(kept)) == {r.row.doc_id for r in quality.judged(df).where("kept").collect()} and kept.columns == df.columns
    lined = step("line_dedup", kept)
    want = plain_line_dedup([(i, r.text or "") for i, r in rows(kept).items()])
    assert {i: r.text for i, r in rows(lined).items()} == want and lined.columns == df.columns
    near = step("simhash_near_dedup", lined)
    ids = sorted(want)
    fp = {i: plain_fingerprint(want[i]) for i in ids}
    c = plain_components([(a, b) for a in ids for b in ids if a <= b and (fp[a] ^ fp[b]).bit_count() <= 3])
    assert set(rows(near)) == {i for i in ids if c[i] == i} and near.columns == df.columns
    clean = step("secret_scans", near)
    for i, r in rows(clean).items():
        found = plain_spans(want[i])
        assert (r.text == want[i]) == (not found) and r.text.count("[secret]") <= len(found) and not plain_spans(r.text)
    assert clean.columns == df.columns
    packed = step("packing", clean).select(F.col("doc_id").alias("id"), "start", "length", F.col("ids_crc32").alias("crc"), "doc_tokens",
                                           "sequence_id", "offset")
    assert check_packing(packed.collect(), [(i, r.text) for i, r in rows(clean).items()], 4096) > 0.95
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect()))[:50] == sorted(map(tuple, packed.collect()))[:50]
