"""Near duplicates among vectors: a small-world graph per shard, every shard searched for every vector."""

from __future__ import annotations

import io
import uuid
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import shared_folder, staged
from pulsegrid.llm.components import components
from pulsegrid.llm.warc import _open

#: Least number of shards, and rows and bytes of vectors a shard may have: both and its graph (about 500 bytes a row) must fit into a task.
SHARDS, SHARD_ROWS, SHARD_BYTES = 8, 250_000, 128 << 20
#: First width of beams, share of an audit's links that must be found, and audited queries per block.
BEAM, RECALL, AUDITED = 48, 0.999, 64
#: Similarities come in single precision first; what lies this close below the limit is looked at in double.
SLACK = 1e-5


def valid(vectors: DataFrame, identifier: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``id`` and ``v`` of the vectors that can be compared: not NULL, not zero, all components finite."""
    v = vectors.select(vectors[identifier].alias("id"), vectors[vector].cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.where(F.col("id").isNotNull() & F.col("v").isNotNull() & F.coalesce(finite, F.lit(False))
                   & F.exists("v", lambda x: x != 0))


def _unit(column) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # against overflow of squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def build_shards(classes: DataFrame, shards: int, folder: str) -> DataFrame:
    """One graph per dimension and shard, written below ``folder``: (dim, path). Attempts write files of their own."""
    import pandas as pd

    def build(key, pdf):
        from pulsegrid.llm.hnsw import Graph

        x = np.array(pdf["v"].tolist(), np.float64)
        x = x / np.abs(x).max(axis=1, keepdims=True)
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        g = Graph(x)
        out = io.BytesIO()
        np.savez(out, unit=x, cid=pdf["cid"].to_numpy(np.int64), n=pdf["n"].to_numpy(np.int64), entry=g.entry, apart=g.apart,
                 **{f"layer{k}": a for k, a in enumerate(g.layers)})
        path = f"{folder}/{uuid.uuid4().hex}.npz"
        system, place = _open(path)
        system.create_dir(place.rpartition("/")[0], recursive=True)
        with system.open_output_stream(place) as f:
            f.write(out.getvalue())
        return pd.DataFrame({"dim": [int(key[0])], "path": [path]})

    return classes.groupBy("dim", F.pmod(F.xxhash64("cid"), F.lit(shards)).alias("shard")).applyInPandas(
        build, "dim int, path string")


@lru_cache(maxsize=1)
def _graph(path: str):
    from pulsegrid.llm.hnsw import Graph

    system, place = _open(path)
    with system.open_input_file(place) as f:
        z = np.load(io.BytesIO(f.read()))
        g = Graph.__new__(Graph)
        g.x, g.entry, g.apart = z["unit"].astype(np.float32), z["entry"], z["apart"]
        g.layers = [z[f"layer{k}"] for k in range(sum(name.startswith("layer") for name in z.files))]
        return g, z["unit"], z["cid"], z["n"]


def _linked(g, unit: np.ndarray, q: np.ndarray, least: float, beam: int, recall: float):
    """Verified pairs of a block of queries with a shard; beams widen until the audited queries have ``recall``."""
    audit = np.unique(np.linspace(0, len(q) - 1, min(AUDITED, len(q))).astype(int))
    a, b = np.nonzero(q[audit] @ unit.T >= least)
    true = set((audit[a] * len(unit) + b).tolist())
    while True:
        a, b = g.search(q, least - SLACK, beam)
        keep = np.zeros(len(a), bool)
        for at in range(0, len(a), 100_000):
            part = slice(at, at + 100_000)
            keep[part] = np.einsum("nd,nd->n", q[a[part]], unit[b[part]]) >= least
        a, b = a[keep], b[keep]
        found = len(true.intersection((a * len(unit) + b).tolist()))
        if beam >= len(unit) or found >= recall * len(true):
            return a, b
        beam *= 2


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (node, smallest node that it reaches within these pairs): as connected as the pairs, at most one per node."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b, label = ends[:len(a)], ends[len(a):], np.arange(len(nodes))
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        label = new[label]
        label = label[label]
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    while (label[label] != label).any():
        label = label[label]
    return nodes, nodes[label]


def search_shards(classes: DataFrame, graphs: DataFrame, least: float, beam: int = BEAM, recall: float = RECALL) -> DataFrame:
    """(cid, links, other): the links of each class, counted over the vectors of others, from each shard; and, with
    ``links`` NULL, pairs that hold the same classes together.

    Every file of the classes is read against every graph; a task has one of each in memory, a block of it at a time.
    """
    # files and graphs meet by dimension, as the names that a scan gives
    files = classes.groupBy(F.col("dim").alias("f_dim"), F.col("_metadata.file_path").alias("file")).count()
    tasks = graphs.join(files, F.col("dim") == F.col("f_dim")).select("dim", "path", "file")
    tasks = tasks.repartition(8 * int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path", "file")

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        def rows(cid, links, other):
            return pa.RecordBatch.from_arrays([pa.array(cid, pa.int64()), links, other], ["cid", "links", "other"])

        for batch in batches:
            for t in batch.to_pylist():
                g, unit, cid, n = _graph(t["path"])
                system, place = _open(t["file"])
                with system.open_input_file(place) as f:
                    for block in pq.ParquetFile(f).iter_batches(4096, columns=["cid", "dim", "v"]):
                        block = block.filter(pc.equal(block.column("dim"), t["dim"]))
                        if not block.num_rows:
                            continue
                        own, q = block.column("cid").to_numpy(), _unit(block.column("v"))
                        a, b = _linked(g, unit, q, least, beam, recall)
                        other = own[a] != cid[b]
                        a, b = a[other], b[other]
                        links = np.bincount(a, weights=n[b], minlength=len(own)).astype(np.int64)
                        some = np.flatnonzero(links)
                        yield rows(own[some], pa.array(links[some]), pa.nulls(len(some), pa.int64()))
                        node, root = _forest(own[a], cid[b])
                        node, root = node[node != root], root[node != root]
                        yield rows(node, pa.nulls(len(node), pa.int64()), pa.array(root, pa.int64()))

    return tasks.mapInArrow(run, "cid bigint, links bigint, other bigint")


def near_vectors(vectors: DataFrame, least: float = 0.9, identifier: str = "vec_id", vector: str = "embedding",
                 shards: int = SHARDS, beam: int = BEAM, recall: float = RECALL) -> DataFrame:
    """``id``, ``n_links``, ``component`` (smallest id reachable by links) of every row.

    Two vectors are linked if their cosine in double precision is ``least`` or more. Equal vectors are merged first
    and counted, so copies of one vector are neither searched nor shuffled one by one. Vectors that are NULL, zero or
    hold NULL or non-finite components, and rows with a NULL id, link with nothing, and neither do vectors of
    different length. Rows may repeat: each is a vector of its own with the same id. An empty table gives an empty one.
    """
    spark = vectors.sparkSession
    v = valid(vectors, identifier, vector)
    classes = v.groupBy("v").agg(F.min("id").alias("least"), F.count("*").alias("n")).select(
        "v", F.size("v").alias("dim"), "least", "n")
    # numbered once, in a table: later reads find the same numbers
    classes = staged(classes.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "v").select(
        "*", F.monotonically_increasing_id().alias("cid")))
    held = classes.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.col("dim").cast("bigint")) * 8, F.lit(0)).alias("bytes")).first()
    shards = max(shards, -(-held["rows"] // SHARD_ROWS), -(-held["bytes"] // SHARD_BYTES))
    graphs = staged(build_shards(classes, shards, shared_folder(spark)))
    found = staged(search_shards(classes, graphs, least, beam, recall))
    counts = found.where("links is not null").groupBy(F.col("cid").alias("l_cid")).agg(F.sum("links").alias("links"))
    c = components(found.where("links is null"), "cid", "other")
    light = classes.select("cid", "least", "n")
    named = staged(light.join(c, light.cid == c.node, "left").select("cid", "least", "n", F.coalesce("component", "cid").alias("root")))
    least_id = named.groupBy(F.col("root").alias("r")).agg(F.min("least").alias("component"))
    named = named.join(least_id, named.root == least_id.r).join(counts, named.cid == counts.l_cid, "left").select(
        F.col("cid").alias("k_cid"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component")
    by_vector = classes.select("cid", F.col("v").alias("c_v"))
    by_vector = staged(by_vector.join(staged(named), F.col("cid") == F.col("k_cid")).select("c_v", "n_links", "component"))
    rest = vectors.select(vectors[identifier].alias("id"), vectors[vector].cast("array<double>").alias("v"))
    usable = F.when(F.col("id").isNotNull(), F.col("v"))
    return rest.select("id", usable.alias("v")).join(by_vector, F.col("v") == F.col("c_v"), "left").select(
        "id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component", "id").alias("component"))
