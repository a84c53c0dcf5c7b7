"""The registered queries of this package, with their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import (bpe, codes, embeddings, fingerprints, licenses, lines, packing, prefixes, quality, secret_scans, sharding, simhash,
                           warc)
from pulsegrid.llm.common import read, staged

QUERIES = {}
ORACLES = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op8_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Words, base places and labels of every document."""
    return licenses.digest(licenses.license_scan(read(spark, sf, "documents"), columns=["doc_id"]))


@query
def op9_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Counts and verdict of every document."""
    j = quality.judged(read(spark, sf, "documents"), columns=["doc_id"])
    return j.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    "kept", *[name for name, _, _ in quality.SHARES])


@query
def op10_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of base secrets, digest of their places, and all places, of every document."""
    scan = secret_scans.secret_scan(read(spark, sf, "documents"), columns=["doc_id"])
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"].isin(*[r.kind for r in secret_scans.RULES if r.base]))
    of = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
    return scan.select("row.doc_id", of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"),
                       F.sha2(secret_scans.listed(base), 256).alias("base_sha256"), secret_scans.listed(spans).alias("spans"))


@query
def op4_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every document: its lines and chunks, how many of them were repeats, and a digest of what is left."""
    d = lines.line_dedup(read(spark, sf, "documents").select("doc_id", "text"))
    return d.select("row.doc_id", "n_lines", "n_chunks", "removed_lines", "removed_chunks",
                    F.length(F.coalesce("new_text", F.lit(""))).cast("bigint").alias("n_chars"),
                    F.sha2(F.coalesce("new_text", F.lit("")), 256).alias("text_sha256"))


ORACLES["op4_line_dedup"] = """WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM d),
hs AS (SELECT *, ('0x' || substr(md5(line), 1, 12))::BIGINT % 1000003 AS h FROM l),
cu AS (SELECT *, (h + 31 * coalesce(lag(h) OVER w, 0)) % 3 = 0 OR lead(h) OVER w IS NULL AS cut FROM hs
  WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
nu AS (SELECT *, coalesce(sum(cut::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c FROM cu),
ch AS (SELECT doc_id, c, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS t FROM nu GROUP BY doc_id, c),
ra AS (SELECT *, n > 1 AND regexp_matches(t, '[^\\x20\\x09-\\x0D]') AND row_number() OVER (PARTITION BY t, n > 1 ORDER BY doc_id, c) > 1 AS gone FROM ch)
SELECT doc_id, sum(n)::BIGINT AS n_lines, count(*)::BIGINT AS n_chunks, coalesce(sum(n) FILTER (gone), 0)::BIGINT AS removed_lines,
  count(*) FILTER (gone)::BIGINT AS removed_chunks, length(coalesce(string_agg(t, chr(10) ORDER BY c) FILTER (NOT gone), ''))::BIGINT AS n_chars,
  sha256(coalesce(string_agg(t, chr(10) ORDER BY c) FILTER (NOT gone), '')) AS text_sha256
FROM ra GROUP BY doc_id"""


@query
def op3_sharding(spark: SparkSession, sf: str) -> DataFrame:
    """Shard and slot of every document; counts are even."""
    s = sharding.shard(read(spark, sf, "documents"))
    return s.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard"))


@query
def op5_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Number of tokens of every document, and digests of its ids and of the text they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    e = bpe.encode(read(spark, sf, "documents"), path)
    e = e.select(F.struct("id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"))
                 .alias("of"), "ids")
    return bpe.decode(e, path).select(F.col("of.id").alias("doc_id"), "of.n_tokens", "of.ids_sha256",
                                      F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op2_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Every piece of every document and its place in a sequence of at most 4096 tokens."""
    cut = staged(packing.pieces(read(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json")))
    return packing.pack(cut).select(F.col("id").alias("doc_id"), "start", "length", F.col("crc").alias("ids_crc32"),
                                    "doc_tokens", "sequence_id", "offset")


@query
def op7_simhash(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprint and component of every document."""
    d = simhash.near_duplicates(read(spark, sf, "documents"))
    return d.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    F.col("component").alias("component_id"))


@query
def op6_warc(spark: SparkSession, sf: str) -> DataFrame:
    """Every page as its record says that was read back from the archives."""
    return warc.archive_and_read(read(spark, sf, "pages")).select(
        "page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")


ORACLES["op6_warc"] = """WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h)) AS n, sha1(h) AS s FROM p),
b AS (SELECT *, min(page_id) OVER (PARTITION BY s) AS first, array_to_string(list_transform(range(32), lambda i:
  substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(s, 1 + 5 * (i // 4)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT, 1)), '') AS digest FROM d)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to FROM b"""


@query
def op1_embedding_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Links and component of every vector; the first of each component is kept."""
    d = embeddings.near_vectors(read(spark, sf, "embeddings"))
    return d.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"),
                    (F.col("id") == F.col("component")).alias("kept"))


@query
def op11_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    """Every document: its fingerprint, that of its edited text, and their likeness and that to the next document's."""
    v = fingerprints.versions(read(spark, sf, "documents"))
    return v.select(F.col("id").alias("doc_id"), "n_chars", F.lower(F.hex("edited_sha256")).alias("edited_sha256"),
                    *[F.lower(F.hex(c)).alias(c) for c in ("fingerprint", "edited_fingerprint")], "near_edited", "near_next")


ORACLES["op11_fingerprints"] = """WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
  row_number() OVER (ORDER BY doc_id NULLS FIRST) - 1 AS r, count(*) OVER () AS rows FROM documents),
e AS (SELECT a.doc_id, a.r, b.r AS f, a.t, length(a.t) AS n, left(a.t, length(a.t) - length(a.t) // 2) || left(b.t, length(a.t) // 2) AS u
  FROM d a JOIN d b ON b.r = (a.r + 1) % a.rows),
v AS (SELECT r, 0 AS k, t FROM e UNION ALL SELECT r, 1, u FROM e),
p AS (SELECT r, k, unnest(regexp_extract_all(t, '[^.!?\n]*[.!?\n]+|[^.!?\n]+')) AS p FROM v),
q AS (SELECT r, k, (row_number() OVER (PARTITION BY r, k, p) - 1)::VARCHAR || ':' || p AS p FROM p),
g AS MATERIALIZED (SELECT r, k, ('0x' || substr(md5(p), 1, 16))::UBIGINT AS key FROM q),
s AS (SELECT r, k, j * 5 + ((key >> (16 * j)) & 4294967295) % 5 AS cell, key,
  (((key >> 32) * (key & 4294967295)) >> 16) & 4294967295 AS ch FROM g, (SELECT unnest([0, 1, 2])::UBIGINT AS j)),
c AS (SELECT r, k, cell, count(*) AS n, bit_xor(key) AS key, bit_xor(ch) AS ch FROM s GROUP BY r, k, cell),
h AS (SELECT v.r, v.k, string_agg(lower(lpad(hex(coalesce(n, 0)), 8, '0') || lpad(hex(coalesce(key, 0)), 16, '0') ||
  lpad(hex(coalesce(ch, 0)), 8, '0')), '' ORDER BY x.cell) AS fp FROM v JOIN (SELECT unnest(range(15)) AS cell) x ON true
  LEFT JOIN c ON c.r = v.r AND c.k = v.k AND c.cell = x.cell GROUP BY v.r, v.k),
z AS (SELECT v.r, v.k, count(key) AS n FROM v LEFT JOIN g USING (r, k) GROUP BY v.r, v.k),
w AS (SELECT e.r, 1 AS k, count(*) AS met FROM e JOIN g a ON a.r = e.r AND a.k = 0 JOIN g b ON b.r = e.r AND b.k = 1 AND b.key = a.key GROUP BY e.r
  UNION ALL SELECT e.r, 0, count(*) AS met FROM e JOIN g a ON a.r = e.r AND a.k = 0 JOIN g b ON b.r = e.f AND b.k = 0 AND b.key = a.key GROUP BY e.r),
l AS (SELECT e.r, y.k, CASE WHEN m.n + o.n = 0 THEN 1 ELSE coalesce(met, 0) / (m.n + o.n - coalesce(met, 0)) END::DOUBLE AS near
  FROM e JOIN (SELECT unnest([0, 1]) AS k) y ON true JOIN z m ON m.r = e.r AND m.k = 0
  JOIN z o ON o.k = y.k AND o.r = CASE WHEN y.k = 1 THEN e.r ELSE e.f END LEFT JOIN w ON w.r = e.r AND w.k = y.k)
SELECT e.doc_id, e.n::BIGINT AS n_chars, sha256(e.u) AS edited_sha256, a.fp AS fingerprint, b.fp AS edited_fingerprint,
  x.near AS near_edited, y.near AS near_next
FROM e JOIN h a ON a.r = e.r AND a.k = 0 JOIN h b ON b.r = e.r AND b.k = 1
  JOIN l x ON x.r = e.r AND x.k = 1 JOIN l y ON y.r = e.r AND y.k = 0"""


@query
def op12_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Code and error of every vector, the error of its label, and a digest of the codebooks."""
    coded, books = codes.compress(read(spark, sf, "embeddings"), columns=["vec_id", "label"])
    return codes.label_errors(coded).select("row.vec_id", "code", "error", "label_error",
                                            F.lit(codes.codebooks_sha256(books)).alias("codebooks_sha256"))


def _codes_sql(rounds: int = 4) -> str:
    near = ("SELECT p.vec_id, p.part, min({{'d': p.xx + b.yy - 2 * list_dot_product(p.x, b.y), 'e': b.e}}) AS m "
            "FROM p JOIN b{r} b USING (part) GROUP BY p.vec_id, p.part")
    steps = []
    for r in range(rounds):
        steps.append(f"""a{r} AS MATERIALIZED ({near.format(r=r)}),
s{r} AS (SELECT part, m.e AS e, i, sum(x[i])::BIGINT AS s, count(*) AS n FROM a{r} JOIN p USING (vec_id, part), (SELECT unnest(range(1, 1 + (SELECT max(len(x)) FROM p))) AS i) GROUP BY part, m.e, i),
m{r} AS (SELECT part, e, list(((s - ((s % n) + n) % n) / n)::BIGINT::DOUBLE ORDER BY i) AS y FROM s{r} GROUP BY part, e),
b{r + 1} AS MATERIALIZED (SELECT *, list_dot_product(y, y) AS yy FROM (SELECT b.part, b.e, coalesce(m{r}.y, b.y) AS y FROM b{r} b LEFT JOIN m{r} USING (part, e)))""")
    return f"""WITH k AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
p AS MATERIALIZED (SELECT *, list_dot_product(x, x) AS xx FROM (SELECT vec_id, part, v[part * len(v) // 4 + 1:(part + 1) * len(v) // 4] AS x FROM k, (SELECT unnest(range(4)) AS part))),
b0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS e, x AS y, xx AS yy FROM p
  WHERE vec_id IN (SELECT vec_id FROM k ORDER BY vec_id LIMIT 256)),
{(","+chr(10)).join(steps)},
z AS MATERIALIZED ({near.format(r=rounds)}),
c AS (SELECT vec_id, string_agg(lower(lpad(hex(m.e), 2, '0')), '' ORDER BY part) AS code, sum(m.d)::BIGINT AS error FROM z GROUP BY vec_id),
h AS (SELECT sha256(string_agg(y[i]::BIGINT::VARCHAR, ',' ORDER BY part, e, i)) AS sha FROM b{rounds}, (SELECT unnest(range(1, 1 + (SELECT max(len(x)) FROM p))) AS i))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, (SELECT sha FROM h) AS codebooks_sha256
FROM c JOIN k USING (vec_id)"""


ORACLES["op12_vector_codes"] = _codes_sql()


@query
def op13_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations, with the totals of its subtree."""
    return prefixes.trie(read(spark, sf, "conversations"))


ORACLES["op13_prefix_trie"] = """WITH t AS (SELECT conv_id AS c, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS ms
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT *, xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(c::VARCHAR, ''),
  lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda a, s: CASE WHEN s >= 0 THEN xor(a, s) ELSE xor(a >> 1, 3988292384 * (a & 1)) END),
  4294967295) % 9 AS h FROM t),
b AS (SELECT h.c, list_concat(coalesce(s.ms[1:h.h], []), h.ms[h.h + 1:]) AS ms FROM h LEFT JOIN t s ON s.c = h.c - h.c % 5),
x AS (SELECT c, len(ms) AS n, d, ms[1:d] AS p FROM (SELECT *, unnest(range(0, len(ms) + 1)) AS d FROM b)),
n AS MATERIALIZED (SELECT d, p, min(c) AS conv_id, count(*) AS n_convs, string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d) AS ends,
  CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * octet_length(encode(p[d].t)) END AS saved FROM x GROUP BY d, p),
k AS (SELECT p[1:d - 1] AS p, count(*) AS kids FROM n WHERE d > 0 GROUP BY 1),
m AS MATERIALIZED (SELECT n.*, coalesce(kids, 0) AS kids FROM n LEFT JOIN k USING (p)),
s AS (SELECT p[1:a] AS p, count(*) FILTER (kids = 0) AS n_leaves, sum(saved) AS saved_tokens FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM m) GROUP BY 1)
SELECT m.conv_id, m.d::BIGINT AS depth, u.conv_id AS parent_conv_id, m.n_convs, m.kids AS n_children, n_leaves::BIGINT AS n_leaves,
  saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(m.ends, '')) AS ends_sha256
FROM m JOIN s USING (p) LEFT JOIN n u ON m.d > 0 AND u.p = m.p[1:m.d - 1]"""
