import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.functions import names as N
from pulsegrid.operators import provenance, table
from pulsegrid.plans.features import correlate
from pulsegrid.sources import digest, series


@pytest.fixture(scope="module")
def small(spark):
    rng = np.random.default_rng(3)
    rows = [("s", int(k), float(k), float(a), float(2 * a + b), float(b), 1.0) for k, (a, b) in
            enumerate(rng.normal(size=(200, 2)))]
    rows[5] = rows[5][:3] + (float("inf"),) + rows[5][4:]
    rows[6] = rows[6][:3] + (None,) + rows[6][4:]
    return spark.createDataFrame(rows, "series string, w long, time double, a double, b double, c double, dead double")


def test_clean_and_correlate(small):
    cleaned = table.clean(small)
    assert cleaned.columns == ["series", "w", "b", "c"] or "a" in cleaned.columns
    got = {(r.f1, r.f2): r.r for r in correlate(small.withColumn("a", F.when(F.abs("a") < 1e9, F.col("a")))).collect()}
    pdf = small.toPandas()
    pdf = pdf[np.isfinite(pdf["a"].astype(float))]
    want = pdf[["a", "b", "c"]].astype(float).corr().abs()
    assert len(got) == 9
    for (x, y), r in got.items():
        assert r == pytest.approx(want.loc[x, y], abs=1e-10)


def test_normalise_stays_in_range(small):
    out = table.normalise(small.where("a < 1e9")).toPandas()
    for c in "abc":
        assert out[c].between(-1, 1).all() and np.ptp(out[c]) == pytest.approx(1)
    assert out["dead"].isna().all()


def test_long_form_reads_back(small):
    long = table.long_form(small.select("series", "w", "b", "c"))
    wide = long.groupBy("series", "w").pivot("feature", ["b", "c"]).agg(F.first("value"))
    assert wide.exceptAll(small.select("series", "w", "b", "c")).isEmpty()


def test_hours(small):
    out = table.hours(small.select("series", "w", (F.col("time") * 3600).alias("time")), 46).toPandas()
    assert out["hour"].max() == 199 and out["label"].nunique() <= 46 and out["label"].min() == 0


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_sink_reads_back(spark, small, tmp_path, fmt):
    path = str(tmp_path / fmt)
    series.write_features(small.drop("series"), path, fmt, single_file=True)
    back = spark.read.parquet(path) if fmt == "parquet" else series.read_feature_csv(spark, path)
    assert back.count() == 200
    a = back.select("w", "b").toPandas().sort_values("w")["b"].to_numpy()
    assert a == pytest.approx(small.select("w", "b").toPandas().sort_values("w")["b"].to_numpy())


def test_csv_sources_and_repair(spark, tmp_path):
    (tmp_path / "UVA0007_hr.csv").write_text("time,value\n1,60\n2,x\n3,\n4,NaN\n5,65\n")
    (tmp_path / "UVA0123_hr.csv").write_text("time,value\n1,bad\n2,70\n")
    assert series.patient_file(7, "P") == "P0007_hr.csv"
    raw = series.read_series_csv(spark, str(tmp_path / "UVA*_hr.csv"), "time_value", True, r"UVA(\d{4})")
    got = {(r.series, r.t): r.y for r in series.repair(raw, 2.0).collect()}
    assert got == {("0007", 1): 60, ("0007", 2): 60, ("0007", 3): None, ("0007", 4): None, ("0007", 5): 65,
                   ("0123", 1): None, ("0123", 2): 70}
    (tmp_path / "hr.csv").write_text("value,time\n60,1\n61,2\n")
    got = series.repair(series.read_series_csv(spark, str(tmp_path / "hr.csv"))).collect()
    assert sorted((r.series, r.t, r.y) for r in got) == [("hr", 1, 60), ("hr", 2, 61)]


def test_feature_csv_drops_text_columns(spark, tmp_path):
    (tmp_path / "f.csv").write_text("DN_Mean,IsSeasonal?,x\n1.5,True,\n2,False,3\n")
    assert series.read_feature_csv(spark, str(tmp_path / "f.csv")).columns == ["DN_Mean", "x"]


def test_names():
    assert len(N.published_names()) == 328
    assert N.slug("EX_MovingThreshold_a0.25_b0.05 meanq") == "ex_movingthreshold_a0_25_b0_05_meanq"
    assert N.plain_name("EN_CID CE1") == "Complexity CE1" and N.plain_name("IN_AutoMutualInfo Auto Mutual 1") == "Auto Mutual Info Auto Mutual 1"
    assert N.plain_name("DN_Quantile_50") == "Quantile 50" and N.plain_name("DN_Mean") == "mean"
    assert sorted(c for g in N.GROUP_PREFIXES for c in N.group_columns(g)) == sorted(
        N.slug(n) for n in N.published_names()[1:])


def test_digests(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"hello")
    row = digest.file_digests(spark, str(tmp_path / "a.txt")).first()
    assert row.sha256 == hashlib.sha256(b"hello").hexdigest() and row.bytes == 5
    old = spark.createDataFrame([("1", "x"), ("2", "y"), ("3", "z")], "k string, v string")
    new = spark.createDataFrame([("1", "x"), ("2", "Y"), ("4", "w")], "k string, v string")
    got = digest.compare_digests(digest.digests(old, "k", "v"), digest.digests(new, "k", "v")).collect()
    assert sorted((r.item, r.status) for r in got) == [("2", "changed"), ("3", "missing"), ("4", "added")]


def test_files_are_written_in_few_folders(spark, tmp_path):
    rows = [(f"k={i}.txt", f"n{i}") for i in range(500)] + [("k=7.txt", None), ("k=7.txt", "é")]
    digest.write_files(spark.createDataFrame(rows, "name string, line string").coalesce(1), f"{tmp_path}/files")
    assert len(list((tmp_path / "files").iterdir())) <= digest.FOLDERS
    got = {r.item.rpartition("/")[2]: r.sha256 for r in digest.file_digests(spark, f"{tmp_path}/files/*").collect()}
    want = {f"k={i}.txt": f"n{i}\n" for i in range(500)} | {"k=7.txt": "n7\n\né\n"}
    assert got == {k: hashlib.sha256(v.encode()).hexdigest() for k, v in want.items()}


def test_closure_looks_at_visited_pairs_only_for_items_reached_again(spark, monkeypatch):
    edges = [(f"s{i}", f"c{i % 3}") for i in range(30)] * 2 + [(f"c{i}", "n") for i in range(3)] + [("n", "r"), ("x", "r"), ("r", None)]
    edges, starts = spark.createDataFrame(edges, "src string, dst string"), spark.createDataFrame([(f"s{i}",) for i in range(30)], "start string")
    plans, staged = [], provenance.staged
    monkeypatch.setattr(provenance, "staged", lambda df: plans.append(df._jdf.queryExecution().logical().toString()) or staged(df))
    got = sorted(tuple(r) for r in provenance.supports(edges, starts).collect())
    assert got == sorted((f"s{i}", x, d) for i in range(30) for x, d in ((f"c{i % 3}", 1), ("n", 2), ("r", 3)))
    assert not any("LeftAnti" in p for p in plans)
    back = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "b"), ("a", "d"), ("d", "c"), ("c", "e"), ("e", "a")], "src string, dst string")
    got = sorted(tuple(r) for r in provenance.supports(back, spark.createDataFrame([("a",), ("c",)], "start string")).collect())
    assert got == [("a", "b", 1), ("a", "c", 2), ("a", "d", 1), ("a", "e", 3), ("c", "a", 2), ("c", "b", 1), ("c", "d", 3), ("c", "e", 1)]


def test_closure_ends_on_cycles(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("x", "y")], "src string, dst string")
    starts = spark.createDataFrame([("a",), ("d",), ("x",)], "start string")
    got = sorted(tuple(r) for r in provenance.supports(edges, starts).collect())
    assert got == [("a", "b", 1), ("a", "c", 2), ("a", "d", 3), ("x", "y", 1)]
    assert provenance.supports(edges, starts, max_depth=1).count() == 2


def test_closure_follows_long_chains(spark):
    edges = spark.createDataFrame([(f"{i}", f"{i + 1}") for i in range(40)], "src string, dst string")
    got = provenance.supports(edges, spark.createDataFrame([("0",)], "start string")).collect()
    assert sorted(r.depth for r in got) == list(range(1, 41))


def test_stages_go_where_asked_and_can_be_cleared(spark, tmp_path):
    from pulsegrid.plans import staging

    df = staging.staged(spark.range(5), str(tmp_path))
    assert df.count() == 5 and df.inputFiles()[0].startswith(f"file:{tmp_path}") or df.inputFiles()[0].startswith(f"file://{tmp_path}")
    assert staging.clear_stages(spark, str(tmp_path)) and not list(tmp_path.iterdir())[0:1] == [None]


def test_correlation_leaves_out_missing_pairs(spark):
    rows = [("s", i, float(i), float(i) if i % 2 else None, float(i % 3)) for i in range(40)]
    got = {(r.f1, r.f2): r.r for r in table.correlation(spark.createDataFrame(rows, "series string, w int, a double, b double, c double")).collect()}
    assert abs(got["a", "b"] - 1) < 1e-12 and abs(got["b", "b"] - 1) < 1e-12


def test_closure_leaves_out_what_no_start_reaches(spark, monkeypatch):
    """2,000 items meet in a hub, and one of them is a start: what is written is what it reaches, and a cycle ends."""
    edges = [(f"a{i}", "hub") for i in range(2000)] + [("hub", "x"), ("x", "y"), ("y", "hub")] + [(f"b{i}", f"b{i + 1}") for i in range(30)]
    written, keep = [], provenance.staged
    monkeypatch.setattr(provenance, "staged", lambda df, *a: (lambda out: (written.append((out.columns, out.count())), out)[1])(keep(df, *a)))
    df = spark.createDataFrame(edges, "src string, dst string")
    got = provenance.supports(df, spark.createDataFrame([("a5",), ("b28",), (None,), ("none",)], "start string")).collect()
    assert sorted(tuple(r) for r in got) == [("a5", "hub", 1), ("a5", "x", 2), ("a5", "y", 3), ("b28", "b29", 1), ("b28", "b30", 2)]
    assert sum(n for columns, n in written if "start" in columns) == 3 + 5
