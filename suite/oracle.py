"""DuckDB SQL for every registered query, written plainly: self-joins, recursion, no shared code with Spark."""

from __future__ import annotations

from itertools import product

DAY = 86400


# (values below this size, decimals kept): about seven digits
LADDER = (("1e1", 6), ("1e3", 4), ("1e5", 2), ("1e7", 0), ("1e10", -3), ("1e13", -6), ("1e17", -10))


def stable(c: str, factor: str = "1.00000000123::DOUBLE") -> str:
    """Rounds to about seven digits whatever the size, so that the order of additions does not show.

    The factor moves decimal data off the exact halves, where the last bit would decide.
    """
    cases = [f"WHEN abs({c}) < 5e-7 THEN 0.0"]
    cases += [f"WHEN abs({c}) < {size} THEN round({c} * {factor}, {digits})" for size, digits in LADDER]
    return f"CAST(CASE {' '.join(cases)} ELSE {c} END AS DOUBLE)"


def tidy(cols, body: str, ctes: str, keys=("series", "w"), where: str = "") -> str:
    """SELECT keys and rounded columns of ``res``, which ``body`` defines after ``ctes``."""
    out = [*keys, *[f"{stable(chr(34) + c + chr(34))} AS \"{c}\"" for c in cols]]
    return f"WITH RECURSIVE {ctes}, res AS ({body}) SELECT {', '.join(out)} FROM res {where}"


POINTS = {
    "user": "SELECT CAST(user_id AS VARCHAR) AS series, epoch_us(ts) / 1e6 AS t, value AS y FROM events",
    "type": "SELECT event_type AS series, epoch_us(ts) / 1e6 AS t, value AS y FROM events",
    "gappy": ("SELECT CAST(user_id AS VARCHAR) AS series, epoch_us(ts) / 1e6 AS t, "
              "CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS y FROM events"),
    "centred": "SELECT CAST(user_id AS VARCHAR) AS series, epoch_us(ts) / 1e6 AS t, value - 50 AS y FROM events",
    "scaled": "SELECT CAST(user_id AS VARCHAR) AS series, epoch_us(ts) / 1e6 AS t, value / 50 - 1 AS y FROM events",
}
POINTS["supplier"] = ("SELECT CAST(l_suppkey AS VARCHAR) AS series, epoch_us(l_shipdate) / 1e6 AS t, "
                      "l_extendedprice AS y FROM lineitem")
POINTS["tied"] = POINTS["supplier"].replace("l_extendedprice AS y", "CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE l_extendedprice END AS y")
SPANS = {"supplier": (1000 * DAY, 500 * DAY), "tied": (1000 * DAY, 500 * DAY), "user": (20 * DAY, 5 * DAY), "gappy": (20 * DAY, 5 * DAY), "centred": (20 * DAY, 5 * DAY),
         "scaled": (20 * DAY, 5 * DAY), "type": (2 * DAY, DAY)}


def windows(kind: str = "user", span: tuple[int, int] | None = None) -> str:
    """CTEs: raw, points (with yf), bounds, spine, win, r (readings), o (ordered), st (statistics of o)."""
    length, step = span or SPANS[kind]
    return f"""raw AS ({POINTS[kind]}),
points AS (SELECT *, last_value(y IGNORE NULLS) OVER (PARTITION BY series ORDER BY t, y NULLS FIRST
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS yf FROM raw),
bounds AS (SELECT series, min(t) AS t0, max(t) AS t1 FROM points GROUP BY series),
spine AS (SELECT series, w, t0 + {length} + {step} * w AS w_end FROM (
  SELECT series, t0, unnest(range(0, CAST(greatest(ceil((t1 - t0 - {length}) / {step}), 0) AS BIGINT))) AS w
  FROM bounds)),
win AS MATERIALIZED (SELECT p.series, s.w, p.t, p.y, p.yf FROM points p JOIN spine s ON p.series = s.series
  AND p.t <= trunc(s.w_end) AND p.t > trunc(s.w_end) - {length}),
r AS (SELECT series, w, t, y AS x FROM win WHERE y IS NOT NULL),
o AS MATERIALIZED (SELECT series, w, t, yf AS x, row_number() OVER (PARTITION BY series, w ORDER BY t, yf) - 1 AS i
  FROM win WHERE yf IS NOT NULL),
st AS MATERIALIZED (SELECT series, w, count(*) AS n, avg(x) AS mu, stddev_pop(x) AS sd, stddev_samp(x) AS sd1,
  min(x) AS lo, max(x) AS hi, quantile_cont(x, 0.25) AS q25, quantile_cont(x, 0.5) AS med,
  quantile_cont(x, 0.75) AS q75, quantile_cont(x, 0.9) AS q90, quantile_cont(x, 0.95) AS q95,
  quantile_cont(x, 0.99) AS q99, kurtosis_pop(x) AS kurt FROM o GROUP BY series, w)"""


def rows_only(kind: str = "user") -> str:
    """The same, with st taken over the readings instead of the filled values."""
    return windows(kind).replace("AS kurt FROM o GROUP BY", "AS kurt FROM r GROUP BY")


G = "GROUP BY series, w"
RS = "FROM r JOIN st USING (series, w) GROUP BY series, w"
OS = "FROM o JOIN st USING (series, w) GROUP BY series, w"


def pick(exprs: dict[str, str], frm: str) -> str:
    return "SELECT series, w, " + ", ".join(f'{e} AS "{c}"' for c, e in exprs.items()) + " " + frm


def simple(exprs: dict[str, str], frm: str, ctes: str) -> str:
    return tidy(exprs, pick(exprs, frm), ctes)


SUMMARY = {
    "dn_mean": "mu", "dn_range": "hi - lo", "dn_iqr": "q75 - q25", "dn_median": "med", "dn_max": "hi",
    "dn_min": "lo", "dn_kurt1": "kurt", "dn_kurt2": "kurt",
    "dn_kurt_unbiased": "((n + 1) * kurt + 6) * (n - 1) / ((n - 2) * (n - 3))",
    "dn_burstiness": "(sd / mu - 1) / (sd / mu + 1)", "dn_std": "sd",
    "dn_customskewness": "(3 * mu - med) / sd", "dn_customskewness_bowley": "(q75 + q25 - 2 * med) / (q75 - q25)",
    "dn_nlogl_norm": "0.5 + ln(sqrt(2 * pi()) * sd)",
    "dn_quantile_50": "med", "dn_quantile_75": "q75", "dn_quantile_90": "q90", "dn_quantile_95": "q95",
    "dn_quantile_99": "q99", "dn_cv_1": "sd / mu", "dn_cv_2": "pow(sd, 2) / pow(mu, 2)",
    "dn_cv_3": "pow(sd, 3) / pow(mu, 3)", "dn_fit_mle_mean": "mu", "dn_fit_mle_std": "sd",
}
DEVIATION = {
    "dn_withinp_1": "avg(CASE WHEN x BETWEEN mu - sd AND mu + sd THEN 1.0 ELSE 0.0 END)",
    "dn_withinp_2": "avg(CASE WHEN x BETWEEN mu - 2 * sd AND mu + 2 * sd THEN 1.0 ELSE 0.0 END)",
    "dn_withinp_median_1": "avg(CASE WHEN abs(x - med) <= 1.35 * (q75 - q25) THEN 1.0 ELSE 0.0 END)",
    "dn_withinp_median_2": "avg(CASE WHEN abs(x - med) <= 2 * 1.35 * (q75 - q25) THEN 1.0 ELSE 0.0 END)",
    **{f"dn_moment_{k}": f"avg(pow(x - mu, {k})) / max(sd)" for k in range(2, 7)},
    "dn_pleft": "quantile_cont(abs(x - mu), 0.9) / max(sd)",
    "dn_highlowmu": "(avg(x) FILTER (WHERE x > mu) - max(mu)) / (max(mu) - avg(x) FILTER (WHERE x < mu))",
    "dn_spread_mad": "avg(abs(x - mu))", "dn__spread_mead": "median(abs(x - med))",
    "dn_skew1": "avg(pow(x - mu, 3)) / pow(max(sd), 3)", "dn_skew2": "avg(pow(x - mu, 3)) / pow(max(sd), 3)",
    "dn_skew_unbiased": "avg(pow(x - mu, 3)) / pow(max(sd), 3) * sqrt(max(n) * (max(n) - 1)) / (max(n) - 2)",
    "dn_proportion_zeros": "avg(CASE WHEN x = 0 THEN 1.0 ELSE 0.0 END)",
    "dn_proportion_positive": "avg(CASE WHEN x > 0 THEN 1.0 ELSE 0.0 END)",
    "dn_proportion_negative": "avg(CASE WHEN x < 0 THEN 1.0 ELSE 0.0 END)",
}


def distribution(cols: list[str], kind: str = "user") -> str:
    """Any mix of the two groups above, over the readings."""
    exprs = {c: DEVIATION[c] if c in DEVIATION else f"max({SUMMARY[c]})" for c in cols}
    return simple(exprs, RS, rows_only(kind))


def value_counts(cols: list[str], kind: str = "user") -> str:
    ctes = rows_only(kind) + """,
vc AS (SELECT series, w, x, count(*) AS c, sum(count(*)) OVER (PARTITION BY series, w) AS n,
  row_number() OVER (PARTITION BY series, w ORDER BY count(*) DESC, x) AS rk FROM r GROUP BY series, w, x)"""
    exprs = {"dn_mode": "max(CASE WHEN rk = 1 THEN x END)", "dn_unique": "count(*) / max(n)",
             "en_shannonentropy": "-sum(c / n * log2(c / n))"}
    return simple({c: exprs[c] for c in cols}, f"FROM vc {G}", ctes)


def trimmed(kind: str = "user") -> str:
    ctes = rows_only(kind) + """,
rk AS (SELECT series, w, x, n, row_number() OVER (PARTITION BY series, w ORDER BY x) AS k
  FROM r JOIN st USING (series, w))"""
    exprs = {f"dn_trimmedmean_{p}": f"avg(x) FILTER (WHERE k > round_even(n * {p / 100} / 2, 0) "
             f"AND k <= n - round_even(n * {p / 100} / 2, 0))" for p in (50, 75, 25)}
    return simple(exprs, f"FROM rk {G}", ctes)


REMOVED = ["fzcacrat", "ac1rat", "ac1diff", "ac2rat", "ac2diff", "ac3rat", "ac3diff", "sumabsacfdiff", "mean",
           "median", "std", "skewnessrat", "kurtosisrat"]


def _acf_tables(src: str, name: str) -> str:
    """Lag table of ``src(series, w, i, x)`` and first zero, as CTEs with the given name prefix."""
    return f"""{name}_m AS (SELECT series, w, avg(x) AS mu, count(*) AS n FROM {src} {G}),
{name}_c AS MATERIALIZED (SELECT series, w, i, x - mu AS d, {name}_m.n FROM {src} JOIN {name}_m USING (series, w)),
{name}_v AS (SELECT series, w, sum(d * d) AS v, max(n) AS n FROM {name}_c {G}),
{name}_l AS MATERIALIZED (SELECT a.series, a.w, b.i - a.i AS k, sum(a.d * b.d) / max(v.v) AS f, max(v.n) AS n
  FROM {name}_c a JOIN {name}_c b ON a.series = b.series AND a.w = b.w AND b.i > a.i
  JOIN {name}_v v ON v.series = a.series AND v.w = a.w GROUP BY ALL),
{name}_z AS (SELECT v.series, v.w, coalesce(min(CASE WHEN l.f < 0 AND l.k <= v.n - 2 THEN l.k END), max(v.n)) AS tau
  FROM {name}_v v LEFT JOIN {name}_l l ON v.series = l.series AND v.w = l.w GROUP BY v.series, v.w)"""


ORDER = {"absfar": "abs(x)", "absclose": "-abs(x)", "min": "-x", "max": "x"}


def remove_points(how: str, p: float, prefix: str, src: str = "r", kind: str = "user") -> str:
    ctes = (rows_only if src == "r" else windows)(kind) + f""",
mk AS MATERIALIZED (SELECT series, w, t, x, n, row_number() OVER (PARTITION BY series, w ORDER BY {ORDER[how]}, t) AS rk,
  row_number() OVER (PARTITION BY series, w ORDER BY t) AS i FROM {src} JOIN st USING (series, w)),
kp AS MATERIALIZED (SELECT series, w, x, row_number() OVER (PARTITION BY series, w ORDER BY t) AS i FROM mk
  WHERE rk <= round_even(n * (1 - {p}), 0)),
{_acf_tables('mk', 'a')},
{_acf_tables('kp', 'b')},
ma AS (SELECT series, w, avg(pow(d, 3)) / pow(avg(d * d), 1.5) AS sk, avg(pow(d, 4)) / pow(avg(d * d), 2) AS ku
  FROM a_c {G}),
mb AS (SELECT series, w, avg(pow(d, 3)) / pow(avg(d * d), 1.5) AS sk, avg(pow(d, 4)) / pow(avg(d * d), 2) AS ku
  FROM b_c {G}),
mp AS (SELECT series, w, avg(x) AS mean, median(x) AS median, stddev_samp(x) AS std FROM kp {G}),
df AS (SELECT series, w, sum(abs(b_l.f - a_l.f)) AS s,
  {', '.join(f"max(CASE WHEN k = {k} THEN b_l.f / a_l.f END) AS rat{k}, max(CASE WHEN k = {k} THEN abs(b_l.f - a_l.f) END) AS dif{k}" for k in (1, 2, 3))}
  FROM a_l JOIN b_l USING (series, w, k) WHERE k <= 8 {G})"""
    e = {"fzcacrat": "b_z.tau / a_z.tau"}
    for k in (1, 2, 3):
        e[f"ac{k}rat"], e[f"ac{k}diff"] = f"rat{k}", f"dif{k}"
    e |= {"sumabsacfdiff": "s", "mean": "mean", "median": "median", "std": "std",
          "skewnessrat": "mb.sk / ma.sk", "kurtosisrat": "mb.ku / ma.ku"}
    frm = ("FROM mp JOIN df USING (series, w) JOIN ma USING (series, w) JOIN mb USING (series, w) "
           "JOIN a_z USING (series, w) JOIN b_z USING (series, w)")
    return simple({prefix + c: v for c, v in e.items()}, frm, ctes)


def outliers(how: str, inc: float, kind: str = "user") -> str:
    s = {"abs": "abs(z)", "p": "z", "n": "-z"}[how]
    ctes = windows(kind) + f""",
zz AS (SELECT o.series, o.w, i, n, (x - mu) / sd AS z FROM o JOIN st USING (series, w)),
sc AS (SELECT series, w, i, n, {s} AS s, max({s}) OVER (PARTITION BY series, w) AS top,
  count(*) FILTER (WHERE {s} >= 0) OVER (PARTITION BY series, w) AS tot FROM zz),
th AS (SELECT series, w, unnest(range(0, CAST(ceil(top / {inc}) AS BIGINT))) AS k FROM (
  SELECT series, w, max(top) AS top FROM sc {G})),
ex AS (SELECT sc.series, sc.w, k, i, n, tot, i - lag(i) OVER (PARTITION BY sc.series, sc.w, k ORDER BY i) AS gap
  FROM sc JOIN th ON sc.series = th.series AND sc.w = th.w AND floor(s / {inc}) >= k AND s >= 0)"""
    e = {"mean_gap": "avg(gap)", "std_gap": "stddev_pop(gap) / sqrt(count(*))", "pct": "count(gap) / max(tot) * 100",
         "median_at": "median(i) / (max(n) / 2) - 1", "mean_at": "avg(i) / (max(n) / 2) - 1",
         "std_at": "stddev_pop(i) / sqrt(count(*))", "th": f"k * {inc}"}
    return simple(e, "FROM ex GROUP BY series, w, k", ctes)


def autocorrelation(lags=range(1, 26), kind: str = "user") -> str:
    e = {f"co_autocorr_lag_{k}": f"max(CASE WHEN k = {k} THEN f END)" for k in lags}
    return simple(e, f"FROM o_l {G}", windows(kind) + ", " + _acf_tables("o", "o"))


SLICES = """sl AS MATERIALIZED (SELECT a.series, a.w, b.i - a.i AS k, covar_pop(a.x, b.x) AS cv, stddev_pop(a.x) AS sa,
  stddev_pop(b.x) AS sb FROM o a JOIN o b ON a.series = b.series AND a.w = b.w AND b.i > a.i {more} GROUP BY ALL),
sr AS (SELECT series, w, k, CASE WHEN sa > 1e-12 AND sb > 1e-12 THEN cv / (sa * sb) END AS r FROM sl)"""


def slice_correlation(lags=range(1, 6), kind: str = "user") -> str:
    e = {f"co_slicecorr_lag_{k}": f"max(CASE WHEN k = {k} THEN r END)" for k in lags}
    return simple(e, f"FROM sr {G}", windows(kind) + ", " + SLICES.format(more=f"AND b.i - a.i <= {max(lags)}"))


def first_lags(cols: list[str], kind: str = "user") -> str:
    ctes = windows(kind) + ", " + _acf_tables("o", "o") + ", " + SLICES.format(more="") + f""",
mn AS (SELECT series, w, k, n, f, lag(f) OVER q AS f1, lag(f, 2) OVER q AS f2 FROM o_l
  WINDOW q AS (PARTITION BY series, w ORDER BY k)),
fm AS (SELECT series, w, min(CASE WHEN k = 2 AND f > f1 AND n >= 4 THEN 1
  WHEN k > 2 AND k <= n - 2 AND f2 > f1 AND f1 < f THEN k - 1 END) AS k FROM mn {G}),
fe AS (SELECT series, w, min(CASE WHEN r < exp(-1) THEN k END) AS k FROM sr {G})"""
    e = {"co_f1ecac": "coalesce(fe.k, n)", "co_firstmin": "coalesce(fm.k, n)", "co_firstzero": "tau"}
    frm = ("FROM st JOIN o_z USING (series, w) JOIN fm USING (series, w) JOIN fe USING (series, w)")
    return simple({c: e[c] for c in cols}, frm, ctes)


def first_minimum_mi(kind: str = "user") -> str:
    ctes = windows(kind) + ", " + SLICES.format(more="") + f""",
mn AS (SELECT series, w, k, r * r AS f, lag(r * r) OVER q AS f1, lag(r * r, 2) OVER q AS f2 FROM sr
  WINDOW q AS (PARTITION BY series, w ORDER BY k)),
fm AS (SELECT series, w, min(CASE WHEN k = 2 AND f > f1 AND n >= 4 THEN 1
  WHEN k > 2 AND k <= n - 2 AND f2 > f1 AND f1 < f THEN k - 1 END) AS k FROM mn JOIN st USING (series, w) {G})"""
    return simple({"co_firstmin_mi": "coalesce(fm.k, n)"}, "FROM st JOIN fm USING (series, w)", ctes)


def lagged_products(cols: list[str], kind: str = "user") -> str:
    ctes = windows(kind) + ", " + _acf_tables("o", "o") + """,
tr AS MATERIALIZED (SELECT a.series, a.w, a.x AS a, b.x AS b, c.x AS c FROM o_z z
  JOIN o a ON a.series = z.series AND a.w = z.w
  JOIN o b ON b.series = a.series AND b.w = a.w AND b.i = a.i + z.tau
  LEFT JOIN o c ON c.series = a.series AND c.w = a.w AND c.i = a.i + 2 * z.tau)"""
    def gl(a, b):
        p, q = f"pow(abs(a), {a})", f"pow(abs(b), {b})"
        return (f"(avg({p} * {q}) - avg({p}) * avg({q})) / (sqrt(avg(pow(abs(a), {2 * a})) - pow(avg({p}), 2)) "
                f"* sqrt(avg(pow(abs(b), {2 * b})) - pow(avg({q}), 2)))")
    e = {f"co_glscf_{a}_{b}": gl(a, b) for a, b in product(range(1, 5), repeat=2)}
    e["co_tc3"] = "avg(a * b * c) / pow(abs(avg(a * b) FILTER (WHERE c IS NOT NULL)), 1.5)"
    e["co_trev"] = "avg(pow(b - a, 3)) / pow(avg(pow(b - a, 2)), 1.5)"
    return simple({c: e[c] for c in cols}, f"FROM tr {G}", ctes)


def lagged_products_mi(cols: list[str], kind: str = "user") -> str:
    """The same at the first minimum of the mutual information; NULL where that is beyond the window."""
    inner = first_minimum_mi(kind).replace("WITH RECURSIVE", "WITH", 1)
    sql = lagged_products(cols, kind).replace("tr AS MATERIALIZED", f"zi AS (SELECT series, w, CAST(co_firstmin_mi AS BIGINT) AS tau FROM ({inner})),\ntr AS MATERIALIZED", 1)
    return sql.replace("FROM o_z z", "FROM zi z", 1).replace("JOIN o a ON", "LEFT JOIN o a ON", 1).replace("JOIN o b ON", "LEFT JOIN o b ON", 1).replace(
        "SELECT a.series, a.w, a.x AS a", "SELECT z.series, z.w, CASE WHEN b.x IS NOT NULL THEN a.x END AS a", 1)


def mutual_information(delays: list[int], kind: str = "user") -> str:
    e = {f"in_automutualinfo_auto_mutual_{k}": f"max(CASE WHEN k = {k} THEN -0.5 * ln(nullif(1 - r * r, 0)) END)"
         for k in delays}
    return simple(e, f"FROM sr {G}", windows(kind) + ", " + SLICES.format(more=f"AND b.i - a.i <= {max(delays)}"))


def mutual_information_tau(kind: str = "user") -> str:
    ctes = windows(kind) + ", " + _acf_tables("o", "o") + ", " + SLICES.format(more="")
    e = {"tau": "max(tau)", "in_automutualinfo_tau": "max(CASE WHEN k = tau THEN -0.5 * ln(nullif(1 - r * r, 0)) END)"}
    return simple(e, f"FROM o_z LEFT JOIN sr USING (series, w) {G}", ctes)


def embedding(kind: str = "scaled", tau: int | str = 5, more: str = "", own: str = "") -> str:
    def sh(c):
        return f"avg(CASE WHEN {c} THEN 1.0 ELSE 0.0 END)"
    e = {}
    for k in (1, 5):
        e[f"updiag0{k}"] = sh(f"abs(z - x) < {k}")
        e[f"downdiag0{k}"] = sh(f"abs(z + x) < {k}")
        for nm, off in (("", 0), ("_1", 1), ("_n1", -1)):
            e[f"parabup0{k}{nm}"] = sh(f"abs(z - (x * x + {off})) < {k}")
            e[f"parabdown0{k}{nm}"] = sh(f"abs(z + x * x - {off}) < {k}")
    for k in (1, 2, 5):
        e[f"ring1_0{k}"] = sh(f"abs(z * z + x * x - 1) < {k}")
    discs = {"incircle_01": 1, "incircle_02": 2, "incircle_05": 5, "incircle_1": 10, "incircle_2": 20, "incircle_3": 30}
    for nm, k in discs.items():
        e[nm] = sh(f"z * z + x * x < {k}")
    ctes = windows(kind) + more + f""",
em AS (SELECT a.series, a.w, a.x, b.x AS z FROM o a {own} JOIN o b ON a.series = b.series AND a.w = b.w AND b.i = a.i + {tau}),
e0 AS ({pick(e, f'FROM em {G}')})"""
    f = {f"co_embed2_{c}": c for c in e}
    f["co_embed2_ratdiag01"] = "updiag01 / nullif(downdiag01, 0)"
    f["co_embed2_ratdiag05"] = "updiag05 / nullif(downdiag05, 0)"
    ls = "[" + ", ".join(discs) + "]"
    f["co_embed2_medianincircle"] = f"list_aggregate({ls}, 'median')"
    f["co_embed2_stdincircle"] = f"list_aggregate({ls}, 'stddev_samp')"
    return simple(f, "FROM e0", ctes)


def embedding_tau(kind: str = "scaled") -> str:
    """The same at the first zero of the window's autocorrelation; all NULL where the window is not longer."""
    return embedding(kind, "z.tau", ", " + _acf_tables("o", "o"), "JOIN o_z z ON z.series = a.series AND z.w = a.w")


def crinkle(kind: str = "user") -> str:
    ctes = windows(kind) + """,
cr AS (SELECT series, w, x, x - mu AS d, lag(x - mu) OVER q AS b, lead(x - mu) OVER q AS f, lead(x) OVER q AS x1
  FROM o JOIN st USING (series, w) WINDOW q AS (PARTITION BY series, w ORDER BY i))"""
    e = {"dk_crinkle": "avg(pow(2 * d - b - f, 4)) / pow(avg(d * d), 2)",
         "dk_theilerq": "avg(pow(x + x1, 3)) / pow(avg(x * x), 1.5)"}
    return simple(e, f"FROM cr {G}", ctes)


def apen(kind: str = "user") -> str:
    ctes = windows(kind) + f""",
tp AS MATERIALIZED (SELECT series, w, i, x AS x0, lead(x) OVER (PARTITION BY series, w ORDER BY i) AS x1, 0.2 * sd AS r, n
  FROM o JOIN st USING (series, w)),
c1 AS (SELECT a.series, a.w, a.i, count(*) / max(a.n) AS c FROM tp a JOIN tp b ON a.series = b.series AND a.w = b.w
  AND abs(a.x0 - b.x0) <= a.r GROUP BY ALL),
c2 AS (SELECT a.series, a.w, a.i, count(*) / (max(a.n) - 1) AS c FROM tp a JOIN tp b ON a.series = b.series AND a.w = b.w
  AND abs(a.x0 - b.x0) <= a.r AND abs(a.x1 - b.x1) <= a.r GROUP BY ALL),
p1 AS (SELECT series, w, avg(ln(c)) AS p FROM c1 {G}), p2 AS (SELECT series, w, avg(ln(c)) AS p FROM c2 {G})"""
    return simple({"en_apen": "p1.p - p2.p"}, "FROM p1 JOIN p2 USING (series, w)", ctes)


def sampen_ctes(src: str, keys: str, m: int, rth: float, absolute: bool = False) -> str:
    """CTE ``ab(keys, a, b, r)`` for ``src(keys, i, x)``."""
    k = [c.strip() for c in keys.split(",")]
    on = " AND ".join(f"p.{c} = q.{c}" for c in k)
    cheb = " AND ".join(f"abs(p.x{j} - q.x{j}) < p.r" for j in range(m))
    leads = ", ".join(f"lead(x, {j}) OVER (PARTITION BY {keys} ORDER BY i) AS x{j}" for j in range(1, m + 1))
    return f"""tq AS MATERIALIZED (SELECT * FROM (SELECT {keys}, i, x AS x0, {leads},
  {f"{rth}::DOUBLE" if absolute else f"{rth} * stddev_pop(x) OVER (PARTITION BY {keys})"} AS r FROM {src}) WHERE x{m} IS NOT NULL AND r > 0),
hit AS (SELECT {', '.join('p.' + c for c in k)}, count(*) AS b, count(*) FILTER (WHERE abs(p.x{m} - q.x{m}) < p.r) AS a
  FROM tq p JOIN tq q ON {on} AND p.i <> q.i AND {cheb} GROUP BY ALL),
ab AS (SELECT {keys}, r, coalesce(a, 0) AS a, coalesce(b, 0) AS b FROM (
  SELECT {keys}, max(r) AS r FROM tq GROUP BY {keys}) LEFT JOIN hit USING ({keys})),
en AS (SELECT {keys}, r, CASE WHEN b = 0 THEN NULL WHEN a = 0 THEN 'inf'::DOUBLE ELSE -ln(a / b) END AS e FROM ab)"""


def sampen(kind: str = "user", rth: float = 0.2, absolute: bool = False) -> str:
    ctes = windows(kind) + ", " + sampen_ctes("o", "series, w", 2, rth, absolute)
    return simple({"en_sample_entropy": "e", "en_quadratic_entropy": "e + ln(2 * r)"}, "FROM en", ctes)


def _mse(kind: str) -> str:
    return windows(kind) + """,
sc AS (SELECT series, w, scale, i // scale AS i, avg(x) AS x FROM o JOIN st USING (series, w),
  (SELECT unnest(range(2, 11)) AS scale) WHERE n // scale >= 20 AND i < n // scale * scale GROUP BY ALL),
""" + sampen_ctes("sc", "series, w, scale", 2, 0.15) + """,
fin AS (SELECT series, w, scale, CASE WHEN e < 'inf'::DOUBLE THEN e END AS en_mse FROM en)"""


def mse_scales(kind: str = "supplier") -> str:
    return tidy(["en_mse"], "SELECT * FROM fin", _mse(kind), keys=("series", "w", "scale"))


def mse(kind: str = "supplier") -> str:
    ctes = _mse(kind) + """,
rk AS (SELECT series, w, scale, en_mse AS e, en_mse - lag(en_mse) OVER (PARTITION BY series, w ORDER BY scale) AS ch,
  row_number() OVER (PARTITION BY series, w ORDER BY en_mse DESC, scale) AS top,
  row_number() OVER (PARTITION BY series, w ORDER BY en_mse, scale) AS low FROM fin WHERE en_mse IS NOT NULL)"""
    e = {"en_mse_max": "max(e)", "en_mse_max_at": "max(CASE WHEN top = 1 THEN scale END)", "en_mse_min": "min(e)",
         "en_mse_min_at": "max(CASE WHEN low = 1 THEN scale END)", "en_mse_mean": "avg(e)",
         "en_mse_std": "stddev_pop(e)", "en_mse_mean_change": "avg(ch)"}
    return simple(e, f"FROM rk {G}", ctes)


def permen(m: int, tau: int, kind: str = "user") -> str:
    xs = ", ".join(f"lead(x, {k * tau}) OVER (PARTITION BY series, w ORDER BY i) AS x{k}" for k in range(m))
    words = {2: "x0 <= x1", 3: "concat(x0 <= x1, x0 <= x2, x1 <= x2)"}[m]
    ctes = windows(kind) + f""",
pe AS (SELECT series, w, {words} AS word FROM (SELECT series, w, {xs} FROM o) WHERE x{m - 1} IS NOT NULL),
pc AS (SELECT series, w, word, count(*) AS c, sum(count(*)) OVER (PARTITION BY series, w) AS n FROM pe
  GROUP BY series, w, word)"""
    h = "-sum(c / n * log2(c / n))"
    full = {2: 2, 3: 6}[m]
    return simple({f"en_permen_{m}_{tau}": h, f"en_permen_norm_{m}_{tau}": f"{h} / log2({full})"}, f"FROM pc {G}", ctes)


def cid(kind: str = "user") -> str:
    ctes = windows(kind) + """,
cd AS (SELECT series, w, x - lag(x) OVER (PARTITION BY series, w ORDER BY i) AS a,
  x - lag(x) OVER (PARTITION BY series, w ORDER BY x) AS b FROM o)"""
    c1 = {c: f"sqrt(avg(1 + {c} * {c}))" for c in "ab"}
    c2 = {c: f"avg(sqrt(1 + {c} * {c}))" for c in "ab"}
    e = {"en_cid_ce1": c1["a"], "en_cid_ce2": c2["a"], "en_cid_mince1": c1["b"], "en_cid_mince2": c2["b"],
         "en_cid_ce1_norm": f"{c1['a']} / {c1['b']}", "en_cid_ce2_norm": f"{c2['a']} / {c2['b']}"}
    return simple(e, f"FROM cd {G}", ctes)


BITS = """bits AS MATERIALIZED (
  SELECT series, w, 'diff' AS method, i, n - 1 AS n, CAST(nx > x AS INTEGER) AS b FROM (
    SELECT series, w, i, x, lead(x) OVER (PARTITION BY series, w ORDER BY i) AS nx FROM o) JOIN st USING (series, w)
    WHERE nx IS NOT NULL
  UNION ALL SELECT series, w, 'mean', i, n, CAST(x > mu AS INTEGER) FROM o JOIN st USING (series, w)
  UNION ALL SELECT series, w, 'median', i, n, CAST(x > med AS INTEGER) FROM o JOIN st USING (series, w)
  UNION ALL SELECT series, w, 'iqr', i, n, CAST(x > q25 AND x < q75 AS INTEGER) FROM o JOIN st USING (series, w))"""


def binarized(kind: str = "user") -> str:
    return tidy(["i", "b"], "SELECT series, w, method, i, b FROM bits", windows(kind) + ", " + BITS,
                keys=("series", "w", "method"))


def binary_stats(kind: str = "user") -> str:
    ctes = windows(kind) + ", " + BITS + """,
fl AS (SELECT *, sum(ch) OVER (PARTITION BY series, w, method ORDER BY i) AS run FROM (
  SELECT *, CASE WHEN b = lag(b) OVER (PARTITION BY series, w, method ORDER BY i) THEN 0 ELSE 1 END AS ch FROM bits)),
rn AS (SELECT series, w, method, run, max(b) AS b, count(*) AS len, max(n) AS n FROM fl GROUP BY ALL),
ag AS (SELECT series, w, method, count(*) FILTER (WHERE b = 1) / max(n) AS pstretch1,
  coalesce(max(len) FILTER (WHERE b = 0), 0) AS longstretch0, coalesce(avg(len) FILTER (WHERE b = 0), 0) AS meanstretch0,
  stddev_samp(len) FILTER (WHERE b = 0) AS stdstretch0, coalesce(max(len) FILTER (WHERE b = 1), 0) AS longstretch1,
  coalesce(avg(len) FILTER (WHERE b = 1), 0) AS meanstretch1, stddev_samp(len) FILTER (WHERE b = 1) AS stdstretch1
  FROM rn GROUP BY series, w, method),
hv AS (SELECT series, w, method, count(*) FILTER (WHERE b = 1 AND i >= n // 2)
  / nullif(count(*) FILTER (WHERE b = 1 AND i < n // 2), 0) AS pupstat2 FROM bits GROUP BY series, w, method),
al AS (SELECT *, meanstretch1 - meanstretch0 AS meanstretchdiff, stdstretch1 - stdstretch0 AS stdstretchdiff
  FROM ag JOIN hv USING (series, w, method))"""
    names = ["pupstat2", "pstretch1", "longstretch0", "meanstretch0", "stdstretch0", "longstretch1", "meanstretch1",
             "stdstretch1", "meanstretchdiff", "stdstretchdiff"]
    e = {f"sb_binarymethod_{m}_{c}": f"max(CASE WHEN method = '{m}' THEN {c} END)"
         for m in ("diff", "mean", "median", "iqr") for c in names}
    return simple(e, f"FROM al {G}", ctes)


def motifs(kind: str = "user", how: str = "diff") -> str:
    ctes = windows(kind) + ", " + BITS + """,
l0 AS (SELECT series, w, i, CASE WHEN b = 1 THEN 'u' ELSE 'd' END AS l FROM bits WHERE method = '""" + how + """'),
wd AS (SELECT series, w, l AS w1, l || lead(l) OVER q AS w2, l || lead(l) OVER q || lead(l, 2) OVER q AS w3,
  l || lead(l) OVER q || lead(l, 2) OVER q || lead(l, 3) OVER q AS w4 FROM l0
  WINDOW q AS (PARTITION BY series, w ORDER BY i))"""
    e, freq = {}, {}
    for size in range(1, 5):
        for p in product("du", repeat=size):
            word = "".join(p)
            freq[word] = f"count(*) FILTER (WHERE w{size} = '{word}') / count(w{size})"
            e[f"sb_motiftwo_{how}_" + word] = freq[word]
    for size in range(1, 5):
        terms = [f"coalesce(({freq[''.join(p)]}) * ln(nullif({freq[''.join(p)]}, 0)), 0)" for p in product("du", repeat=size)]
        e[f"sb_motiftwo_{how}_" + "h" * size] = "-(" + " + ".join(terms) + ")"
    return simple(e, f"FROM wd {G}", ctes)


def trend(kind: str = "user") -> str:
    ctes = windows(kind) + """,
tz AS (SELECT series, w, i, n, (x - mu) / sd AS z FROM o JOIN st USING (series, w)),
ty AS (SELECT *, sum(z) OVER (PARTITION BY series, w ORDER BY i) AS c FROM tz)"""
    e = {"trend_stdratio": "sqrt(1 - regr_r2(z, i))", "trend_gradient": "regr_slope(z, i)",
         "trend_intercept": "regr_intercept(z, i)", "trend_meanyc": "avg(c)", "trend_stdyc": "stddev_pop(c)",
         "trend_gradientyc": "regr_slope(c, i)", "trend_interceptyc": "regr_intercept(c, i)",
         "trend_meanyc12": "avg(c) FILTER (WHERE i < n // 2)", "trend_meanyc22": "avg(c) FILTER (WHERE i >= n // 2)"}
    return simple(e, f"FROM ty {G}", ctes)


def segment_means(kind: str = "user") -> str:
    ctes = windows(kind) + """,
pl AS (SELECT kind, k FROM (SELECT unnest(['seg', 'len']) AS kind), (SELECT unnest([2, 3, 4, 5, 10]) AS k)),
sg AS (SELECT series, w, kind, k, CASE WHEN kind = 'seg' THEN i // (n // k) ELSE i // k END AS g, x, sd1,
  CASE WHEN kind = 'seg' THEN k ELSE n // k END AS parts FROM o JOIN st USING (series, w), pl
  WHERE (kind = 'seg' AND n >= k) OR (kind = 'len' AND n > 2 * k)),
sm AS (SELECT series, w, kind, k, g, avg(x) AS m, max(sd1) AS s FROM sg WHERE g < parts GROUP BY ALL),
sv AS (SELECT series, w, kind, k, stddev_samp(m) / max(s) AS v FROM sm GROUP BY ALL)"""
    e = {f"sy_statav_{kd}_{k}": f"max(CASE WHEN kind = '{kd}' AND k = {k} THEN v END)"
         for kd in ("seg", "len") for k in (2, 3, 4, 5, 10)}
    return simple(e, f"FROM sv {G}", ctes)


def drifting_mean(size: str = "5", kind: str = "user", span: tuple[int, int] | None = None) -> str:
    ctes = windows(kind, span) + f""",
dm AS (SELECT series, w, i // ({size}) AS g, avg(x) AS m, var_samp(x) AS v FROM o JOIN st USING (series, w)
  WHERE n >= {size} AND i < n // ({size}) * ({size}) GROUP BY ALL),
dv AS (SELECT series, w, max(m) / avg(v) AS mx, min(m) / avg(v) AS mn, avg(m) / avg(v) AS me FROM dm {G})"""
    e = {"sy_driftingmean__max": "mx", "sy_driftingmean__min": "mn", "sy_driftingmean__mean": "me",
         "sy_driftingmean__meanmaxmin": "(mx + mn) / 2", "sy_driftingmean__meanabsmaxmin": "(abs(mx) + abs(mn)) / 2"}
    return simple(e, "FROM dv", ctes)


def moving_threshold(kind: str = "user") -> str:
    ctes = windows(kind) + f""",
ga AS (SELECT a, b, ta || tb AS tag FROM (VALUES (0.25::DOUBLE, 'a0_25'), (0.5, 'a0_5'), (1.0, 'a1')) x(a, ta),
  (VALUES (0.05::DOUBLE, '_b0_05'), (0.1, '_b0_1'), (0.25, '_b0_25')) z(b, tb)),
ab AS MATERIALIZED (SELECT series, w, i, abs(x) AS x FROM o),
rec AS (SELECT series, w, tag, a, b, CAST(0 AS BIGINT) AS i, x, 1.0::DOUBLE AS q, 0.0::DOUBLE AS kick FROM ab, ga WHERE i = 0
  UNION ALL SELECT r.series, r.w, r.tag, r.a, r.b, ab.i, ab.x,
    CASE WHEN ab.x > r.q THEN (1 + r.a) * ab.x ELSE (1 - r.b) * r.q END,
    CASE WHEN ab.x > r.q THEN (1 + r.a) * ab.x - r.q ELSE 0.0 END
  FROM rec r JOIN ab ON ab.series = r.series AND ab.w = r.w AND ab.i = r.i + 1),
kg AS (SELECT series, w, tag, i - lag(i) OVER (PARTITION BY series, w, tag ORDER BY i) AS g FROM rec WHERE kick > 0),
kx AS (SELECT series, w, tag, stddev_pop(g) AS stdkicks, avg(g) AS meankickf, median(g) AS mediankicksf FROM kg
  GROUP BY series, w, tag),
qs AS (SELECT series, w, tag, avg(q) AS meanq, median(q) AS medianq, quantile_cont(q, 0.75) - quantile_cont(q, 0.25) AS iqrq,
  max(q) AS maxq, min(q) AS minq, stddev_pop(q) AS stdq, avg(q - x) AS meanqover, sum(kick) / count(*) - 1 AS pkick
  FROM rec GROUP BY series, w, tag),
qa AS (SELECT * FROM qs LEFT JOIN kx USING (series, w, tag))"""
    names = ["meanq", "medianq", "iqrq", "maxq", "minq", "stdq", "meanqover", "pkick", "stdkicks", "meankickf",
             "mediankicksf"]
    e = {f"ex_movingthreshold_{a}{b}_{c}": f"max(CASE WHEN tag = '{a}{b}' THEN {c} END)"
         for a in ("a0_25", "a0_5", "a1") for b in ("_b0_05", "_b0_1", "_b0_25") for c in names}
    return simple(e, f"FROM qa {G}", ctes)


def hurst(kind: str = "user") -> str:
    ctes = windows(kind) + f""",
hs AS (SELECT series, w, i, x, e, n // CAST(pow(2, e) AS BIGINT) AS len FROM o JOIN st USING (series, w),
  (SELECT unnest(range(0, 40)) AS e) WHERE e < floor(log2(n))),
hc AS (SELECT series, w, e, len, i // len AS g, i, x, x - avg(x) OVER (PARTITION BY series, w, e, i // len) AS d FROM hs
  WHERE i < len * CAST(pow(2, e) AS BIGINT)),
hz AS (SELECT *, sum(d) OVER (PARTITION BY series, w, e, g ORDER BY i) AS z FROM hc),
hr AS (SELECT series, w, e, len, g, max(z) - min(z) AS r, stddev_pop(x) AS s FROM hz GROUP BY ALL),
hm AS (SELECT series, w, len, avg(r / CASE WHEN s = 0 THEN 1 ELSE s END) AS rs FROM hr GROUP BY series, w, e, len)"""
    return simple({"sc_hurstexp": "regr_slope(ln(rs), ln(len))"}, f"FROM hm {G}", ctes)


def dfa(name: str, sizes: str, kind: str = "user", span=None) -> str:
    """``sizes``: SQL predicate on box size t and length n."""
    ctes = windows(kind, span) + f""",
pf AS MATERIALIZED (SELECT series, w, i, n, sum(x - mu) OVER (PARTITION BY series, w ORDER BY i) AS p
  FROM o JOIN st USING (series, w)),
bx AS (SELECT series, w, t, i // t AS g, regr_syy(p, i) AS yy, regr_sxy(p, i) AS xy, regr_sxx(p, i) AS xx FROM pf,
  (SELECT unnest(range(1, (SELECT max(n) + 1 FROM st))) AS t) WHERE ({sizes}) AND t <= n AND i < n // t * t
  GROUP BY series, w, t, i // t),
ff AS (SELECT series, w, t, sqrt(sum(greatest(yy - xy * xy / xx, 0)) / (count(*) * t)) AS f FROM bx GROUP BY series, w, t)"""
    return simple({name: "regr_slope(ln(f), ln(t))"}, f"FROM ff {G}", ctes)


DENSITY = """gr AS (SELECT series, w, n, mu, sd, lo, hi, sd1 * pow(n, -0.2) AS h, (hi - lo) / ({p} - 1) AS dx FROM {src}),
gp AS (SELECT *, k, lo + k * dx AS gx FROM gr, (SELECT unnest(range(0, {p})) AS k)),
kd AS MATERIALIZED (SELECT g.series, g.w, g.k, max(gx) AS gx, max(dx) AS dx, max(mu) AS mu, max(sd) AS sd, max(lo) AS lo,
  max(hi) AS hi, sum(exp(-0.5 * pow((gx - x) / h, 2))) / (max(n) * max(h) * sqrt(2 * pi())) AS f
  FROM gp g JOIN {rows} q ON q.series = g.series AND q.w = g.w GROUP BY g.series, g.w, g.k)"""


def compare_fit(dist: str = "norm", kind: str = "user") -> str:
    if dist == "beta":
        src = """sq AS MATERIALIZED (SELECT o.series, o.w, (x - lo + 0.01 * sd) / (hi - lo + 0.02 * sd) AS x
  FROM o JOIN st USING (series, w)),
sq_st AS (SELECT series, w, count(*) AS n, avg(x) AS mu, stddev_pop(x) AS sd, stddev_samp(x) AS sd1, min(x) AS lo,
  max(x) AS hi FROM sq GROUP BY series, w), """ + DENSITY.format(p=1000, src="sq_st", rows="sq")
        both = "(mu * (1 - mu) / (sd * sd) - 1)"
        a, b = f"(mu * {both})", f"((1 - mu) * {both})"
        fit = f"exp(({a} - 1) * ln(gx) + ({b} - 1) * ln(1 - gx) - (lgamma({a}) + lgamma({b}) - lgamma({a} + {b})))"
    else:
        src = DENSITY.format(p=1000, src="st", rows="o")
        fit = "1 / (hi - lo)" if dist == "uni" else "exp(-0.5 * pow((gx - mu) / sd, 2)) / (sd * sqrt(2 * pi()))"
    ctes = windows(kind) + ", " + src + f", fd AS (SELECT *, {fit} AS q FROM kd)"
    name = "dn_compareksfit_" + ("" if dist == "norm" else dist + "_")
    e = {f"{name}adiff": "sum(abs(f - q)) * max(dx)", f"{name}peaksepy": "max(q) - max(f)",
         f"{name}relent": "sum(CASE WHEN f > 0 AND q > 0 THEN f * ln(f / q) ELSE 0 END) * max(dx)"}
    return simple(e, f"FROM fd {G}", ctes)


def kernel_shape(kind: str = "user") -> str:
    ctes = windows(kind) + ", " + DENSITY.format(p=100, src="st", rows="o") + """,
ks AS (SELECT *, f - lag(f) OVER q AS d1, lead(f) OVER q - f AS d2, lead(f) OVER q AS nf, lead(gx) OVER q AS nx FROM kd
  WINDOW q AS (PARTITION BY series, w ORDER BY k))"""
    e = {"npeaks": "count(*) FILTER (WHERE d1 * d2 < 0 AND d2 - d1 < -0.0002)", "max": "max(f)",
         "entropy": "-sum(CASE WHEN f > 0 THEN f * ln(f) ELSE 0 END) * max(dx)",
         "asym": "sum(f) FILTER (WHERE gx > mu) / sum(f) FILTER (WHERE gx < mu)",
         "plsym": "sum(abs(nf - f)) FILTER (WHERE gx < mu AND nx < mu) / sum(abs(nf - f)) FILTER (WHERE gx > mu AND nx > mu)",
         "numcross_0_005": "count(*) FILTER (WHERE (f - 0.005) * (nf - 0.005) < 0)",
         "area_0_005": "coalesce(sum(f) FILTER (WHERE f < 0.005), 0) * max(dx)",
         "arclength_20": "coalesce(sum(abs(nf - f)) FILTER (WHERE gx > mu - 20 AND gx < mu + 20 AND nx > mu - 20 AND nx < mu + 20), 0) * max(dx)"}
    return simple({"dn_fitkernal_" + c: v for c, v in e.items()}, f"FROM ks {G}", ctes)


def seasonal(kind: str = "user") -> str:
    ctes = windows(kind) + f""",
fq AS (SELECT o.series, o.w, j, max(n) AS n, max(sd) AS sd, var_pop(cos(pi() * j * i / (2 * n))) * max(n) AS cc, var_pop(sin(pi() * j * i / (2 * n))) * max(n) AS ss,
  covar_pop(cos(pi() * j * i / (2 * n)), sin(pi() * j * i / (2 * n))) * max(n) AS cs,
  sum((x - mu) * cos(pi() * j * i / (2 * n))) AS xc, sum((x - mu) * sin(pi() * j * i / (2 * n))) AS xs
  FROM o JOIN st USING (series, w), (SELECT unnest(range(4, (SELECT 2 * max(n) + 1 FROM st))) AS j)
  WHERE j <= 2 * n GROUP BY o.series, o.w, j),
pw AS (SELECT series, w, max(CASE WHEN cc * ss - cs * cs < 1e-6 * n * n THEN xc * xc / greatest(cc, 1e-9)
  ELSE (xc * xc * ss - 2 * xc * xs * cs + xs * xs * cc) / (cc * ss - cs * cs) END / (n * sd * sd)) AS r2 FROM fq WHERE sd > 0 {G})"""
    return (f"WITH RECURSIVE {ctes} SELECT series, w, {stable('r2')} AS seasonal_r2, r2 > 0.3 AS isseasonal FROM pw")


def spine(kind: str = "user") -> str:
    return tidy(["w_end"], "SELECT series, w, w_end FROM spine", windows(kind))


def window_rows(kind: str = "user") -> str:
    return tidy(["t", "y", "yf"], "SELECT series, w, t, y, yf FROM win", windows(kind))


def ordered_rows(kind: str = "gappy") -> str:
    return tidy(["i", "t", "x"], "SELECT series, w, i, t, x FROM o", windows(kind))


def observations(kind: str = "gappy") -> str:
    return tidy(["observations"], "SELECT series, w, count(y) AS observations FROM win GROUP BY series, w", windows(kind))


def carried(kind: str = "gappy") -> str:
    return tidy(["t", "y", "yf"], "SELECT series, t, y, yf FROM points", windows(kind), keys=("series",))


def gated(cols: dict[str, str], kind: str, span: tuple[int, int], raw: str | None = None) -> str:
    """Spine with time, observation count, and expressions over r that stop at the gates.

    ``cols``: name -> (expression, whether a constant window has it).
    """
    ctes = windows(kind, span)
    if raw:
        ctes = ctes.replace(f"raw AS ({POINTS[kind]})", f"raw AS ({raw})")
    ctes = ctes.replace("AS kurt FROM o GROUP BY", "AS kurt FROM r GROUP BY") + """,
ct AS (SELECT series, w, count(*) AS points, count(y) AS obs, stddev_pop(y) AS gsd FROM win GROUP BY series, w)"""
    parts = ["w_end AS time", "CASE WHEN points > 1 THEN obs END AS observations"]
    for c, (e, constant) in cols.items():
        gate = "points > 1 AND obs > 10" + ("" if constant else " AND gsd > 0")
        parts.append(f"CASE WHEN {gate} THEN {e} END AS {c}")
    body = (f"SELECT series, w, {', '.join(parts)} FROM spine LEFT JOIN ct USING (series, w) "
            "LEFT JOIN st USING (series, w)")
    return tidy(["time", "observations", *cols], body, ctes)


def joined(parts: list[str], ctes_first: str, cols: list[str]) -> str:
    """Joins finished oracle queries on the window, keeping the given columns."""
    sql = f"SELECT {', '.join(cols)} FROM ({ctes_first}) q0"
    for n, part in enumerate(parts, start=1):
        sql += f" LEFT JOIN ({part}) q{n} USING (series, w)"
    return sql


TABLE_COLS = {"dn_mean": "mu", "dn_std": "sd", "dn_iqr": "q75 - q25", "dn_median": "med", "dn_max": "hi",
              "dn_kurt1": "kurt"}


def feature_ctes(kind: str = "type") -> str:
    """``ft``: a small feature table with a constant column and, in some windows, a value that is not finite."""
    body = ", ".join(f"{e} AS {c}" for c, e in TABLE_COLS.items())
    return rows_only(kind) + f""",
ft AS MATERIALIZED (SELECT series, w, w_end AS time, {body}, 1.0::DOUBLE AS dead,
  CASE WHEN w % 7 = 0 THEN 'inf'::DOUBLE ELSE sd / mu END AS ratio, sd > mu AS isseasonal
  FROM st JOIN spine USING (series, w))"""


def table_query(cols: list[str], body: str, extra: str = "", keys=("series", "w"), kind: str = "type") -> str:
    return tidy(cols, body, feature_ctes(kind) + extra, keys=keys)


def correlations(cols: list[str], where: str, frm: str = "ft", kind: str = "type") -> str:
    named = " UNION ALL ".join(f"SELECT series, w, '{c}' AS f, CAST({c} AS DOUBLE) AS v FROM {frm} WHERE {where}" for c in cols)
    ctes = feature_ctes(kind) + f", lg AS ({named})"
    body = ("SELECT a.f AS f1, b.f AS f2, abs(corr(a.v, b.v)) AS r FROM lg a JOIN lg b USING (series, w) "
            "GROUP BY a.f, b.f")
    return tidy(["r"], body, ctes, keys=("f1", "f2"))
