"""Names of the default output columns: the published ones and their snake_case form here."""

from __future__ import annotations

import re
from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: parts of the published column names
REMOVE = ["fzcacrat", "ac1rat", "ac1diff", "ac2rat", "ac2diff", "ac3rat", "ac3diff", "sumabsacfdiff",
          "mean", "median", "std", "skewnessrat", "kurtosisrat"]
BINARY = ["pupstat2", "pstretch1", "longstretch0", "meanstretch0", "stdstretch0", "longstretch1",
          "meanstretch1", "stdstretch1", "meanstretchdiff", "stdstretchdiff"]
THRESHOLD = ["meanq", "medianq", "iqrq", "maxq", "minq", "stdq", "meanqover", "pkick", "stdkicks",
             "meankickf", "mediankicksf"]
TREND = ["stdRatio", "gradient", "intercept", "meanYC", "stdYC", "gradientYC", "interceptYC",
         "meanYC12", "meanYC22"]

# present even for a constant window, which stops after the standard deviation
CONSTANT_WINDOW = ["DN_Mean", "DN_Range", "DN_IQR", "DN_Median", "DN_Max", "DN_Min", "DN_Mode", "DN_skew1",
                   "DN_skew2", "DN_kurt1", "DN_kurt2", "DN_Burstiness", "DN_Unique", "DN_Withinp 1",
                   "DN_Withinp 2", "EN_ShannonEntropy", "DN_std"]


def distribution_names() -> list[str]:
    """The 52 distribution features, in output order."""
    return (CONSTANT_WINDOW + [f"DN_Moment {k}" for k in range(2, 7)]
            + ["DN_pleft", "DN_CustomSkewness", "DN_HighLowMu", "DN_nlogL_norm"]
            + [f"DN_Quantile_{q}" for q in (50, 75, 90, 95, 99)]
            + [f"DN_RemovePoints {c}" for c in REMOVE]
            + ["DN_Spread_mad", "DN__Spread_mead"]
            + [f"DN_TrimmedMean {k}" for k in (50, 75, 25)] + [f"DN_cv {k}" for k in (1, 2, 3)])


def _motif_names() -> list[str]:
    words = []
    for size in range(1, 5):
        letters = "ud" if size == 1 else "du"
        words += ["".join(p) for p in product(letters, repeat=size)] + ["h" * size]
    return words


def ordered_names() -> list[str]:
    """The 275 features of the ordered values, in output order."""
    return ([f"CO_AutoCorr lag {k}" for k in range(1, 26)] + ["CO_f1ecac", "CO_FirstMin", "CO_FirstZero"]
            + [f"CO_glscf {a} {b}" for a in range(1, 5) for b in range(1, 5)] + ["CO_tc3", "CO_trev"]
            + [f"DN_CompareKSFit {c}" for c in ("adiff", "peaksepy", "relent")] + ["IsSeasonal?", "EN_ApEn"]
            + [f"EN_CID {c}" for c in ("CE1", "CE2", "minCE1", "minCE2", "CE1_norm", "CE2_norm")]
            + ["EN_Sample Entropy", "EN_Quadratic Entropy", "IN_AutoMutualInfo Auto Mutual 1"]
            + [f"Trend {c}" for c in TREND]
            + [f"DN_RemovePoints{how}_0.6 {c}" for how in ("absfar", "absclose") for c in REMOVE]
            + ["DK_crinkle", "DK_theilerQ"] + [f"SB_MotifTwo_diff {c}" for c in _motif_names()]
            + [f"SB_BinaryMethod_{m} {c}" for m in ("diff", "mean", "median", "iqr") for c in BINARY]
            + [f"EX_MovingThreshold_a{a}_b{b} {c}" for a in ("0.25", "0.5", "1") for b in ("0.05", "0.1", "0.25")
               for c in THRESHOLD]
            + [f"SY_DriftingMean_ {c}" for c in ("max", "min", "mean", "meanmaxmin", "meanabsmaxmin")])


# operators whose columns are named differently
OPERATOR_COLUMNS = {
    "DN_MinMax": ("DN_Max", "DN_Min"), "DN_Cumulants": ("DN_skew", "DN_kurt"), "DN_STD": ("DN_std",),
    "EN_ShannonEn": ("EN_ShannonEntropy",), "DN_Moments": ("DN_Moment",), "DN_Spread": ("DN_Spread", "DN__Spread"),
    "EN_SampEn": ("EN_Sample", "EN_Quadratic"), "SY_Trend": ("Trend",), "DT_IsSeasonal": ("IsSeasonal?",),
    "SB_BinaryStats": ("SB_BinaryMethod",), "DN_ObsCount": ("Observations",),
}

# which group of ``plans.features`` makes which columns, by the start of the published name
GROUP_PREFIXES = {
    "summary": ("DN_Mean", "DN_Range", "DN_IQR", "DN_Median", "DN_Max", "DN_Min", "DN_skew", "DN_kurt",
                "DN_Burstiness", "DN_std", "DN_CustomSkewness", "DN_nlogL_norm", "DN_Quantile", "DN_cv"),
    "deviations": ("DN_Withinp", "DN_Moment", "DN_pleft", "DN_HighLowMu", "DN_Spread", "DN__Spread"),
    "values": ("DN_Mode", "DN_Unique", "EN_ShannonEntropy"), "trimmed": ("DN_TrimmedMean",),
    "removed": ("DN_RemovePoints ",), "autocorrelation": ("CO_AutoCorr",),
    "first_lags": ("CO_f1ecac", "CO_FirstMin", "CO_FirstZero"), "lagged": ("CO_glscf", "CO_tc3", "CO_trev"),
    "fit": ("DN_CompareKSFit",), "season": ("IsSeasonal?",), "apen": ("EN_ApEn",), "cid": ("EN_CID",),
    "sampen": ("EN_Sample", "EN_Quadratic"), "information": ("IN_AutoMutualInfo",), "trend": ("Trend",),
    "removed_far": ("DN_RemovePointsabsfar",), "removed_close": ("DN_RemovePointsabsclose",), "crinkle": ("DK_",),
    "motifs": ("SB_MotifTwo",), "binary": ("SB_BinaryMethod",), "threshold": ("EX_MovingThreshold",),
    "drift": ("SY_DriftingMean",),
}


def group_columns(group: str) -> list[str]:
    """Column names here of one feature group."""
    return [slug(n) for n in published_names() if n.startswith(GROUP_PREFIXES[group])]


def slug(name: str) -> str:
    """Column name here for a published name."""
    return re.sub(r"[ .]", "_", name.lower()).replace("?", "").replace(",", "")


def published_names() -> list[str]:
    """All default columns of a window, without the window's key and time."""
    return ["Observations", *distribution_names(), *ordered_names()]


def with_published_names(df: DataFrame) -> DataFrame:
    """Renames feature columns to the published names; other columns stay."""
    back = {slug(n): n for n in published_names()}
    return df.select(*[F.col(f"`{c}`").alias(back.get(c, c)) for c in df.columns])


# fixed values: plain names used by the earlier output format, where they do not follow the rule below
PLAIN_NAMES = {
    "DN_Unique": "Percent Unique", "DN_Withinp 1": "Within 1 std", "DN_Withinp 2": "Within 2 std",
    "EN_ShannonEntropy": "Shannon Entropy", "DN_CustomSkewness": "Pearson Skew",
    "DN_HighLowMu": "High Low Mean Ratio", "DN_nlogL_norm": "Log liklihood of Norm fit",
    "DN_Spread_mad": "Mean Abs Deviation", "DN__Spread_mead": "Median Abs Deviation",
    "DN_TrimmedMean 50": "trimmed mean 50", "DN_TrimmedMean 75": "trimmed mean 75",
    "DN_TrimmedMean 25": "trimmed mean 25",
}
KEPT_NAMES = ("DN_cv", "DN_RemovePoints", "DN_CompareKSFit", "Trend", "IsSeasonal?", "Observations")
# groups of columns with a word of their own in that format
PLAIN_GROUPS = {"EN_CID ": "Complexity ", "IN_AutoMutualInfo ": "Auto Mutual Info "}


def plain_name(name: str) -> str:
    """Name of a published feature in the earlier output format."""
    if name in PLAIN_NAMES or name.startswith(KEPT_NAMES):
        return PLAIN_NAMES.get(name, name)
    for start, word in PLAIN_GROUPS.items():
        if name.startswith(start):
            return word + name.removeprefix(start)
    rest = re.sub(r"^(DN|CO|EN)_", "", name).replace("_", " ")
    return rest.lower() if rest in ("Mean", "Range", "IQR", "Median", "Max", "Min", "Mode") else rest


def with_plain_names(df: DataFrame) -> DataFrame:
    """Renames feature columns to the earlier output format's names; other columns stay."""
    back = {slug(n): plain_name(n) for n in published_names()}
    return df.select(*[F.col(f"`{c}`").alias(back.get(c, c)) for c in df.columns])
