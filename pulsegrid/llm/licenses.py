"""License detection by ordered signature rules on the words of a text."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.vectors import states_before
from pulsegrid.llm.common import packed, text_of
from pulsegrid.llm.spans import match_spans

#: What ends a word: ASCII other than digits and letters.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Fixed values. Base phrases and their labels; they are never suppressed.
BASE = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}

# Fixed values. Texts that only one license has: label, regex over words joined by one blank, keyword.
BODIES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "hereby granted"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies", "permission notice"),
    ("mit", "the software is provided as is without warranty of any kind", "without warranty"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", "permission to use"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution"),
    ("bsd-3-clause", "neither the name of (?:\\S+ ){1,12}nor the names of its contributors may be used", "neither the name"),
    ("bsd", "redistributions of source code must retain the above copyright notice", "redistributions"),
    ("apache-2.0", "apache org licenses license 2 0", "apache"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license", "applicable law"),
    ("gpl", "free software you can redistribute it and or modify it under the terms of the gnu", "free software"),
    ("gpl", "you should have received a copy of the gnu (?:\\S+ ){0,2}general public license", "general public"),
    ("gpl-2.0", "gnu general public license (?:as published by the free software foundation )?(?:either )?version 2", "general public"),
    ("gpl-3.0", "gnu general public license (?:as published by the free software foundation )?(?:either )?version 3", "general public"),
    ("lgpl", "gnu (?:lesser|library) general public license", "general public"),
    ("agpl", "gnu affero general public license", "affero"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered"),
    ("public-domain", "(?:released|dedicated|placed) (?:in|into|to) the public domain", "public domain"),
    ("public-domain", "this work is in the public domain", "public domain"),
    ("wtfpl", "do what the fuck you want to public license", "you want to"),
    ("zlib", "this notice may not be removed or altered from any source distribution", "source distribution"),
    ("boost-1.0", "boost software license version 1 0", "boost"),
    ("cc0-1.0", "creative commons (?:zero|cc0) (?:v ?)?1 0(?: universal)?", "creative commons"),
    ("proprietary", "no part of this (?:publication|work|document) may be reproduced", "reproduced"),
    ("proprietary", "confidential and proprietary", "proprietary"),
    ("copyright", "copyright (?:c )?(?:19|20)\\d\\d(?: (?:19|20)\\d\\d)?", "copyright"),
]

# Fixed values. Families: label, how the license is named in words, keywords of which a text must have one.
FAMILIES = [
    ("apache-1.1", "apache(?: software)? license (?:version )?1 1", " apache "),
    ("apache-2.0", "apache(?: software)? license (?:version |v ?)?2(?: 0)?", " apache "),
    ("apache", "apache(?: software)? license", " apache "),
    ("mit", "mit(?: x11)?(?: style)?", " mit "),
    ("x11", "x11", " x11 "),
    ("isc", "isc", " isc "),
    ("bsd-2-clause", "(?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd)", "bsd"),
    ("bsd-3-clause", "(?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd)", "bsd"),
    ("bsd-4-clause", "(?:bsd 4 clause|4 clause bsd|original bsd)", "bsd"),
    ("bsd", "bsd", "bsd"),
    ("gpl-1.0", "(?:gnu )?(?:gpl|general public license) (?:version |v ?)?1(?: 0)?", " gpl", "general public"),
    ("gpl-2.0", "(?:gnu )?(?:gpl ?v?2|gpl version 2|general public license (?:version |v ?)?2)(?: 0)?", " gpl", "general public"),
    ("gpl-3.0", "(?:gnu )?(?:gpl ?v?3|gpl version 3|general public license (?:version |v ?)?3)(?: 0)?", " gpl", "general public"),
    ("gpl", "(?:gnu )?(?:gpl|general public license)", " gpl", "general public"),
    ("lgpl-2.1", "(?:gnu )?(?:lgpl|(?:lesser|library) general public license) (?:version |v ?)?2 1", " lgpl", "general public"),
    ("lgpl-3.0", "(?:gnu )?(?:lgpl|lesser general public license) (?:version |v ?)?3(?: 0)?", " lgpl", "general public"),
    ("lgpl", "(?:gnu )?(?:lgpl|(?:lesser|library) general public license)", " lgpl", "general public"),
    ("agpl-3.0", "(?:gnu )?(?:agpl|affero general public license) (?:version |v ?)?3(?: 0)?", " agpl", "affero"),
    ("agpl", "(?:gnu )?(?:agpl|affero general public license)", " agpl", "affero"),
    ("gfdl", "(?:gnu )?(?:gfdl|free documentation license)", " gfdl ", "free documentation"),
    ("mpl-1.1", "(?:mpl|mozilla public license) (?:version |v ?)?1 1", " mpl ", "mozilla"),
    ("mpl-2.0", "(?:mpl|mozilla public license) (?:version |v ?)?2(?: 0)?", " mpl ", "mozilla"),
    ("mpl", "(?:mpl|mozilla public license)", " mpl ", "mozilla"),
    ("epl-1.0", "(?:epl|eclipse public license) (?:version |v ?)?1(?: 0)?", " epl ", "eclipse"),
    ("epl-2.0", "(?:epl|eclipse public license) (?:version |v ?)?2(?: 0)?", " epl ", "eclipse"),
    ("cddl-1.0", "(?:cddl|common development and distribution license)(?: (?:version )?1 0)?", " cddl ", "common development"),
    ("cpl-1.0", "common public license(?: (?:version )?1 0)?", "common public"),
    ("eupl-1.2", "(?:eupl|european union public licen[cs]e)(?: (?:version |v ?)?1 2)?", " eupl ", "european union"),
    ("artistic-2.0", "artistic license 2(?: 0)?", "artistic"),
    ("artistic", "artistic license", "artistic"),
    ("zlib", "zlib(?: libpng)?", "zlib"),
    ("boost-1.0", "boost(?: software)?(?: license)? 1 0", "boost"),
    ("python-2.0", "(?:psf|python software foundation)(?: license)?(?: (?:version )?2)?", " psf ", "python software"),
    ("ofl-1.1", "(?:ofl|sil open font license)(?: 1 1)?", " ofl ", "open font"),
    ("odbl-1.0", "(?:odbl|open database license)(?: (?:v ?)?1 0)?", " odbl ", "open database"),
    ("unlicense", "unlicense", "unlicense"),
    ("cc0-1.0", "cc ?0(?: 1 0)?", " cc0 ", " cc 0 "),
    *((f"cc-{kind.replace(' ', '-')}-{version}", f"(?:cc|creative commons) {kind} {version.replace('.', ' ')}", " cc ", "creative commons")
      for kind in ("by", "by sa", "by nd", "by nc", "by nc sa", "by nc nd") for version in ("1.0", "2.0", "2.5", "3.0", "4.0")),
    *((f"cc-{label}", f"creative commons {name}(?: license)?", "creative commons")
      for label, name in (("by", "attribution"), ("by-sa", "attribution share ?alike"), ("by-nd", "attribution no ?deriv(?:s|atives)"),
                          ("by-nc", "attribution non ?commercial"), ("by-nc-sa", "attribution non ?commercial share ?alike"),
                          ("by-nc-nd", "attribution non ?commercial no ?deriv(?:s|atives)"))),
]

# Fixed values. How a notice names its license, and words of which a text with it must have one; the first are the most telling.
NOTICES = [("spdx license identifier {}", "spdx license identifier"),
           ("(?:dual |multi )?licen[cs]ed under (?:the )?(?:terms of (?:the )?)?{}(?: licen[cs]e)?", "licensed under", "licenced under"),
           ("(?:released|distributed|published|available|provided) under (?:the )?(?:terms of (?:the )?)?{}(?: licen[cs]e)?",
            "released under", "distributed under", "published under", "available under", "provided under"),
           ("(?:subject to|under) the terms (?:and conditions )?of (?:the )?{}(?: licen[cs]e)?", "the terms"),
           ("licen[cs]e {}", " license ", " licence "), ("{} licen[cs]e", " license ", " licence ")]


def _gates() -> list[tuple[str, str, tuple[str, ...], tuple[str, ...], bool]]:
    """As ``rules``, with the words of the notice before ``base``; a rule without a notice has none."""
    out = [(label, regex, (key,), ()) for label, regex, key in BODIES]
    out += [(label, notice.format(name), tuple(keys), tuple(words)) for notice, *words in NOTICES for label, name, *keys in FAMILIES]
    out += [(label, name, tuple(keys), ()) for label, name, *keys in FAMILIES
            if "license" in name and not name.startswith("(?:gnu )?(?:") or label.startswith("cc")]
    out = [(label, f"(?<= )(?:{regex})(?= )", keys, words, False) for label, regex, keys, words in out]
    return out + [(label, f"(?<= ){phrase}(?= )", (phrase,), (), True) for label, phrase in BASE.items()]


def rules() -> list[tuple[str, str, tuple[str, ...], bool]]:
    """(label, regex, keywords, base), strongest first: bodies, then notices of families, names alone, and base phrases."""
    return [(label, regex, keys, base) for label, regex, keys, _, base in _gates()]


def _blanks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _detections(words: Column) -> Column:
    """All matches of all rules whose keyword the text has, and whose notice has one of its words there.

    Rules are listed under each of their keywords, so a text is searched once per keyword, whatever the number of rules.
    A rule that is reached by two keywords repeats its detections; of equal ones all but one are suppressed.
    """
    by_key = {}
    for i, (label, regex, keys, notice, base) in enumerate(_gates()):
        for key in keys:
            by_key.setdefault(key, []).append({"rank": i, "label": label, "regex": regex, "notice": notice, "base": base})
    rows = [{"key": key, "rules": of_key} for key, of_key in by_key.items()]
    table = F.from_json(F.lit(json.dumps(rows)), GATES)  # one constant, folded when the plan is made
    reached = F.flatten(F.transform(F.filter(table, lambda g: F.contains(words, g["key"])), lambda g: g["rules"]))
    gated = F.filter(reached, lambda r: (F.size(r["notice"]) == 0) | F.exists(r["notice"], lambda w: F.contains(words, w)))
    of_rule = lambda r: F.transform(match_spans(words, r["regex"], 0, _blanks), lambda m: F.struct(
        (m["start"] - 1).alias("start"), (m["start"] + _blanks(m["text"])).alias("stop"), r["rank"].alias("rank"),
        r["label"].alias("label"), r["base"].alias("base")))
    return F.flatten(F.transform(gated, of_rule))


GATES = "array<struct<key:string,rules:array<struct<rank:int,label:string,regex:string,notice:array<string>,base:boolean>>>>"


def _unsuppressed(found: Column) -> Column:
    """Without detections that lie inside another; of equal intervals the strongest rule stays. Base phrases stay."""
    ordered = F.transform(F.sort_array(F.transform(found, lambda d: F.struct(
        d["start"].alias("a"), (-d["stop"]).alias("b"), d["rank"].alias("c"), d.alias("d")))), lambda s: s["d"])
    def standing(ds: Column) -> Column:
        reach = states_before(ds, F.lit(-1), lambda r, d: F.greatest(r, d["stop"]))
        return F.transform(F.array(reach), lambda before: F.filter(ds, lambda d, i: (d["stop"] > before[i]) | d["base"]))[0]

    return F.transform(F.array(ordered), standing)[0]


def license_scan(docs: DataFrame, text: str = "text", columns=None) -> DataFrame:
    """``row`` (all columns or ``columns``), ``n_words`` and ``detections``: start, stop in words, rank, label, base.

    Each document is worked on where it is read; nothing is shuffled. Each rule runs only on texts that have one of its
    keywords, without which its regex cannot match. NULL and empty texts have no words and no detections; repeated
    rows each get their result.
    """
    docs = docs.select(*dict.fromkeys([*(columns or docs.columns), text]))
    t = packed(docs, t=F.lower(text_of(docs, text)))
    t = t.select(F.struct(*[F.col("row")[c].alias(c) for c in (columns or docs.columns)]).alias("row"),
                 F.trim(F.regexp_replace("t", NO_WORD, " ")).alias("t"))
    t = t.select("row", F.when(F.col("t") == "", " ").otherwise(F.concat(F.lit(" "), "t", F.lit(" "))).alias("t"))
    t = t.select("row", F.when(F.col("t") == " ", 0).otherwise(_blanks(F.col("t")) - 1).cast("bigint").alias("n_words"),
                 _detections(F.col("t")).alias("found"))
    return t.select("row", "n_words", F.when(F.size("found") > 0, _unsuppressed(F.col("found")))
                    .otherwise(F.col("found")).alias("detections"))


def digest(scan: DataFrame) -> DataFrame:
    """Counts, base places and labels of each document from its detections; ``score`` is the share of its words inside them."""
    d = F.col("detections")
    base = F.filter(d, lambda x: x["base"])
    labels = lambda a: F.array_join(F.array_sort(F.array_distinct(F.transform(a, lambda x: x["label"]))), ",")
    starts = F.transform(base, lambda x: x["start"])
    inside = F.aggregate(d, F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("reach")),
                         lambda acc, x: F.struct(
                             (acc["n"] + F.greatest(F.lit(0), x["stop"] - F.greatest(x["start"], acc["reach"]))).alias("n"),
                             F.greatest(acc["reach"], x["stop"]).alias("reach")), lambda acc: acc["n"])
    return scan.select("row.*", "n_words", F.size(base).cast("bigint").alias("n_base"), F.array_min(starts).alias("first_word"),
                       F.array_max(starts).alias("last_word"), labels(base).alias("base_labels"), labels(d).alias("labels"),
                       F.when(F.col("n_words") > 0, F.least(inside / F.col("n_words"), F.lit(1.0))).otherwise(0.0).alias("score"))
