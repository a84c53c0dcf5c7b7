"""Places of regex matches in a text, from functions that return only texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulsegrid.functions.vectors import states_before

SPAN = "array<struct<start:bigint,stop:bigint,text:string,part:string>>"


def match_spans(text: Column, regex: Column, part: int = 0, size=F.length) -> Column:
    """All leftmost non-overlapping matches: start, stop (exclusive), the match and its group ``part``.

    The text is cut at the matches; the lengths of the pieces and of the matches, added up in turn, are the places.
    ``size`` measures a piece, in code points by default. A regex that matches the empty text is not allowed. Time
    grows with the text and the number of matches, not with its square.
    """
    found = F.struct(F.regexp_extract_all(text, regex, F.lit(0)).alias("all"),
                     F.regexp_extract_all(text, regex, F.lit(part)).alias("part"),
                     F.split(text, regex, -1).alias("pieces"))

    def places(f: Column) -> Column:
        match = lambda start, k: F.struct(start.cast("bigint").alias("start"), (start + size(f["all"][k])).cast("bigint").alias("stop"),
                                          f["all"][k].alias("text"), f["part"][k].alias("part"))
        ordinal = F.sequence(F.lit(0), F.greatest(F.size(f["all"]) - 1, F.lit(0)))
        begun = states_before(ordinal, F.lit(0), lambda at, k: at + size(f["pieces"][k]) + size(f["all"][k]))
        return F.when(F.size(f["all"]) == 0, F.array().cast(SPAN)).otherwise(
            F.transform(begun, lambda at, k: match(at + size(f["pieces"][k]), k)))

    return F.transform(F.array(found), places)[0]
