"""Secret scans with an inverted index of the trigrams that the rules demand."""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as C
from re import _parser as P

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.vectors import FOLD, states_before
from pulsegrid.llm.common import packed, row_key, staged, text_of
from pulsegrid.llm.spans import match_spans


@dataclass(frozen=True)
class Rule:
    kind: str
    regex: str
    group: int = 0
    least: int = 1  # characters that the group must have
    base: bool = False


# Fixed values. Kinds in the order in which spans with the same start are listed.
RULES = [
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16, True),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32, True),  # maximal runs, as with + and a check of their length
    Rule("private-key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("hub-token", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("lab-token", r"glpat-[A-Za-z0-9_-]{20}"),
    Rule("chat-token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("pay-key", r"[sr]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("maps-key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("mail-key", r"SG\.[A-Za-z0-9_-]{22}\.[A-Za-z0-9_-]{43}"),
    Rule("package-token", r"npm_[A-Za-z0-9]{36}"),
    Rule("bearer", r"(?i:bearer)\x20+[A-Za-z0-9+/_.=-]{20,}"),
    Rule("login-url", r"[a-z][a-z0-9+]{1,12}://[A-Za-z0-9._-]{1,64}:[^\s:/@]{4,64}@[A-Za-z0-9.-]{3,}"),
]

SPAN = "array<struct<start:bigint,rank:int,stop:bigint,kind:string>>"


def trigram_query(regex: str, most: int = 64) -> set[frozenset[str]]:
    """Alternatives of trigrams (lower case): a text that matches has all trigrams of one alternative.

    An alternative without trigrams means that the regex demands none. Literal runs are followed through groups,
    choices and small classes while they make at most ``most`` strings; anything else ends a run.
    """
    trigrams = lambda s: frozenset(s[i:i + 3] for i in range(len(s) - 2))

    def both(a, b):
        out = {x | y for x in a for y in b}
        return out if len(out) <= most else {frozenset.intersection(*out)}  # weaker, still demanded

    def one(op, arg):
        """The strings a part may be (None: not a small set), and what it demands otherwise."""
        if op is C.LITERAL:
            return {chr(arg).lower()}, None
        if op is C.IN and all(o is C.LITERAL for o, _ in arg) and len(arg) <= 8:
            return {chr(x).lower() for _, x in arg}, None
        if op is C.SUBPATTERN:
            return run(arg[-1])
        if op is C.BRANCH:
            parts = [run(x) for x in arg[1]]
            if all(s is not None for s, _ in parts):
                return set().union(*[s for s, _ in parts]), None
            return None, set().union(*[{trigrams(x) for x in s} if s is not None else q for s, q in parts])
        if op in (C.MAX_REPEAT, C.MIN_REPEAT):
            low, high, inner = arg
            s, q = run(inner)
            if s is not None and high <= 2:
                sets, power = set(), {""}
                for n in range(int(high) + 1):
                    sets |= power if n >= low else set()
                    power = {a + b for a in power for b in s}
                return sets, None
            return None, ({frozenset()} if low == 0 else {trigrams(x) for x in s} if s is not None else q)
        return None, {frozenset()}

    def run(items):
        demanded, now, whole = {frozenset()}, {""}, True
        for op, arg in items:
            s, q = one(op, arg)
            if s is not None and len(now) * len(s) <= most:
                now = {a + b for a in now for b in s}
                continue
            demanded = both(demanded, {trigrams(x) for x in now})
            now, whole = (s, False) if s is not None else ({""}, False)
            if q is not None:
                demanded = both(demanded, q)
        return (now, None) if whole else (None, both(demanded, {trigrams(x) for x in now}))

    s, q = run(P.parse(regex))
    alternatives = {trigrams(x) for x in s} if s is not None else q
    return {a for a in alternatives if not any(b < a for b in alternatives)}


def query_terms(rules=RULES) -> tuple[list[tuple[str, int, int, str]], list[str]]:
    """(kind, alternative, its number of trigrams, trigram) of the rules that demand trigrams; kinds of the others."""
    terms, full = [], []
    for r in rules:
        q = trigram_query(r.regex)
        if frozenset() in q:
            full.append(r.kind)
        else:
            terms += [(r.kind, i, len(a), t) for i, a in enumerate(sorted(q, key=sorted)) for t in sorted(a)]
    return terms, full


def postings(docs: DataFrame, text: str, identifier: str, rules=RULES) -> DataFrame:
    """The index (trigram, id, h): which documents have which of the trigrams that the rules demand; NULL text has none."""
    wanted = F.array(*[F.lit(t) for t in sorted({t for *_, t in query_terms(rules)[0]})])
    t = docs.select(docs[identifier].alias("id"), text_of(docs, text).alias("t"))
    t = t.select("id", F.xxhash64("t").alias("h"), F.lower("t").alias("low"))
    return t.select("id", "h", F.explode(F.filter(wanted, lambda g: F.contains(F.col("low"), g))).alias("trigram"))


def candidates(index: DataFrame, rules=RULES) -> DataFrame:
    """(id, h, kinds): rules whose Boolean query a document fulfils, by meeting the postings of each alternative."""
    terms = index.sparkSession.createDataFrame(query_terms(rules)[0], "kind string, alternative int, n long, trigram string")
    met = (index.distinct().join(F.broadcast(terms), "trigram")  # the terms are fixed by the rules, not by the data
           .groupBy("id", "h", "kind", "alternative").agg(F.count("*").alias("have"), F.max("n").alias("n"))
           .where("have = n"))
    return met.groupBy("id", "h").agg(F.collect_set("kind").alias("kinds"))


def _rule_spans(t: Column, rule: Rule, rank: int) -> Column:
    kept = F.filter(match_spans(t, F.lit(rule.regex), rule.group), lambda m: F.length(m["part"]) >= rule.least)
    return F.transform(kept, lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), m["stop"].alias("stop"),
                                                F.lit(rule.kind).alias("kind")))


def secret_scan(docs: DataFrame, text: str = "text", identifier: str = "doc_id", rules=RULES, columns=None) -> DataFrame:
    """``row`` (all columns or ``columns``), ``t`` (the text) and ``spans`` sorted by start, then rule.

    The index is written first; candidates from it meet the documents in one shuffle, and only they are verified by
    the rule's regex. Rules that demand no trigrams read all texts. Places are code points, stops exclusive. NULL and
    empty texts have no spans; rows that repeat id and text share one posting and get equal results; ids may be NULL.
    """
    full = query_terms(rules)[1]
    index = staged(postings(docs, text, identifier, rules))
    found = candidates(index, rules)
    docs = docs.select(*dict.fromkeys([*(columns or docs.columns), text, identifier]))
    t = packed(docs, t=text_of(docs, text))
    t = t.select(F.struct(*[F.col("row")[c].alias(c) for c in (columns or docs.columns)]).alias("row"), "t",
                 row_key(F.col("row")[identifier], F.col("t")).alias("key"))
    joined = t.join(found, t.key.id.eqNullSafe(found.id) & (t.key.h == found.h), "left")
    none = F.array().cast(SPAN)
    each = []
    for rank, rule in enumerate(rules):
        gate = F.rlike("t", F.lit(rule.regex)) if rule.kind in full else F.array_contains("kinds", rule.kind)
        each.append(F.when(gate, _rule_spans(F.col("t"), rule, rank)).otherwise(none))
    return joined.select("row", "t", F.sort_array(F.flatten(F.array(*each))).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def redact(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents with each run of overlapping secrets replaced by one ``[secret]``; other columns as they are.

    Texts without secrets, NULL among them, stay as they were.
    """
    scan = secret_scan(docs, text=text, **options)
    spans = F.col("spans")
    reach = states_before(spans, F.lit(0), lambda r, s: F.greatest(r, s["stop"]))
    scan = scan.select("*", F.array_max(F.transform(spans, lambda s: s["stop"])).alias("end"), F.transform(F.array(reach), lambda before: F.filter(
        F.transform(spans, lambda s, i: F.struct(before[i].alias("at"), s["start"].alias("start"))), lambda s: s["start"] >= s["at"]))[0].alias("runs"))

    def cut(chunk: Column, at: Column, stop: Column) -> Column:
        return F.substring(chunk, (at + 1).cast("int"), (stop - at).cast("int"))

    def kept(runs: Column) -> Column:
        """The text before each run, read from one part of the text for every block of runs."""
        first, last = runs[0]["at"], F.element_at(runs, -1)["start"]
        return F.transform(F.array(cut(F.col("t"), first, last)), lambda chunk: F.transform(
            runs, lambda s: cut(chunk, s["at"] - first, s["start"] - first)))[0]

    blocks = F.sequence(F.lit(0), F.greatest(F.floor((F.size("runs") - 1) / FOLD).cast("int"), F.lit(0)))
    before = F.flatten(F.transform(blocks, lambda b: F.transform(F.array(F.slice("runs", b * FOLD + 1, F.lit(FOLD))), kept)[0]))
    clean = F.array_join(F.concat(before, F.array(F.substring(F.col("t"), (F.col("end") + 1).cast("int"), F.lit(2**31 - 1)))), "[secret]")
    new = F.when(F.size(spans) > 0, clean).otherwise(F.col("row")[text])
    return scan.select(*[(new if c == text else F.col("row")[c]).alias(c) for c in docs.columns])
