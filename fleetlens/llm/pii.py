"""Personal data: exact patterns as seeds, and contexts bootstrapped from them for unseen identifiers.

Emails, IP addresses, card and phone numbers that match their rules are the base spans and the seeds. The two words
before an identifier are its lexical pattern. Patterns and instances form a graph: a pattern is as
sure as the share of known instances among the distinct ones it precedes, an instance as sure as its patterns
together (noisy or). A few rounds over the whole corpus let sure patterns discover identifiers that no rule
matches, and those strengthen further patterns. Everything is DataFrame expressions, joins and
aggregations.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import row_key, stored

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "A-Za-z0-9._%+-"
# The base rules, with possessive repeats and a look behind where a match can't start within a run
# anyway; both only keep long runs from being scanned again and again.
RULES = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for a rule to match.
_NEEDS = {
    "email": lambda text: F.contains(text, F.lit("@")),
    "ip": lambda text: text.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
    "card": lambda text: text.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"),
    "phone": lambda text: F.contains(text, F.lit("+")),
}
# Addresses that the rule misses: name@host, name (at) host, name at host dot net.
_DOT = r"(?:\x20?[\[({<]\x20?(?:dot|DOT)\x20?[\])}>]\x20?|\x20(?:dot|DOT)\x20|\.)[A-Za-z][A-Za-z0-9-]++"
_AT = r"(?:@|\x20?[\[({<]\x20?(?:at|AT)\x20?[\])}>]\x20?)"
_ADDRESS = rf"[A-Za-z0-9][{_LOCAL}]*+(?:{_AT}[A-Za-z0-9-]++(?:{_DOT})*+|\x20(?:at|AT)\x20[A-Za-z0-9-]++(?:{_DOT})++)"
# Adjacent groups of digits, as many as a card number may have; else a token with a digit.
_GROUP = r"[0-9](?:[()./-]*+[0-9])*+\)?+(?![^\s\p{Punct}\p{IsPunctuation}])"
_GROUPS = rf"{_GROUP}(?:[\x20\u00a0\u202f]\(?+{_GROUP}){{1,18}}"
_LEAD = r"[^\s\p{L}\p{N}]*+"
_CANDIDATE = rf"(?<!\S)(?:{_LEAD}(?:{_ADDRESS}|{_GROUPS})|[^\s0-9]*+[0-9]\S*+)"
# What a text must hold for a candidate: three digits in one token or adjacent ones, or an address.
_NEAR_DIGITS = r"[0-9][^\s0-9]*+(?:[\x20\u00a0\u202f][^\s0-9]*+)?+[0-9][^\s0-9]*+(?:[\x20\u00a0\u202f][^\s0-9]*+)?+[0-9]"
_NEAR_ADDRESS = rf"{_AT}|\x20(?:at|AT)\x20[A-Za-z0-9-]++{_DOT}"
_PUNCT = r"[\p{Punct}\p{IsPunctuation}]"
_SPANS = "array<struct<start:int,end:int,value:string>>"
# An unseen identifier has so many characters and digits at least.
LEAST_CHARS, LEAST_DIGITS = 5, 3
# A pattern counts with so many distinct known instances and that share; an instance from that score on.
LEAST_KNOWN, LEAST_CONFIDENCE, LEAST_SCORE = 3, 0.5, 0.8
ROUNDS = 3


def _matches(text: Column, rule: str) -> Column:
    """All leftmost matches that don't overlap, with bounds in code points, end exclusive."""
    found = F.regexp_extract_all(text, F.lit(rule), F.lit(0))
    gaps = F.slice(F.split(text, rule, -1), F.lit(1), F.size(found))
    both = F.zip_with(found, gaps, lambda v, g: F.struct(v.alias("v"), F.length(g).alias("g")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + x["g"]
        end = begin + F.length(x["v"])
        span = F.struct(begin.alias("start"), end.alias("end"), x["v"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    return F.aggregate(both, start, step, lambda state: state["spans"])


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        digit = F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(i % 2 == 1, digit).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _small_part(part: Column) -> Column:
    own = F.ltrim(part, F.lit("0"))
    return (F.length(own) < 3) | ((F.length(own) == 3) & (own.cast("int") <= 255))


_HOLDS = {
    "email": None,
    "ip": lambda v: F.forall(F.split(v, r"\."), _small_part),
    "card": lambda v: F.length(F.regexp_replace(v, "[^0-9]", "")).between(13, 19)
    & F.when(
        F.length(F.regexp_replace(v, "[^0-9]", "")).between(13, 19),
        _luhn(F.regexp_replace(v, "[^0-9]", "")),
    ).otherwise(False),
    "phone": lambda v: F.length(F.regexp_replace(v, "[^0-9]", "")).between(9, 15),
}


def base_spans(text: Column, kind: str) -> Column:
    """The base spans of a kind; null texts have none."""
    text = F.coalesce(text, F.lit(""))
    found = _matches(text, RULES[kind])
    if _HOLDS[kind] is not None:
        found = F.filter(found, lambda s: _HOLDS[kind](s["value"]))
    return F.when(_NEEDS[kind](text), found).otherwise(F.array().cast(_SPANS))


def named(spans: Column, kind: str) -> Column:
    """Spans of one kind as (kind, start, end)."""
    return F.transform(
        spans, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    )


def _before(text: Column, start: Column) -> Column:
    """The two words before a place and the punctuation right before it, lower-cased; null if there aren't
    two within 64 characters."""
    left = F.substring(text, F.greatest(start - 63, F.lit(1)), F.least(start, F.lit(64)))
    words = F.regexp_extract(left, rf"(?:^|\s)(\S+\s+\S+\s+){_PUNCT}*\z", 1)
    return F.nullif(F.regexp_replace(F.lower(F.trim(words)), r"\s+", " "), F.lit(""))


def _mentions(text: Column, base: dict[str, Column]) -> Column:
    """Seeds and candidates outside of them with their patterns."""
    text = F.coalesce(text, F.lit(""))

    def row(s: Column, kind: Column) -> Column:
        return F.struct(
            kind.alias("kind"),
            s["start"].alias("start"),
            s["end"].alias("end"),
            s["value"].alias("instance"),
            _before(text, s["start"]).alias("pattern"),
        )

    def trimmed(s: Column) -> Column:
        lead = F.length(F.regexp_extract(s["value"], rf"^{_PUNCT}*", 0))
        core = F.regexp_replace(s["value"], rf"^{_PUNCT}++|{_PUNCT}++$", "")
        begin = s["start"] + lead
        return F.struct(begin.alias("start"), (begin + F.length(core)).alias("end"), core.alias("value"))

    def likely(s: Column) -> Column:
        digits = F.length(F.regexp_replace(s["value"], "[^0-9]", ""))
        long = (F.length(s["value"]) >= LEAST_CHARS) & (digits >= LEAST_DIGITS)
        return long | s["value"].rlike(rf"^{_ADDRESS}")

    def clear(s: Column) -> Column:
        overlaps = lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])
        return ~functools.reduce(operator.or_, (F.exists(spans, overlaps) for spans in base.values()))

    # Only addresses and what has enough digits take part; the first check is cheap and drops most texts.
    tokens = F.when(
        text.rlike(_NEAR_DIGITS) | text.rlike(_NEAR_ADDRESS), _matches(text, _CANDIDATE)
    ).otherwise(F.array().cast(_SPANS))
    tokens = F.filter(F.transform(tokens, trimmed), lambda s: likely(s) & clear(s))

    def seeds(kind: str) -> Column:
        return F.transform(base[kind], lambda s: row(s, F.lit(kind)))

    unknown = F.lit(None).cast("string")
    every = F.concat(*map(seeds, KINDS), F.transform(tokens, lambda s: row(s, unknown)))
    return F.filter(every, lambda m: m["pattern"].isNotNull())


def annotate(documents: DataFrame, text: str = "text", key: str = "doc_id", keep: tuple[str, ...] | None = None) -> DataFrame:
    """The kept columns (default: all) plus ``_pii_spans``: all spans (kind, start, end), base ones
    first by kind then start, discovered ones last. ``_pii_base`` has the base spans alone.

    Rows are told apart by key and text, so repeated rows, and null keys, are handled each for itself;
    null and empty texts have no spans.
    """
    keep = tuple(documents.columns) if keep is None else keep
    value = F.col(text)
    found = documents.select(
        *keep,
        row_key(F.col(key), value).alias("_pii_key"),
        value.alias("_pii_text"),
        *(base_spans(value, k).alias(f"_pii_{k}") for k in KINDS),
    )
    base = {k: F.col(f"_pii_{k}") for k in KINDS}
    spans = F.concat(*(named(base[k], k) for k in KINDS))
    rows = found.select(
        *keep, "_pii_key", spans.alias("_pii_base"), _mentions(F.col("_pii_text"), base).alias("_pii_mentions")
    )
    rows = stored(rows, "annotated")
    more = discover(rows.select(F.col("_pii_key").alias("row"), F.explode("_pii_mentions").alias("m")).select("row", "m.*"))
    more = more.groupBy("row").agg(F.sort_array(F.collect_set(F.struct("kind", "start", "end"))).alias("_pii_more"))
    joined = rows.drop("_pii_mentions").join(more.withColumnRenamed("row", "_pii_key"), "_pii_key", "left")
    clear = F.filter(
        "_pii_more",
        lambda m: ~F.exists("_pii_base", lambda s: (s["start"] < m["end"]) & (m["start"] < s["end"])),
    )
    both = F.concat("_pii_base", clear)
    every = F.when(F.col("_pii_more").isNull(), F.col("_pii_base")).otherwise(both)
    return joined.select(*keep, "_pii_base", every.alias("_pii_spans"))


def discover(mentions: DataFrame) -> DataFrame:
    """Spans (row, kind, start, end) of unseen identifiers that sure patterns precede.

    ``mentions`` has row, kind (null for candidates), start, end, instance and pattern. Two kinds that tie for an
    instance are decided by name.
    """
    edges = mentions.groupBy("pattern", "instance").agg(F.max("kind").alias("kind"))
    # Patterns that precede one instance alone, the bulk of them, can neither learn nor teach.
    total = edges.groupBy("pattern").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_KNOWN)
    total = stored(total, "patterns")
    edges = stored(edges.join(total, "pattern"), "edges")
    seeds = edges.where("kind is not null").groupBy("instance").agg(F.max("kind").alias("kind"))
    seeds = seeds.withColumn("score", F.lit(1.0))
    known = seeds
    sure = None
    for _ in range(ROUNDS):
        good = edges.drop("kind").join(known, "instance").groupBy("pattern", "n", "kind")
        good = good.agg(F.sum("score").alias("good"), F.count("*").alias("known"))
        share = F.col("good") / (F.col("n") + 1)
        sure = good.select("pattern", "kind", "known", share.alias("confidence"))
        sure = sure.where((F.col("known") >= LEAST_KNOWN) & (share >= LEAST_CONFIDENCE))
        sure = stored(sure.select("pattern", "kind", "confidence"), "sure")
        doubt = F.exp(F.sum(F.log(1 - F.col("confidence"))))
        fresh = edges.select("pattern", "instance").join(seeds.select("instance"), "instance", "left_anti")
        fresh = fresh.join(sure, "pattern").groupBy("instance", "kind").agg((1 - doubt).alias("score"))
        fresh = fresh.where(F.col("score") >= LEAST_SCORE).groupBy("instance")
        fresh = fresh.agg(F.max(F.struct("score", "kind")).alias("best")).select("instance", "best.kind", "best.score")
        fresh = stored(fresh, "fresh")
        known = seeds.unionByName(fresh)
    found = mentions.where("kind is null").drop("kind").join(fresh.select("instance", "kind"), "instance")
    return found.join(sure.select("pattern", "kind"), ["pattern", "kind"], "left_semi").select(
        "row", "kind", "start", "end"
    )


def joined(spans: Column | str) -> Column:
    """Spans as kind:start:end, by kind as listed, then start, joined by commas."""

    def written(kind: str) -> Column:
        own = F.transform(
            F.filter(spans, lambda s: s["kind"] == kind), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))
        )
        bounds = lambda s: (F.lit(kind), s["start"].cast("string"), s["end"].cast("string"))
        return F.transform(F.sort_array(own), lambda s: F.concat_ws(":", *bounds(s)))

    return F.array_join(F.concat(*(written(k) for k in KINDS)), ",")


def redact(documents: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The documents with every span replaced by its kind in brackets; spans that overlap become one."""
    found = annotate(documents, text, key)
    order = F.sort_array(
        F.transform("_pii_spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(state: Column, s: Column) -> Column:
        gap = F.substring(F.col(text), state["at"] + 1, s["start"] - state["at"])
        mark = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        parts = F.when(s["start"] < state["at"], state["parts"]).otherwise(
            F.concat(state["parts"], F.array(gap, mark))
        )
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), parts.alias("parts"))

    def finish(state: Column) -> Column:
        rest = F.substring(F.col(text), state["at"] + 1, F.length(F.col(text)))
        return F.concat(F.array_join(state["parts"], ""), rest)

    clean = F.when(F.size("_pii_spans") == 0, F.col(text)).otherwise(F.aggregate(order, begin, step, finish))
    columns = [clean.alias(text) if c == text else F.col(c) for c in documents.columns]
    return found.select(*columns)
