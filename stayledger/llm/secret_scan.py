"""Secrets in texts, found through an inverted index of trigrams.

Every rule is a regular expression. From it a Boolean query over trigrams is derived (:mod:`.trigrams`). One pass over
the texts writes postings, a row for each trigram that the rules ask for and each text that holds it; intersecting them
by text, as bits under one aggregation, tells which texts can match which rule, however common a trigram is. Only those
are verified with the expression; a rule whose query requires nothing is run on all texts.

The position of a match follows from the lengths of the pieces before it, added up by a window within the document.
Everything is DataFrame code.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .keys import fingerprint
from .storage import written
from .trigrams import trigram_query, trigrams_in

_WORD_BITS = 62


@dataclass(frozen=True)
class Rule:
    """Leftmost matches of ``pattern`` that do not overlap, dropped if their ``group`` is shorter than ``at_least``."""

    kind: str
    pattern: str
    group: int = 0
    at_least: int = 0


# Whole runs of 24 and more are the runs of any length with the shorter ones dropped, but for the many short ones.
BASE = [
    Rule("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),
]
# Published token formats, key blocks, and logins inside addresses.
MORE = [
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("login", r"://[A-Za-z0-9_.~-]+:[A-Za-z0-9_.~!$&*+=%-]+@"),
]
RULES = BASE + MORE


def keyed(docs: DataFrame) -> DataFrame:
    """The rows as one struct ``doc``, with two columns that identify doc_id and text."""
    one, two = fingerprint(F.col("doc_id"), F.col("text"))
    whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    return docs.select(one.alias("k1"), two.alias("k2"), whole.alias("doc"))


def build_index(rows: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings (trigram, k1, k2) of the ``trigrams`` in the keyed rows' texts, lower-cased, sorted within files so that
    a reader of some trigrams can skip the others' row groups. The trigrams are those that rules ask for: postings of
    all trigrams would be several times the size of the texts, and no rule would read them."""
    wanted = F.array(*[F.lit(t) for t in trigrams])
    present = F.transform(F.array(F.lower("doc.text")), lambda low: F.filter(wanted, lambda t: F.contains(low, t)))
    postings = rows.select("k1", "k2", F.explode(F.element_at(present, 1)).alias("trigram"))
    return written(postings.select("trigram", "k1", "k2").sortWithinPartitions("trigram", "k1"), "trigram-postings")


def _met(query, holds: dict[str, Column]) -> Column:
    if isinstance(query, str):
        return holds[query]
    parts = [_met(part, holds) for part in sorted(query[1], key=str)]
    return reduce(Column.__and__ if query[0] == "and" else Column.__or__, parts)


def look_up(index: DataFrame, queries: dict[str, object]) -> DataFrame:
    """(k1, k2, kinds): the texts that fulfil one query or more, with the names of those. Postings are intersected by
    text, so a trigram that stands in most texts loads no single task."""
    trigrams = sorted(set().union(*map(trigrams_in, queries.values())))
    place = F.array_position(F.array(*[F.lit(t) for t in trigrams]), F.col("trigram")).cast("int") - 1
    words = range(-(-len(trigrams) // _WORD_BITS))
    placed = index.filter(F.col("trigram").isin(trigrams)).withColumn("place", place)
    bit = F.expr(f"shiftleft(1L, place % {_WORD_BITS})")
    masks = [F.bit_or(F.when(F.expr(f"place div {_WORD_BITS}") == w, bit).otherwise(F.lit(0).cast("long"))).alias(f"mask{w}") for w in words]
    texts = placed.groupBy("k1", "k2").agg(*masks)
    holds = {t: F.col(f"mask{i // _WORD_BITS}").bitwiseAND(F.lit(1 << i % _WORD_BITS).cast("long")) != 0 for i, t in enumerate(trigrams)}
    met = F.array(*[F.when(_met(query, holds), F.lit(kind)) for kind, query in queries.items()])
    return texts.select("k1", "k2", F.filter(met, lambda kind: kind.isNotNull()).alias("kinds")).filter("size(kinds) > 0")


def _hits(rule: Rule, order: int) -> Column:
    """An entry for each match of a rule in ``doc.text``: its number, the characters between it and the match before, its
    own, and whether it is dropped."""
    text, pattern = F.col("doc.text"), F.lit(rule.pattern)
    gaps, found = F.split(text, rule.pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    judged = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    lengths = F.arrays_zip(F.transform(gaps, F.length).alias("gap"), F.transform(found, F.length).alias("own"), F.transform(judged, F.length).alias("judged"))
    entry = lambda e, i: F.struct(F.lit(order).alias("rule"), i.alias("nth"), e["gap"].alias("gap"), e["own"].alias("own"), (e["judged"] >= rule.at_least).alias("kept"))
    return F.filter(F.transform(lengths, entry), lambda e: e["own"].isNotNull())  # the piece after the last match has none


def secret_spans(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """(k1, k2, spans) of the texts that hold a secret, named as in :func:`keyed`. ``spans`` is an array of (start, rule, end)
    in that order. Positions are code points, ``end`` is the first one behind, ``rule`` the place in ``rules``."""
    rows = keyed(docs.select("doc_id", "text"))
    queries = {str(i): trigram_query(rule.pattern) for i, rule in enumerate(rules)}
    asked = {kind: query for kind, query in queries.items() if query is not True}
    if asked:
        index = build_index(rows, sorted(set().union(*map(trigrams_in, asked.values()))))
        candidates = look_up(index, asked).select(F.struct("k1", "k2").alias("key"), "kinds")
        rows = rows.withColumn("key", F.struct("k1", "k2")).join(candidates, "key", "left").drop("key")
    else:
        rows = rows.withColumn("kinds", F.lit(None).cast("array<string>"))
    hits = []
    for i, rule in enumerate(rules):
        chosen = F.array_contains("kinds", str(i)) if str(i) in asked else F.lit(True)
        # A text without a match is told by one run of the expression, and makes no pieces.
        hits.append(F.when(chosen & F.col("doc.text").rlike(rule.pattern), _hits(rule, i)).otherwise(F.array()))
    found = written(rows.select("k1", "k2", F.concat(*hits).alias("hits")), "secret-hits")
    return _spans(found.filter("size(hits) > 0"))


def _spans(found: DataFrame) -> DataFrame:
    """(k1, k2, spans): the pieces of each different document's matches added up to positions."""
    each = found.groupBy("k1", "k2").agg(F.first("hits").alias("hits")).select("k1", "k2", F.inline("hits"))
    upto = F.sum(F.col("gap") + F.col("own")).over(Window.partitionBy("k1", "k2", "rule").orderBy("nth"))
    placed = each.withColumn("end", upto).filter("kept")
    span = F.struct((F.col("end") - F.col("own")).alias("start"), "rule", "end")
    return placed.groupBy("k1", "k2").agg(F.array_sort(F.collect_list(span)).alias("spans"))


def _with_spans(docs: DataFrame, rules: list[Rule], *columns: Column) -> DataFrame:
    spans = secret_spans(docs, rules).select(F.struct("k1", "k2").alias("key"), "spans")
    none = F.array().cast("array<struct<start:bigint,rule:int,end:bigint>>")
    rows = keyed(docs).select(F.struct("k1", "k2").alias("key"), *columns)
    return rows.join(spans, "key", "left").drop("key").withColumn("spans", F.coalesce("spans", none))


def find_secrets(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """Every row of ``docs`` (doc_id, text and any others) as struct ``doc``, with ``spans`` as in :func:`secret_spans`.

    A null or empty text has no spans; rows equal in doc_id and text share them; an empty table gives no rows. Only the
    letters A-Z are taken in either case where a rule does so.
    """
    return _with_spans(docs, rules, F.col("doc"))


def secret_report(docs: DataFrame, rules: list[Rule] = RULES, base: int = len(BASE)) -> DataFrame:
    """Per row of ``docs``: doc_id, n_<kind> for the first ``base`` rules, base_sha256 (lowercase hex over ``kind:start:end``
    of those, comma-joined) and spans, the same text over all rules."""
    found = _with_spans(docs.select("doc_id", "text"), rules, F.col("doc.doc_id").alias("doc_id"))
    kinds = F.array(*[F.lit(rule.kind) for rule in rules])
    named = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rule"]), s["start"], s["end"])), ",")
    first = F.filter("spans", lambda s: s["rule"] < base)
    count = lambda i: F.size(F.filter("spans", lambda s: s["rule"] == i)).cast("long")
    counts = [count(i).alias(f"n_{rule.kind}") for i, rule in enumerate(rules[:base])]
    return found.select("doc_id", *counts, F.sha2(named(first), 256).alias("base_sha256"), named(F.col("spans")).alias("spans"))
