"""Line dedup: repeated runs of lines are kept where they come first and deleted everywhere else.

The corpus is one sequence of lines, in order of doc_id, that no match may leave a document of. Its suffixes are grouped
by prefix doubling: groups of suffixes that agree on h lines are refined to 2h lines by the pair (group of i, group of
i + h). A group is an interval of the suffix array whose longest common prefix is at least that long; it is named by
its earliest suffix, which is the copy to keep, and a group of one leaves the computation. Every other suffix of a group
starts a repeat of 1, 2, 4, ... lines. Repeats of the lengths between h and 2h are the pairs (group of i, group of
i + n - h), whose lines overlap; they are named alike. A repeat counts if it holds ``MIN_WORDS`` words, so that short
lines alone are left in place, and the deleted lines are the union of the repeats. Lines without a word do not take
part: they neither separate runs nor are deleted. As every other line has a word, a group that deep holds enough words
however short its lines are, and longer runs are unions of those; doubling ends there.

Everything is DataFrame code. A group that holds a large share of all lines is counted with partial aggregation, and the
join that gives its name to its lines can be split by adaptive execution, because names are shuffled anew for it.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.numbering import number_rows
from ..session import shared_folder
from .keys import fingerprint
from .mixing import WORD
from .storage import written

MIN_WORDS = 8
# A position is the document's number above, the line's below. An array of lines takes over 32 bytes a line and at most
# 2 GB, so 26 bits number the lines of any document; the other 37 are for 137 billion documents, and more are an error.
_LINE_BITS = 26

KEPT, DELETED, WORDLESS = 0, 1, 2


def _keyed(docs: DataFrame) -> DataFrame:
    """The documents as one struct ``doc``, with two columns that identify doc_id and text."""
    one, two = fingerprint(F.col("doc_id"), F.col("text"))
    whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    return docs.select(one.alias("k1"), two.alias("k2"), whole.alias("doc"))


def _name(rows: DataFrame, keys: list[str], kept: tuple[str, ...] = ()) -> DataFrame:
    """Rows of groups with two or more members, with the group's name and the columns ``kept``. The join key is a struct, unlike the
    aggregation's, so that both sides are shuffled for the join and a large group can be split."""
    members = rows.groupBy(*keys).agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("members")).filter("members > 1")
    named = members.select(F.struct(*keys).alias("key"), F.col("first").alias("name"))
    return rows.select("pos", "upto", *kept, F.struct(*keys).alias("key")).join(named, "key").drop("key")


def _repeats(named: DataFrame, length: int | Column, min_words: int) -> DataFrame:
    """Where repeats of ``length`` lines with enough words start that have an earlier copy."""
    return named.filter((F.col("name") != F.col("pos")) & (F.element_at("upto", -1) >= min_words)).select("pos", F.lit(length).alias("n"))


def _between(active: DataFrame, length: int, min_words: int) -> DataFrame:
    """Repeats of n lines, for each n between ``length`` and twice as many, from the groups of ``length``. If the first and
    the last ``length`` lines both have enough words, they are repeats by themselves and cover all n, so such runs are left
    out; equal runs have equal words, so all copies of a run are either left out or not. All n are found in one pass: a
    branch of the plan for each would be planned, compiled and run by the driver side by side."""
    whole = Window.partitionBy(F.shiftright("pos", _LINE_BITS)).orderBy("pos")
    lengths = range(length + 1, 2 * length)
    ahead = [(n, whole.rangeBetween(n - length, n - length)) for n in lengths]
    seen = [column for n, at in ahead for column in (F.first("name").over(at).alias(f"next{n}"), F.first("upto").over(at).alias(f"later{n}"))]
    first = F.element_at("upto", -1)

    def run(n: int) -> Column:
        last = F.element_at(f"later{n}", -1)
        words = first + last - F.element_at(f"later{n}", 2 * length - n)
        some = F.col(f"next{n}").isNotNull() & (words >= min_words) & ((first < min_words) | (last < min_words))
        return F.when(some, F.struct(F.lit(n).alias("n"), F.col(f"next{n}").alias("next"), F.array(words).alias("upto")))

    runs = active.select("pos", "name", "upto", *seen).select("pos", "name", F.inline(F.array_compact(F.array(*map(run, lengths)))))
    return _repeats(_name(runs, ["n", "name", "next"], ("n",)), F.col("n"), min_words)


def line_flags(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """For each different (doc_id, text): k1, k2 and ``flags``, one of KEPT, DELETED, WORDLESS for each line."""
    keyed = _keyed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    entries = F.transform(
        F.split("doc.text", "\n"),
        lambda line, i: F.struct(i.alias("line"), *[h.alias(n) for h, n in zip(fingerprint(line), ("h1", "h2"))], F.regexp_count(line, F.lit(WORD)).alias("words")),
    )
    # Equal rows are one document: only one of them goes on, chosen before anything is shuffled by key.
    one = keyed.select("k1", "k2", F.col("doc.doc_id").alias("doc_id"), entries.alias("entries")).filter("entries IS NOT NULL")
    one = written(one.groupBy("k1", "k2", "doc_id").agg(F.first("entries").alias("entries")), "line-entries")
    folder = f"{shared_folder(docs.sparkSession)}/line-order-{uuid.uuid4().hex}"
    numbers = number_rows(one.select("doc_id", "k1", "k2"), ["doc_id", "k1", "k2"], "number", folder)
    fits = F.col("number") < 1 << (63 - _LINE_BITS)
    base = F.when(fits, F.shiftleft(F.col("number"), _LINE_BITS)).otherwise(F.raise_error(F.lit("too many documents to number their lines")).cast("long"))
    worded = one.join(numbers.drop("doc_id"), ["k1", "k2"]).select(base.alias("base"), F.posexplode(F.filter("entries", lambda e: e["words"] > 0)))
    lines = written(worded.select((F.col("base") + F.col("pos")).alias("pos"), "col.*"), "lines")

    active = _name(lines.withColumn("upto", F.array("words")), ["h1", "h2"])  # upto: words of the first line, two lines, ...
    repeats, length = [], 1
    while True:
        active = written(active, "line-groups")
        repeats.append(_repeats(active, length, min_words))
        if length >= min_words:
            break
        if length > 1:
            repeats.append(written(_between(active, length, min_words), "line-repeats"))
        ahead = Window.partitionBy(F.shiftright("pos", _LINE_BITS)).orderBy("pos").rangeBetween(length, length)
        pairs = active.select("pos", "name", F.first("name").over(ahead).alias("next"), "upto", F.first("upto").over(ahead).alias("later"))
        pairs = pairs.filter("next IS NOT NULL")
        more = F.transform("later", lambda words: words + F.element_at("upto", -1))
        active = _name(pairs.withColumn("upto", F.concat("upto", more)), ["name", "next"])
        length *= 2
    covered = reduce(DataFrame.unionAll, repeats).select(F.explode(F.sequence(F.col("pos"), F.col("pos") + F.col("n") - 1)).alias("pos"))
    deleted = covered.groupBy("pos").agg(F.lit(True).alias("deleted"))
    marked = lines.select("pos", "line").join(deleted, "pos", "left")
    number = F.shiftright("pos", _LINE_BITS)
    gone = marked.groupBy(number.alias("number")).agg(
        F.collect_list(F.when(F.col("deleted"), F.col("line"))).alias("gone"), F.collect_list(F.when(F.col("deleted").isNull(), F.col("line"))).alias("kept")
    )
    worded_lines = F.concat(
        F.transform("kept", lambda line: F.struct(line.alias("line"), F.lit(KEPT).cast("byte").alias("flag"))),
        F.transform("gone", lambda line: F.struct(line.alias("line"), F.lit(DELETED).cast("byte").alias("flag"))),
    )
    flagged = gone.join(numbers.select("number", "k1", "k2"), "number").select("k1", "k2", worded_lines.alias("marks"))
    wordless = F.transform(F.filter("entries", lambda e: e["words"] == 0), lambda e: F.struct(e["line"].alias("line"), F.lit(WORDLESS).cast("byte").alias("flag")))
    full = one.select("k1", "k2", wordless.alias("others")).join(flagged, ["k1", "k2"], "left")
    everything = F.array_sort(F.concat("others", F.coalesce("marks", F.array().cast("array<struct<line:int,flag:tinyint>>"))))
    return full.select("k1", "k2", F.transform(everything, lambda e: e["flag"]).alias("flags"))


def _flagged(docs: DataFrame, min_words: int) -> DataFrame:
    """Every row of ``docs`` as struct ``doc``, with ``flags`` and the kept lines."""
    flags = written(line_flags(docs, min_words), "line-flags")
    joined = _keyed(docs.withColumn("doc_id", F.col("doc_id").cast("long"))).join(flags, ["k1", "k2"], "left")
    kept = F.filter(F.split("doc.text", "\n"), lambda line, i: F.get("flags", i) != DELETED)
    return joined.withColumn("kept", F.array_join(kept, "\n"))


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without the repeated lines; a document whose lines with words were all repeats is left out.

    Rows with the same doc_id and text count as one document and get the same result; documents without doc_id come
    last in the order, and texts that share a doc_id are ordered by hash. Null and empty texts stay as they are.
    ``n_chars``, where there is such a column, follows the text.
    """
    rows = _flagged(docs, min_words)
    emptied = F.exists("flags", lambda f: f == DELETED) & ~F.exists("flags", lambda f: f == KEPT)
    left = rows.filter(~F.coalesce(emptied, F.lit(False)))
    own = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    changed = F.coalesce(F.exists("flags", lambda f: f == DELETED), F.lit(False))
    made = [F.when(changed, own[name]).otherwise(F.col(f"doc.`{name}`")) if name in own else F.col(f"doc.`{name}`") for name in docs.columns]
    return left.select(*[column.alias(name) for column, name in zip(made, docs.columns)])


def line_report(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_lines, n_removed, n_runs (maximal runs of deleted lines; wordless lines do not
    part them), kept_sha256 (lowercase hex of the kept lines joined by line feeds). A null text has no lines and the
    digest of an empty text."""
    step = F.aggregate(
        "flags",
        F.struct(F.lit(0).alias("runs"), F.lit(KEPT).cast("byte").alias("last")),
        lambda a, f: F.when(f == WORDLESS, a).otherwise(
            F.struct((a["runs"] + F.when((f == DELETED) & (a["last"] == KEPT), 1).otherwise(0)).alias("runs"), f.alias("last"))
        ),
        lambda a: a["runs"],
    )
    none = F.lit(0).cast("long")
    return _flagged(docs, min_words).select(
        F.col("doc.doc_id").alias("doc_id"),
        F.coalesce(F.size("flags").cast("long"), none).alias("n_lines"),
        F.coalesce(F.size(F.filter("flags", lambda f: f == DELETED)).cast("long"), none).alias("n_removed"),
        F.coalesce(step.cast("long"), none).alias("n_runs"),
        F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"),
    )
