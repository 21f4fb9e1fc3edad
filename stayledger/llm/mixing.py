"""Mix sources to target weights: whole epochs of a source first, then a weighted sample of the rest.

Efraimidis and Spirakis draw without replacement by giving each document the key -ln(u) / w, with u uniform and w the
document's quality, and taking the smallest keys. Here u comes from a hash of doc_id, so reruns agree. Within a source
the documents are sorted by key and their sizes summed up to the token budget; the document at the border gives only
the words still missing.

The sort is a range partitioning with sums inside partitions and offsets between them, so a source may hold any share
of all rows. The steps that run in one task work on a row per source, or per source and partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .storage import written

WORD = r"[^\x20\x09-\x0D]+"
USUAL_LETTERS_PER_WORD = 6.0


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality(chars: Column, size: Column) -> Column:
    """Weight from 0 to 1: how near the characters per word are to those of prose. Texts without words weigh 1."""
    return F.when(size > 0, 1.0 / (1.0 + F.abs(chars / size - USUAL_LETTERS_PER_WORD))).otherwise(1.0)


def source_targets(sizes: DataFrame, weights: tuple[int, ...], most_epochs: int) -> DataFrame:
    """Add ``target`` to one row per source (``source``, ``source_size``).

    Sources in code-point order, null last, take the weights in turn. Targets are min(cap, level * weight) for the one
    level at which they add up to all words, where a cap is ``most_epochs`` times the source's size: sharing the
    excess again and again ends there. In order of cap / weight, the level follows from running sums.
    """
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weighted = sizes.withColumn("_weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1).cast("double"))
    capped = weighted.withColumn("_cap", (F.col("source_size") * most_epochs).cast("double"))
    order = [F.col("_cap") / F.col("_weight"), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    heavier = F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0))
    level = capped.withColumn("_level", left / heavier)
    free = F.min(F.when(F.col("_level") * F.col("_weight") <= F.col("_cap"), F.col("_cap") / F.col("_weight"))).over(everything)
    final = F.min(F.when(F.col("_cap") / F.col("_weight") == free, F.col("_level"))).over(everything)
    target = F.least("_cap", F.coalesce(final * F.col("_weight"), F.col("_cap")))
    return level.select("source", "source_size", target.alias("target"))


def taken_words(rows: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most_epochs: int = 3) -> DataFrame:
    """Add ``source_size``, ``target`` and ``taken`` to rows with doc_id, source, size, _key and _tie.

    ``rows`` is read several times, so it should be a stored table. Documents of a source are ordered by _key, then
    doc_id (null last), then _tie; fully equal rows stand next to each other. A source without words takes none.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    shares = source_targets(sizes, weights, most_epochs)
    shares = shares.withColumn("_epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    shares = written(shares.withColumn("_budget", F.floor("target") - F.col("_epochs") * F.col("source_size")), "shares")
    order = ["source", "_key", "doc_id", "_tie"]
    ascending = [F.col(name).asc_nulls_last() for name in order]
    cut = written(rows.repartitionByRange(*ascending).withColumn("_part", F.spark_partition_id()), "mix-order")
    inside = Window.partitionBy("_part", "source").orderBy(*ascending[1:]).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    offsets = cut.groupBy("source", "_part").agg(F.sum("size").alias("_sum"))
    offsets = offsets.select(
        F.col("source").alias("_source"), F.col("_part").alias("_of"), F.coalesce(F.sum("_sum").over(before), zero).alias("_offset")
    )
    summed = cut.withColumn("_inside", F.coalesce(F.sum("size").over(inside), zero))
    placed = summed.join(offsets, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_part") == F.col("_of"))).drop("_source", "_of")
    joined = placed.join(shares.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    rest = F.least(F.col("size"), F.greatest(zero, F.col("_budget") - F.col("_offset") - F.col("_inside")))
    taken = (F.col("_epochs") * F.col("size") + rest).cast("long")
    return joined.withColumn("taken", taken).drop("_part", "_inside", "_offset", "_epochs", "_budget")


def _sizes(docs: DataFrame, seed: str, *more: Column) -> DataFrame:
    """doc_id, source, size, _key and _tie of every document, and ``more``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    hashed = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    uniform = (F.conv(F.substring(hashed, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", word_count(F.col("text")).alias("size"), F.length(text).alias("_chars"),
        uniform.alias("_u"), F.md5(text).alias("_tie"), *more,
    )
    weight = quality(F.col("_chars"), F.col("size"))
    return sized.withColumn("_key", -F.log("_u") / weight).drop("_chars", "_u")


def mix(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """What a mix of ``docs`` takes of each: doc_id, size, source_size, target, taken.

    One row per row of ``docs``, repeated rows included. A null text has no words; a null source is a source of its
    own. ``taken`` counts words: size times the complete epochs, and what the sample adds (all of it, none, or at one
    document per source a part). An empty table gives no rows.
    """
    return taken_words(written(_sizes(docs, seed), "mix-sizes")).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """The mixed corpus with the columns of ``docs``: a row for each time a document is taken.

    The document at a source's border appears once more with its first words only, as many as the budget leaves
    (``n_chars``, where there is such a column, is that of the cut text). Documents without words are never taken.
    """
    whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("doc")  # so that no column name can clash
    landed = written(docs.select(F.monotonically_increasing_id().alias("row"), whole), "mix-documents")
    taken = taken_words(written(_sizes(landed.select("row", "doc.doc_id", "doc.source", "doc.text"), seed, F.col("row")), "mix-sizes"))
    takes = taken.filter(F.col("taken") > 0).select("row", "size", "taken")
    joined = landed.join(takes, "row").withColumn("copies", F.floor((F.col("taken") + F.col("size") - 1) / F.col("size")))
    copies = joined.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    words = (F.col("taken") - (F.col("copy") - 1) * F.col("size")).cast("int")
    with_space = F.regexp_extract_all("doc.text", F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    is_whole = words >= F.col("size")
    text = F.when(is_whole, F.col("doc.text")).otherwise(F.array_join(F.slice(with_space, F.lit(1), words), ""))
    made = copies.withColumn("text", text)
    chars = F.when(is_whole, F.col("doc.n_chars")).otherwise(F.length("text")) if "n_chars" in docs.columns else None
    own = {"text": F.col("text"), "n_chars": chars}
    return made.select(*[(own[name] if name in own else F.col(f"doc.`{name}`")).alias(name) for name in docs.columns])
