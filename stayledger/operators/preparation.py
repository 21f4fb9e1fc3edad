"""Imputation, scaling and reproducible stratified splits."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from .quantiles import exact_quantiles, most_frequent

HEX_STEP = 3  # hash digits resolved per pass: 4096 bins per label
SMALL_BIN = 10_000


def _with_gaps(df: DataFrame, columns: list[str]) -> list[str]:
    """The columns that miss a value somewhere: only those need another one."""
    if not columns:
        return []
    gaps = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    return [c for c in columns if gaps[c]]


def impute_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace missing numbers by the exact median of their column.

    A column of whole numbers or booleans comes back as double, since its median may lie between two of them. A column
    without any number stays as it is.
    """
    as_double = df.withColumns({c: F.col(c).cast("double") for c in columns})
    medians = exact_quantiles(as_double, _with_gaps(df, columns), 0.5)
    return as_double.fillna({c: m for c, m in medians.items() if m is not None})


def impute_category(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace missing texts by the most frequent one of their column, the smallest on a tie."""
    gaps = _with_gaps(df, columns)
    modes = {row["column_name"]: row["value"] for row in most_frequent(df, gaps).collect()} if gaps else {}  # one row per column
    return df.fillna(modes)


def standardize(df: DataFrame, columns: list[str]) -> DataFrame:
    """Scale to mean 0 and population standard deviation 1; a constant column becomes 0."""
    fit = df.agg(*[f(c).alias(f"{t}_{c}") for c in columns for t, f in (("mean", F.avg), ("sd", F.stddev_pop))]).first()
    scaled = {}
    for c in columns:
        mean, sd = fit[f"mean_{c}"], fit[f"sd_{c}"]
        scaled[c] = (F.col(c) - F.lit(mean)) / F.lit(sd if sd else 1.0)
    return df.withColumns(scaled)


def row_hash(row_id: str, seed: int) -> Column:
    return F.md5(F.concat_ws("-", F.col(row_id).cast("string"), F.lit(str(seed))))


def _hash_borders(hashed: DataFrame, label: str, ranks: dict[tuple, int]) -> dict[tuple, str]:
    """The hash at a 1-based rank within each label, for keys (label value, part) -> rank.

    Counts per leading hash digits find the bin with the rank; the bin is resolved further until it is small. Hashes
    are uniform, so two passes settle billions of rows, and at most 10 000 hashes of one bin are sorted together.
    """
    borders: dict[tuple, str] = {}
    open_bins = {key: ("", rank) for key, rank in ranks.items()}
    digits = 0
    while open_bins:
        digits += HEX_STEP
        places = {(key[0], prefix) for key, (prefix, _) in open_bins.items()}
        inside = F.lit(False)
        for value, prefix in places:
            inside = inside | ((F.col(label) == value) & F.col("_hash").startswith(prefix))
        bins = (
            hashed.filter(inside)
            .groupBy(label, F.substring("_hash", 1, digits).alias("bin"))
            .agg(F.count(F.lit(1)).alias("rows"))
            .withColumn("parent", F.substring("bin", 1, digits - HEX_STEP))
        )
        order = Window.partitionBy(label, "parent").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        placed = bins.withColumn("upto", F.sum("rows").over(order))
        hits = F.lit(False)
        for (value, _), (prefix, rank) in open_bins.items():
            reached = (F.col("upto") >= rank) & (F.col("upto") - F.col("rows") < rank)
            hits = hits | ((F.col(label) == value) & (F.col("parent") == prefix) & reached)
        found = placed.filter(hits).collect()  # one row per open border
        following = {}
        small = []
        for key, (prefix, rank) in open_bins.items():
            row = next(r for r in found if r[label] == key[0] and r["parent"] == prefix and r["upto"] - r["rows"] < rank <= r["upto"])
            rest = rank - (row["upto"] - row["rows"])
            if row["rows"] <= SMALL_BIN:
                small.append((key, row["bin"], rest))
            else:
                following[key] = (row["bin"], rest)
        if small:
            chosen = [
                F.element_at(
                    F.array_sort(F.collect_list(F.when((F.col(label) == key[0]) & F.col("_hash").startswith(prefix), F.col("_hash")))),
                    rest,
                ).alias(f"b{i}")
                for i, (key, prefix, rest) in enumerate(small)
            ]
            row = hashed.agg(*chosen).first()
            borders |= {key: row[f"b{i}"] for i, (key, _, _) in enumerate(small)}
        open_bins = following
    return borders


def stratified_parts(
    df: DataFrame, label: str, shares: dict[str, float], row_id: str = "booking_id", seed: int = 42, name: str = "part"
) -> DataFrame:
    """Assign every row to a named part so that each label is divided in the given shares, to the nearest row.

    Rows are taken in the order of a hash of their id, so the assignment does not depend on partitioning and can be
    repeated anywhere. Exact borders come from counts per hash prefix instead of a window over all rows. A row without
    label belongs to no part, so it is an error.
    """
    hashed = df.select(row_id, label).withColumn("_hash", row_hash(row_id, seed))
    sizes = {r[label]: r["n"] for r in hashed.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per label
    if None in sizes:
        raise ValueError(f"{sizes[None]} rows have no {label}")
    steps = list(accumulate(shares.values()))[:-1]
    ranks = {}
    for value, n in sizes.items():
        for i, share in enumerate(steps):
            ranks[(value, i)] = int(n * share + 0.5)
    borders = _hash_borders(hashed, label, {k: r for k, r in ranks.items() if r > 0})
    names = list(shares)
    part = F.lit(None).cast("string")
    for value in sizes:
        inner = F.lit(names[-1])
        for i in reversed(range(len(steps))):
            border = borders.get((value, i))
            if border is not None:
                inner = F.when(F.col("_hash") <= border, names[i]).otherwise(inner)
        part = F.when(F.col(label) == value, inner).otherwise(part)
    return df.withColumn("_hash", row_hash(row_id, seed)).withColumn(name, part).drop("_hash")
