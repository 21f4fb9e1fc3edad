"""Pearson correlation of many columns, pairwise complete, in one pass over the data."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import DataFrame, functions as F

# Columns of the correlation matrices.
DASHBOARD_COLUMNS = [
    "is_canceled", "lead_time", "stays_in_weekend_nights", "stays_in_week_nights", "adults", "children",
    "is_repeated_guest", "previous_cancellations", "previous_bookings_not_canceled", "booking_changes", "adr",
    "required_car_parking_spaces", "total_of_special_requests", "days_in_waiting_list",
]
MODEL_COLUMNS = [
    "lead_time", "stays_in_weekend_nights", "stays_in_week_nights", "adults", "children", "adr", "total_stay_nights",
    "total_guests", "previous_cancellations", "previous_bookings_not_canceled", "booking_changes",
    "required_car_parking_spaces", "total_of_special_requests", "days_in_waiting_list",
]


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (col_a, col_b, r) for all ordered pairs, pairwise complete; r is null when a column is constant there.

    One pass adds up products of values taken from a fixed shift, the first row's, which keeps them accurate for large
    means. Sums are kept apart by which columns a row misses, so a pair is the sum over the patterns that have both;
    there are as many rows as patterns to finish, in columns.
    """
    data = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    shift = data.limit(1).select(F.struct(*[F.coalesce(c, F.lit(0.0)).alias(c) for c in columns])).scalar()
    shifted = data.withColumn("_shift", shift).select(*[(F.col(c) - F.col(f"_shift.{c}")).alias(c) for c in columns])
    pattern = "concat(" + ", ".join(f"if({c} IS NULL, '1', '0')" for c in columns) + ")"
    products = {f"_p{i}_{j}": f"sum({a} * {b})" for (i, a), (j, b) in combinations_with_replacement(enumerate(columns), 2)}
    # As text: a hundred small expressions reach the planner faster than built one call at a time.
    sums = [*[f"sum({c}) AS _s{i}" for i, c in enumerate(columns)], *[f"{v} AS {k}" for k, v in products.items()]]
    patterns = shifted.groupBy(F.expr(pattern).alias("_missing")).agg(F.count(F.lit(1)).alias("_n"), *map(F.expr, sums))
    pairs = [
        f"struct({i} AS i, {j} AS j, _s{i} AS sa, _s{j} AS sb, _p{i}_{i} AS saa, _p{j}_{j} AS sbb, _p{i}_{j} AS sab)"
        for i, j in combinations_with_replacement(range(len(columns)), 2)
    ]
    each = patterns.select("_missing", "_n", F.inline(F.expr(f"array({', '.join(pairs)})")))
    both = each.filter("substring(_missing, i + 1, 1) = '0' AND substring(_missing, j + 1, 1) = '0'")
    summed = both.groupBy("i", "j").agg(F.sum("_n").alias("n"), *[F.sum(c).alias(c) for c in ("sa", "sb", "saa", "sbb", "sab")])
    xx, yy, xy = (F.col(p) - F.col(x) * F.col(y) / F.col("n") for p, x, y in (("saa", "sa", "sa"), ("sbb", "sb", "sb"), ("sab", "sa", "sb")))
    # What rounding leaves of a constant column is no spread.
    varying = (xx > F.col("saa") * 1e-13) & (yy > F.col("sbb") * 1e-13)
    r = F.when(varying, F.when(F.col("i") == F.col("j"), 1.0).otherwise(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), xy / F.sqrt(xx * yy)))))
    found = summed.select("i", "j", F.round(r, 6).alias("r"))
    mirrored = found.select(F.inline(F.array(F.struct("i", "j", "r"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"), "r")))).distinct()
    names = F.array(*[F.lit(c) for c in columns])
    grid = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(len(columns)) for j in range(len(columns))])
    every = df.sparkSession.range(1).select(F.inline(grid))  # pairs that no row has both of
    return every.join(mirrored, ["i", "j"], "left").select(F.get(names, F.col("i")).alias("col_a"), F.get(names, F.col("j")).alias("col_b"), "r")
