"""The star schema on disk, and column-driven joins over it."""

from __future__ import annotations

import hashlib
import json
import threading
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.dimensions import DIMENSIONS
from ..operators.facts import DERIVED, KEY_COLUMNS, MEASURES, YEAR_PARTITION
from ..operators.filters import apply_filters
from ..operators.numbering import dense_number
from ..session import sent_if_small
from . import shared_files

FACT_COLUMNS = ["booking_id", *KEY_COLUMNS, *MEASURES, *DERIVED]
ATTRIBUTES = {
    "date_dim": ["year", "month", "week_number", "day_of_month", "full_date", "is_weekend", "season"],
    "hotel_dim": ["hotel_name", "meal_plan", "market_segment", "distribution_channel"],
    "customer_dim": ["country", "customer_type", "deposit_type"],
    "room_dim": ["reserved_room_type", "assigned_room_type", "room_changed"],
    "agent_dim": ["agent_id", "company_id"],
}

# A Bloom filter as large as a row group's booking numbers need. They are all different: a dictionary would be no use.
BOOKING_LOOKUP = {
    "parquet.bloom.filter.enabled#booking_id": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
    "parquet.enable.dictionary#booking_id": "false",
}


class Warehouse:
    """Five dimensions and one fact table as parquet under one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._tables: dict[str, DataFrame] = {}
        self._lock = threading.RLock()

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def write(self, name: str, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(self.path(name))
        self._tables.pop(name, None)

    def write_fact(self, facts: DataFrame) -> None:
        """Store the fact by arrival year.

        Each task writes its own rows year by year, so nothing is shuffled; ``facts`` comes in tasks small enough to sort.
        Sorting by cancellation and lead time makes row-group statistics useful
        for filters on them. Booking numbers lie scattered in that order, so each row group has a Bloom filter of them
        and a look-up reads the one that holds the number.
        """
        (
            facts.sortWithinPartitions(YEAR_PARTITION, "is_canceled", "lead_time")
            .write.mode("overwrite")
            .options(**BOOKING_LOOKUP)
            .partitionBy(YEAR_PARTITION)
            .parquet(self.path("booking_fact"))
        )
        self._tables.pop("booking_fact", None)

    def table(self, name: str) -> DataFrame:
        """A stored table. Files are listed and footers read once per warehouse, not once per query."""
        with self._lock:
            if name not in self._tables:
                df = self.spark.read.parquet(self.path(name))
                if name in DIMENSIONS:
                    df = df.select(DIMENSIONS[name][0], *ATTRIBUTES[name])
                elif name == "booking_fact":
                    df = df.select(*FACT_COLUMNS, F.col(YEAR_PARTITION).cast("bigint").alias(YEAR_PARTITION))
                self._tables[name] = df
            return self._tables[name]

    def derived(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A table computed from the warehouse, written on first use: several passes over it then read columns of
        files instead of repeating its joins, and a lost executor costs no recomputation.

        It belongs to this version of the warehouse and is shared by all applications that open it: a finished table is
        moved into place by one rename, and whoever comes second uses that one.
        """
        table = f"_derived/{name}"
        with self._lock:
            if table not in self._tables and not shared_files.exists(self.spark, self.path(f"{table}/_SUCCESS")):
                own = f"_derived/.{name}-{uuid.uuid4().hex}"
                build().write.parquet(self.path(own))
                shared_files.moved_if_new(self.spark, self.path(own), self.path(table))
            return self.table(table)

    def result(self, name: str, build: Callable[[], DataFrame], **options) -> DataFrame:
        """A query's result for these filter ``options``, computed once per version of the warehouse and kept beside it.
        A later call, also of another application, reads the result and no fact; a new version starts without any."""
        given = json.dumps({k: options[k] for k in sorted(options) if options[k] is not None}, default=str)
        return self.derived(f"{name}-{hashlib.md5(given.encode()).hexdigest()}", build)

    def raw_bookings(self) -> DataFrame:
        """The landed raw rows with their booking number."""
        return dense_number(self.table("raw_bookings"), self.table("raw_offsets"), "_sequence", "booking_id")

    def register_views(self, prefix: str = "") -> None:
        """Make the tables available to ``spark.sql``."""
        for name in [*DIMENSIONS, "booking_fact"]:
            self.table(name).createOrReplaceTempView(prefix + name)

    def sql(self, query: str) -> DataFrame:
        """Run SQL text in which a table is written as ``{booking_fact}``, ``{date_dim}`` and so on."""
        return self.spark.sql(query, **{name: self.table(name) for name in [*DIMENSIONS, "booking_fact"] if f"{{{name}}}" in query})

    @contextmanager
    def cached_star(self, *columns: str, **filter_options):
        """Keep a filtered star in executor memory (spilling to disk) while several figures are computed from it."""
        kept = apply_filters(self.star(*columns), **filter_options).persist()
        try:
            yield kept
        finally:
            kept.unpersist()

    def star(self, *columns: str, first: int | None = None) -> DataFrame:
        """Fact columns and dimension attributes by name.

        Only dimensions that own a requested column are joined, by key alone. Every booking has a member in every
        dimension, so leaving a dimension out keeps the rows the same. ``year`` is the fact's partition column, which
        equals the date member's year: it needs no join, and a filter on it prunes partitions. With ``first``, only that
        many bookings, in order of their number, are looked up.
        """
        wanted = list(columns)
        owners = [name for name, owned in ATTRIBUTES.items() if (set(owned) - {"year"}) & set(wanted)]
        keys = [DIMENSIONS[name][0] for name in owners]
        unknown = set(wanted) - set(FACT_COLUMNS) - {c for owned in ATTRIBUTES.values() for c in owned}
        if unknown:
            raise ValueError(f"unknown columns: {sorted(unknown)}")
        fact_columns = [c for c in FACT_COLUMNS if c in wanted or c in keys]
        facts = self.table("booking_fact")
        if first is not None:
            facts = facts.orderBy("booking_id").limit(first)
        rows = facts.select(*fact_columns, F.col(YEAR_PARTITION).alias("year"))
        for name, key in zip(owners, keys):
            attributes = [c for c in ATTRIBUTES[name] if c in wanted and c != "year"]
            rows = rows.join(sent_if_small(self.table(name)).select(key, *attributes), key)
        return rows.select(*wanted)

    def row_counts(self) -> DataFrame:
        """Rows per table."""
        counts = [
            self.table(name).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
            for name in [*DIMENSIONS, "booking_fact"]
        ]
        return reduce(DataFrame.unionByName, counts)
