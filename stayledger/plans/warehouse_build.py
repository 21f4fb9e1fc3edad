"""Build the warehouse once and reuse it for every query, until its sources change."""

from __future__ import annotations

import functools
import hashlib
import importlib
import inspect
import json
import pkgutil
import threading
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from ..operators.dimensions import DIMENSIONS
from ..operators.facts import booking_facts
from ..operators.numbering import number_rows, sequence_offsets, with_sequence
from ..session import SPLIT_BYTES, shared_folder, shuffle_width, shuffles_sized_for, splits_of
from ..sources import shared_files
from ..sources.csv_bookings import read_booking_csv, write_booking_csv
from ..sources.order_tables import bookings_from_orders, table
from ..sources.warehouse_store import Warehouse

SOURCE_TABLES = ("lineitem", "orders", "customer", "nation", "region", "part")
KEEP_SECONDS = 24 * 3600

_lock = threading.RLock()
_built: dict[tuple[str, ...], object] = {}


def build_warehouse(spark: SparkSession, sequenced: DataFrame, folder: str) -> Warehouse:
    """Land raw bookings, then write the dimensions and the fact.

    ``sequenced`` holds the 32 raw columns and ``_sequence`` (see :func:`with_sequence`). It is computed once, when
    the raw rows are landed; everything after reads columns of the landed files. A failure is raised, not reported
    as a flag.
    """
    house = Warehouse(spark, folder)
    house.write("raw_bookings", sequenced)
    landed = house.table("raw_bookings")

    def write_dimension(name: str) -> None:
        key, members, order = DIMENSIONS[name]
        house.write(name, number_rows(members(landed), order, key, house.path(f"_unnumbered/{name}")))

    with shuffles_sized_for(landed):
        house.write("raw_offsets", sequence_offsets(landed, "_sequence"))
        # The dimensions are independent small jobs; submitting them together keeps the executors busy.
        with ThreadPoolExecutor(len(DIMENSIONS)) as pool:
            list(pool.map(write_dimension, DIMENSIONS))
        with splits_of(spark, SPLIT_BYTES):
            house.write_fact(booking_facts(house.raw_bookings(), {name: house.table(name) for name in DIMENSIONS}))
    shared_files.remove(spark, house.path("_unnumbered"))
    return house


def _once(spark: SparkSession, kind: str, source: str, build):
    key = (spark.sparkContext.applicationId, kind, source)
    with _lock:
        if key not in _built:
            _built[key] = build(f"{shared_folder(spark)}/stayledger/{key[0]}-{kind}-{uuid.uuid4().hex[:8]}")
        return _built[key]


@functools.cache
def _code() -> str:
    """Changes with the code that decides what a warehouse and the tables derived from it hold."""
    digest = hashlib.md5()
    for package in ("functions", "operators", "sources", "plans"):
        parent = importlib.import_module(f"..{package}", __package__)
        for found in sorted(pkgutil.iter_modules(parent.__path__), key=lambda m: m.name):
            digest.update(inspect.getsource(importlib.import_module(f"{parent.__name__}.{found.name}")).encode())
    return digest.hexdigest()


def _state_of(spark: SparkSession, sources: list[str]) -> dict:
    return {"code": _code(), "files": [[path, *entry] for path in sorted(sources) for entry in shared_files.files_below(spark, path)]}


def current_version(spark: SparkSession, root: str) -> Warehouse | None:
    """The warehouse that ``root``'s manifest names."""
    found = shared_files.read_text(spark, f"{root}/MANIFEST.json")
    return Warehouse(spark, f"{root}/{json.loads(found)['version']}") if found else None


def up_to_date(spark: SparkSession, root: str, sources: list[str], build: Callable[[str], Warehouse], keep_seconds: int = KEEP_SECONDS) -> Warehouse:
    """The warehouse below ``root``, built anew if the files of ``sources`` (names, sizes, times) or the code changed.

    A build goes to a folder of its own. The manifest, replaced by one rename after the last table is written, names the
    folder that counts, so readers see the whole old warehouse or the whole new one, and a failed build leaves the old
    one in place. If another application finished the same build meanwhile, its result is used. Folders that no manifest
    names are removed once they are ``keep_seconds`` old, which leaves time to those that read or build them.
    """
    state = _state_of(spark, sources)
    manifest = f"{root}/MANIFEST.json"

    def finished() -> Warehouse | None:
        found = shared_files.read_text(spark, manifest)
        known = json.loads(found) if found else {}
        return Warehouse(spark, f"{root}/{known['version']}") if known.get("state") == state else None

    if (house := finished()) is not None:
        return house
    version = f"version-{uuid.uuid4().hex}"
    try:
        built = build(f"{root}/{version}")
        if _state_of(spark, sources) != state:
            raise RuntimeError(f"the source files changed while {root} was built from them")
    except BaseException:
        shared_files.remove(spark, f"{root}/{version}")
        raise
    if (house := finished()) is not None:
        shared_files.remove(spark, f"{root}/{version}")
        return house
    shared_files.replace_text(spark, manifest, json.dumps({"version": version, "state": state, "tables": [*DIMENSIONS, "booking_fact"]}))
    for name, changed in shared_files.folders_in(spark, root):
        if name != version and changed < (time.time() - keep_seconds) * 1000:
            shared_files.remove(spark, f"{root}/{name}")
    return built


def warehouse_for(spark: SparkSession, tables_folder: str) -> Warehouse:
    """The warehouse derived from one folder of order tables, in the shared folder. It is built on first use and again when
    the tables change; other applications with the same shared folder use the same one."""
    sources = [f"{tables_folder}/{name}.parquet" for name in SOURCE_TABLES]
    root = f"{shared_folder(spark)}/stayledger/warehouse-{hashlib.md5(tables_folder.encode()).hexdigest()[:16]}"

    def build(folder: str) -> Warehouse:
        with shuffles_sized_for(table(spark, tables_folder, "lineitem"), table(spark, tables_folder, "orders")):
            return build_warehouse(spark, bookings_from_orders(spark, tables_folder, "_sequence"), folder)

    with _lock:
        house = up_to_date(spark, root, sources, build)
        key = (spark.sparkContext.applicationId, "warehouse", house.folder)
        return _built.setdefault(key, house)  # one handle per version keeps its table listings


def csv_landing_for(spark: SparkSession, tables_folder: str) -> str:
    """Folder of CSV files holding the raw bookings of ``tables_folder`` with their number."""

    house = warehouse_for(spark, tables_folder)

    def export(folder: str) -> str:
        raw = house.raw_bookings()
        write_booking_csv(raw.select(*[c for c in raw.columns if c != "booking_id"], "booking_id"), folder)
        return folder

    return _once(spark, "csv", house.folder, export)


def build_from_csv(spark: SparkSession, csv_path: str, folder: str, order: list[str]) -> Warehouse:
    """Build a warehouse from CSV files. ``order`` names the columns whose sorted order numbers the bookings."""
    raw = read_booking_csv(spark, csv_path)
    return build_warehouse(spark, with_sequence(raw, order, "_sequence", shuffle_width(raw)), folder)
