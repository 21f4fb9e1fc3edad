"""Star-schema build, sources, numbering and plans."""

import re

import pytest
from pyspark.sql import functions as F

from stayledger import session
from stayledger.operators import dimensions, facts
from stayledger.operators.filters import WIDE_COLUMNS, apply_filters
from stayledger.operators.numbering import number_rows, with_sequence
from stayledger.plans.warehouse_build import build_from_csv, csv_landing_for, current_version, up_to_date, warehouse_for
from stayledger.sources.booking_schema import RAW_COLUMNS
from stayledger.sources.csv_bookings import damaged_cells, read_booking_csv
from stayledger.sources.warehouse_store import Warehouse

BOOKING = {
    "hotel": "City Hotel", "is_canceled": 0, "lead_time": 10, "arrival_date_year": 2016, "arrival_date_month": "July",
    "arrival_date_week_number": 27, "arrival_date_day_of_month": 2, "stays_in_weekend_nights": 1,
    "stays_in_week_nights": 2, "adults": 2, "children": 0.0, "babies": 0, "meal": "BB", "country": "PRT",
    "market_segment": "Direct", "distribution_channel": "Direct", "is_repeated_guest": 0, "previous_cancellations": 0,
    "previous_bookings_not_canceled": 0, "reserved_room_type": "A", "assigned_room_type": "A", "booking_changes": 0,
    "deposit_type": "No Deposit", "agent": 9, "company": None, "days_in_waiting_list": 0, "customer_type": "Transient",
    "adr": 100.0, "required_car_parking_spaces": 0, "total_of_special_requests": 1, "reservation_status": "Check-Out",
    "reservation_status_date": "2016-07-05",
}


def csv_text(*changes):
    lines = [",".join(RAW_COLUMNS)]
    for change in changes:
        values = {**BOOKING, **change}
        lines.append(",".join("NULL" if values[c] is None else str(values[c]) for c in RAW_COLUMNS))
    return "\n".join(lines) + "\n"


@pytest.fixture
def small(spark, tmp_path):
    """A warehouse from a CSV with null tokens, copies and odd rows."""
    source = tmp_path / "bookings.csv"
    source.write_text(
        csv_text(
            {"country": "NULL", "adr": 80.5},
            {"country": "NA", "children": "NA", "agent": "9.0"},
            {"arrival_date_day_of_month": 3, "agent": "NULL", "company": "5.0"},
            {"arrival_date_day_of_month": 4, "assigned_room_type": "B", "agent": None, "company": None},
            {"arrival_date_day_of_month": 4, "arrival_date_week_number": 28, "lead_time": 400},
            {"lead_time": 400},
            {"lead_time": 400},
        )
    )
    return build_from_csv(spark, str(source), str(tmp_path / "house"), ["lead_time", "arrival_date_day_of_month", "adr"])


def test_csv_null_tokens(spark, tmp_path):
    source = tmp_path / "one.csv"
    source.write_text(csv_text({"children": "NA", "country": "", "agent": "12.0", "company": "NULL", "adr": "nan"}))
    df = read_booking_csv(spark, str(source))
    row = df.first()
    assert (row.children, row.country, row.agent, row.company, row.adr) == (None, None, 12, None, None)
    assert row.reservation_status_date.isoformat() == "2016-07-05" and row.lead_time == 10


def test_csv_reads_only_wanted_columns(spark, tmp_path):
    (tmp_path / "one.csv").write_text(csv_text({}))
    plan = read_booking_csv(spark, str(tmp_path / "one.csv")).select("adr")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<adr:string>" in plan


def test_null_country_is_one_member_and_found(small):
    members = small.table("customer_dim").filter("country IS NULL").collect()
    assert len(members) == 1
    assert small.star("booking_id", "country").filter("country IS NULL").count() == 2


def test_agents(small):
    agents = {(r.agent_id, r.company_id) for r in small.table("agent_dim").collect()}
    assert agents == {("9", "Unknown"), ("Unknown", "5"), ("Unknown", "Unknown")}


def test_weekend_season_and_week_conflict(small):
    days = {r.day_of_month: r for r in small.table("date_dim").collect()}
    assert [days[d].is_weekend for d in (2, 3, 4)] == [True, True, False]  # Saturday, Sunday, Monday
    assert days[4].week_number == 27 and days[2].season == "Summer"
    assert dimensions.week_conflicts(small.raw_bookings()).count() == 1


def test_facts(small):
    facts_ = small.table("booking_fact").orderBy("booking_id").toPandas()
    assert list(facts_.booking_id) == [1, 2, 3, 4, 5, 6, 7]
    assert facts_.children.eq(0).all() and facts_.total_stay_nights.eq(3).all() and facts_.total_guests.eq(2).all()
    assert facts_.revenue.iloc[0] == 80.5 * 3
    assert small.star("room_changed").filter("room_changed").count() == 1


def test_missing_member_gets_key_one(spark, small):
    kept = {name: small.table(name) for name in dimensions.DIMENSIONS}
    kept["room_dim"] = kept["room_dim"].filter("NOT room_changed")
    keyed = facts.with_foreign_keys(small.raw_bookings(), kept)
    assert facts.missing_keys(keyed).first().asDict() == {
        "date_key": 0, "hotel_key": 0, "customer_key": 0, "room_key": 1, "agent_key": 0
    }
    assert facts.with_default_key(keyed).filter("room_key IS NULL").count() == 0


def test_reopened_warehouse(spark, small):
    again = Warehouse(spark, small.folder)
    assert again.star("booking_id", "hotel_name").count() == 7


def test_sql_over_the_warehouse(house):
    text = """SELECT hd.hotel_name, count(*) AS n FROM {booking_fact} bf JOIN {hotel_dim} hd ON bf.hotel_key = hd.hotel_key
      GROUP BY hd.hotel_name"""
    assert sum(r.n for r in house.sql(text).collect()) == 6000


def test_keys_are_dense_and_present(house):
    fact = house.table("booking_fact")
    for name, (key, _, _) in dimensions.DIMENSIONS.items():
        members = house.table(name)
        n, low, high, distinct = members.agg(F.count("*"), F.min(key), F.max(key), F.count_distinct(key)).first()
        assert (low, high, distinct) == (1, n, n)
        assert fact.join(members, key, "left_anti").count() == 0


def test_numbering_spreads_copies(spark, tmp_path):
    """A third of the rows are copies of one row; the numbers stay dense and follow the order."""
    df = spark.range(0, 30000, 1, 6).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("v"), F.col("id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = number_rows(df, ["v"], "n", str(tmp_path / "numbered")).toPandas().sort_values("n")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert list(numbered.n) == list(range(1, 30001)) and numbered.v.is_monotonic_increasing
    copies = spark.read.parquet(str(tmp_path / "numbered")).filter("v = 7")
    assert copies.select(F.shiftright("_sequence", 33).alias("part")).distinct().count() > 1


def test_partitions_grow_with_the_scan(spark, tables_folder, monkeypatch):
    lines = spark.read.parquet(f"{tables_folder}/lineitem.parquet")
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    assert session.shuffle_width(lines) is None
    monkeypatch.setattr(session, "PARTITION_BYTES", 5000)
    width = session.shuffle_width(lines)
    assert width > int(before)
    with session.shuffles_sized_for(lines):
        assert spark.conf.get(key) == str(width)
    assert spark.conf.get(key) == before
    ranged = with_sequence(lines.select("l_orderkey"), ["l_orderkey"], "n", width)
    assert ranged.rdd.getNumPartitions() == width


def test_fact_is_written_without_a_shuffle(spark, tmp_path):
    """Every file comes from one task of the facts, and the landing's tasks follow the size of rows, not of files."""
    facts = spark.range(0, 4000, 1, 4).select(
        F.col("id").alias("booking_id"), (F.col("id") % 2).alias("is_canceled"), (F.col("id") % 9).alias("lead_time"),
        (1990 + F.col("id") % 3).alias("arrival_year"), F.spark_partition_id().alias("task"),
    )
    Warehouse(spark, str(tmp_path / "house")).write_fact(facts)
    files = spark.read.parquet(str(tmp_path / "house/booking_fact")).groupBy(F.input_file_name().alias("file"))
    found = files.agg(F.count_distinct("task").alias("tasks"), F.count("*").alias("rows")).collect()
    assert sum(r.rows for r in found) == 4000 and len(found) == 12 and {r.tasks for r in found} == {1}
    assert session.PARTITION_BYTES <= 16 * 1024 * 1024


def test_a_dimension_above_the_usual_limit_is_still_sent(spark, house):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        assert plan_of(house.star("agent_id", "adr")).count("BroadcastHashJoin") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_csv_landing_is_compressed(spark, tables_folder, tmp_path):
    files = spark.read.format("binaryFile").load(csv_landing_for(spark, tables_folder)).select("path").collect()
    assert files and all(r.path.endswith(".csv.gz") for r in files)


def test_missing_shared_folder_is_an_error_on_a_cluster(monkeypatch):
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        session.shared_folder(Session())


def test_csv_landing_is_reused(spark, tables_folder):
    assert csv_landing_for(spark, tables_folder) == csv_landing_for(spark, tables_folder)
    assert warehouse_for(spark, tables_folder) is warehouse_for(spark, tables_folder)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_star_plan(house):
    plan = plan_of(house.star(*WIDE_COLUMNS))
    assert plan.count("BroadcastHashJoin") == 4
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "SortMergeJoin" not in plan


def test_star_joins_only_needed_dimensions(house):
    plan = plan_of(house.star("market_segment", "is_canceled"))
    assert plan.count("BroadcastHashJoin") == 1
    assert re.search(r"ReadSchema: struct<hotel_key:bigint,is_canceled:int>", plan)


def test_filters_reach_the_scan(house):
    df = apply_filters(house.star("year", "hotel_name", "is_canceled", "adr"), hotel="City Hotel", years=(1996, 1997))
    plan = plan_of(df)
    assert re.search(r"PartitionFilters: \[[^\]]*arrival_year#\d+ >= 1996", plan)
    assert "EqualTo(hotel_name,City Hotel)" in plan
    kept = plan_of(apply_filters(house.star("year", "is_canceled", "adr"), exclude_cancelled=True))
    assert "EqualTo(is_canceled,0)" in kept


def _rows_scanned(df):
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().get("numOutputRows").get().value()


def test_booking_lookup_skips_row_groups(spark, house):
    stored = spark.read.parquet(house.path("booking_fact"))
    number = stored.agg(F.percentile_approx("booking_id", 0.5)).first()[0]
    own = stored.filter(F.col("booking_id") == number).select(facts.YEAR_PARTITION).first()[0]
    around = stored.filter(F.col(facts.YEAR_PARTITION) != own).agg(F.min("booking_id"), F.max("booking_id")).first()
    assert around[0] < number < around[1]

    def elsewhere(rows):
        return rows.filter((F.col("booking_id") == number) & (F.col(facts.YEAR_PARTITION) != own)).select("booking_id", "adr")

    assert _rows_scanned(elsewhere(stored)) == 0
    blind = spark.read.option("parquet.filter.bloom.enabled", "false").parquet(house.path("booking_fact"))
    assert _rows_scanned(elsewhere(blind)) > 0


def test_cached_star(house):
    with house.cached_star("year", "hotel_name", "is_canceled", hotel="City Hotel") as kept:
        assert kept.is_cached and kept.count() == kept.filter("hotel_name = 'City Hotel'").count()
    assert not kept.is_cached


def test_csv_columns_are_found_by_name(spark, tmp_path):
    lines = csv_text({"country": "PRT", "market_segment": "Online"}).splitlines()
    at, to = list(RAW_COLUMNS).index("country"), list(RAW_COLUMNS).index("market_segment")
    swapped = []
    for line in lines:
        cells = line.split(",")
        cells[at], cells[to] = cells[to], cells[at]
        swapped.append(",".join([*cells, "more"]))
    (tmp_path / "swapped.csv").write_text("\n".join(swapped) + "\n")
    (tmp_path / "plain.csv").write_text("\n".join(lines) + "\n")
    found = read_booking_csv(spark, str(tmp_path / "swapped.csv")).first()
    assert found == read_booking_csv(spark, str(tmp_path / "plain.csv")).first() and found.country == "PRT"
    (tmp_path / "short.csv").write_text("hotel,adr\nx,1\n")
    with pytest.raises(ValueError, match="is_canceled"):
        read_booking_csv(spark, str(tmp_path / "short.csv"))


def test_csv_damage_is_counted_and_large_ids_survive(spark, tmp_path):
    source = tmp_path / "odd.csv"
    source.write_text(csv_text({"lead_time": "3.7", "agent": 9007199254740993}, {"lead_time": "12.0", "adr": "x"}, {"adr": "#NA", "country": "None"}))
    rows = read_booking_csv(spark, str(source)).select("lead_time", "agent", "adr", "country").collect()
    assert [r.lead_time for r in rows] == [None, 12, 10] and rows[0].agent == 9007199254740993
    assert rows[1].adr is None and rows[2].adr is None and rows[2].country == "None"
    damaged = {r.column_name: r.damaged for r in damaged_cells(spark, str(source)).collect() if r.damaged}
    assert damaged == {"lead_time": 1, "adr": 1}


def test_star_keeps_every_booking_whatever_is_asked(spark, tmp_path):
    source = tmp_path / "years.csv"
    source.write_text(csv_text(*({"lead_time": i, "arrival_date_year": "?" if i % 5 == 0 else 2015 + i % 2} for i in range(10))))
    house = build_from_csv(spark, str(source), str(tmp_path / "years"), ["lead_time"])
    for columns in (["lead_time"], ["lead_time", "season"], ["year"], ["year", "month", "season"], ["lead_time", "hotel_name", "country"]):
        assert house.star(*columns).count() == 10
    assert sorted(str(r.year) for r in house.star("year", "full_date").collect()) == sorted(["None"] * 2 + ["2015"] * 4 + ["2016"] * 4)


def test_bookings_without_a_date_member_take_the_default(spark, small):
    from stayledger.operators.dimensions import DIMENSIONS
    from stayledger.operators.facts import booking_facts

    tables = {name: small.table(name) for name in DIMENSIONS}
    dates = tables["date_dim"]
    tables["date_dim"] = dates.filter("date_key = 1").withColumn("year", F.col("year") - 3)
    facts = booking_facts(small.raw_bookings(), tables)
    year = tables["date_dim"].first().year
    assert {r.arrival_year for r in facts.collect()} == {year} and facts.count() == small.table("booking_fact").count()


def _versions(root):
    return sorted(p.name for p in root.iterdir() if p.is_dir())


def test_versions_follow_their_source(spark, tmp_path):
    """A second application builds nothing, a changed source is built anew, superseded folders go."""
    source, root, built = tmp_path / "bookings.csv", tmp_path / "root", []
    source.write_text(csv_text({"lead_time": 1}, {"lead_time": 2}))

    def build(folder):
        built.append(folder)
        return build_from_csv(spark, str(source), folder, ["lead_time"])

    def opened(**options):
        return up_to_date(spark, str(root), [str(source)], build, **options)

    first = opened()
    assert first.table("booking_fact").count() == 2 and not (root / _versions(root)[0] / "_unnumbered").exists()
    assert opened().folder == first.folder and len(built) == 1
    source.write_text(csv_text({"lead_time": 1}, {"lead_time": 2}, {"lead_time": 3}))
    second = opened()
    assert second.table("booking_fact").count() == 3 and len(built) == 2
    assert first.table("booking_fact").count() == 2 and len(_versions(root)) == 2  # left to those that still read it
    source.write_text(csv_text({"lead_time": 4}))
    third = opened(keep_seconds=0)
    assert _versions(root) == [third.folder.rsplit("/", 1)[1]]
    assert current_version(spark, str(root)).table("booking_fact").count() == 1
    assert sorted(p.name for p in root.iterdir() if p.is_file() and not p.name.startswith(".")) == ["MANIFEST.json"]


def test_failed_build_leaves_the_old_version(spark, tmp_path):
    source, root = tmp_path / "bookings.csv", tmp_path / "root"
    source.write_text(csv_text({"lead_time": 1}))
    good = up_to_date(spark, str(root), [str(source)], lambda folder: build_from_csv(spark, str(source), folder, ["lead_time"]))
    source.write_text(csv_text({"lead_time": 1}, {"lead_time": 2}))

    def broken(folder):
        Warehouse(spark, folder).write("hotel_dim", spark.range(3))
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        up_to_date(spark, str(root), [str(source)], broken)
    assert current_version(spark, str(root)).folder == good.folder and good.table("booking_fact").count() == 1 and len(_versions(root)) == 1

    def slow(folder):
        made = build_from_csv(spark, str(source), folder, ["lead_time"])
        source.write_text(csv_text({"lead_time": 9}))
        return made

    with pytest.raises(RuntimeError, match="changed"):
        up_to_date(spark, str(root), [str(source)], slow)
    assert current_version(spark, str(root)).folder == good.folder


def test_another_application_was_faster(spark, tmp_path):
    source, root = tmp_path / "bookings.csv", tmp_path / "root"
    source.write_text(csv_text({"lead_time": 1}))
    plain = lambda folder: build_from_csv(spark, str(source), folder, ["lead_time"])
    others = []

    def late(folder):
        others.append(up_to_date(spark, str(root), [str(source)], plain))
        return plain(folder)

    assert up_to_date(spark, str(root), [str(source)], late).folder == others[0].folder and len(_versions(root)) == 1


def test_results_are_kept_by_version(spark, small, capsys):
    """The second call, of another handle, scans no fact; other options and other versions are computed."""
    calls = []

    def figures(house, **options):
        def build():
            calls.append(options)
            return apply_filters(house.star("year", "hotel_name", "is_canceled"), **options).groupBy("hotel_name").count()

        return house.result("bookings_by_hotel", build, **options)

    first = figures(small, hotel="City Hotel").collect()
    again = figures(Warehouse(spark, small.folder), hotel="City Hotel")
    assert again.collect() == first and len(calls) == 1
    again.explain()
    assert "booking_fact" not in capsys.readouterr().out
    assert figures(small, hotel="Resort Hotel").collect() == [] and figures(small).collect() == first and len(calls) == 3
