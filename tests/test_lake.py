"""Files, tables and versions, JDBC options, and the jobs over them."""

from __future__ import annotations

import glob
import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from larder import __main__ as cli
from larder.plans import jobs
from larder.sources import delta, lake
from larder.sources.files import scan, write_mode
from larder.sources.jdbc import Database, Ranges, Split, Window, hash_buckets, remainder
from larder.streaming.incremental import change_window, last_loaded
from larder.tables import PUBLISHED, SEEDED, TABLES, table
from tests.shop import SCHEMAS, build, frames

# --- scans ---------------------------------------------------------------------------------------


def test_csv_without_schema_is_all_text(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,price\n1,2.5\n2,x\n")
    assert [f.dataType.simpleString() for f in scan(spark, "csv", str(tmp_path / "t.csv")).schema] == ["string", "string"]
    typed = scan(spark, "CSV", str(tmp_path / "t.csv"), "id int, price double")
    assert [tuple(r) for r in typed.collect()] == [(1, 2.5), (2, None)]


def test_json_documents_and_lines(spark, tmp_path):
    document = [{"customer_id": "C1", "customer_mobile": "1"}, {"customer_id": "C2", "extra": 1}]
    (tmp_path / "d.json").write_text(json.dumps(document, indent=2))
    df = scan(spark, "json", str(tmp_path / "d.json"), TABLES["dim_customer"].schema)
    assert [tuple(r) for r in df.collect()] == [("C1", "1"), ("C2", None)]
    (tmp_path / "l.json").write_text("\n".join(json.dumps(d) for d in document))
    assert scan(spark, "json", str(tmp_path / "l.json"), multiLine=False).count() == 2


def test_geojson_features(spark, tmp_path):
    features = [{"type": "Feature", "properties": {"name": n}, "geometry": {"type": "Point", "coordinates": [1.0, 2.0]}} for n in "ab"]
    (tmp_path / "g.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    df = scan(spark, "geojson", str(tmp_path / "g.geojson")).select(F.explode("features").alias("f"))
    assert [r[0] for r in df.select("f.properties.name").collect()] == ["a", "b"]


def test_unknown_format_and_write_modes(spark):
    with pytest.raises(ValueError, match="orcx"):
        scan(spark, "orcx", "nowhere")
    assert [write_mode("full"), write_mode("delta"), write_mode("full", "append")] == ["overwrite", "append", "append"]


# --- JDBC: no database is started, only the handed options are checked ----------------------------


class Recorder:
    """Stands in for a DataFrame reader or writer and keeps what it is told."""

    def __init__(self, log):
        self.log = log

    def format(self, kind):
        self.log.append({"format": kind})
        return self

    def options(self, **options):
        self.log[-1].update(options)
        return self

    def mode(self, mode):
        self.log[-1]["mode"] = mode
        return self

    def load(self):
        return self.log[-1]

    def save(self):
        return None


    def jdbc(self, url, relation, predicates, properties):
        return {"url": url, "dbtable": relation, "predicates": predicates, **properties}


class FakeSpark:
    def __init__(self):
        self.read = Recorder([])


BASE = {"url": "jdbc:x", "user": "u", "password": "p"}


def test_jdbc_reads():
    db = Database(BASE, {"fact_sales": Split("order_no", 0, 100, 8)})
    assert db.read(FakeSpark(), table="dim_item") == {"format": "jdbc", **BASE, "dbtable": "dim_item"}
    assert db.read(FakeSpark(), query="SELECT 1")["dbtable"] == "(SELECT 1) AS tmp"
    split = db.read(FakeSpark(), table="fact_sales")
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("order_no", "0", "100", "8")
    with pytest.raises(ValueError, match="table or a query"):
        db.read(FakeSpark())
    assert "jdbc:x" not in repr(db) and "password" not in repr(db)


class Loading(FakeSpark):
    """Hands out given frames by what is read."""

    def __init__(self, frames):
        super().__init__()
        self.read = self.Reader([])
        self.read.frames = frames

    class Reader(Recorder):
        def load(self):
            return self.frames[self.log[-1]["dbtable"]]

        def jdbc(self, url, relation, predicates, properties):
            self.log.append({"predicates": predicates})
            frame = self.frames[relation]
            parts = [frame.filter(p) for p in predicates]
            out = parts[0]
            for p in parts[1:]:
                out = out.union(p)
            return out


def pushed(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_windows_are_comparisons_spark_can_hand_on(spark):
    """No SQL of any one database: Spark renders plain comparisons for each."""
    times = spark.createDataFrame([(datetime(2025, 11, d),) for d in range(9, 14)], "order_ts timestamp")
    texts = times.select(F.date_format("order_ts", "yyyy-MM-dd'T'HH:mm:ss").alias("order_ts"))
    window = Window("order_ts", "2025-11-10 00:00:00", "2025-11-12 00:00:00")
    for frame, days in ((times, [11, 12]), (texts, [10, 11, 12])):
        got = Database(BASE).read(Loading({"fact_sales": frame}), table="fact_sales", window=window)
        assert sorted(int(str(r[0])[8:10]) for r in got.collect()) == days
        assert "try_to_timestamp" not in pushed(got) and "cast(order_ts" not in pushed(got)
        # The caller's own cut of the fetched days is exact for both.
        assert change_window(got, "order_ts", datetime(2025, 11, 10), datetime(2025, 11, 12)).count() == 2
    open_end = Database(BASE).read(Loading({"fact_sales": texts}), table="fact_sales", window=Window("order_ts", end="2025-11-10 08:00:00"))
    assert open_end.count() == 2
    with_space = texts.select(F.translate("order_ts", "T", " ").alias("order_ts"))
    assert Database(BASE).read(Loading({"fact_sales": with_space}), table="fact_sales", window=window).count() == 3
    dialects = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects
    stamp = spark._jvm.java.sql.Timestamp.valueOf("2025-11-10 00:00:00")
    for url in ("jdbc:sqlserver://h", "jdbc:postgresql://h/d"):
        assert dialects.get(url).compileValue(stamp).strip("'") == "2025-11-10 00:00:00.0"
        assert dialects.get(url).compileValue("2025-11-10") == "'2025-11-10'"


@pytest.mark.parametrize("kind", ["text", "number", "time"])
@pytest.mark.parametrize("parts", [1, 3, 8, 50])
def test_ranges_found_by_a_query_cover_every_row_once(spark, kind, parts):
    """The bounds query and the conditions run as SQL over rows with quotes, repeats and missing values."""
    value = {
        "text": F.when(F.col("id") % 7 > 0, F.concat(F.lit("O'"), (F.col("id") % 40).cast("string"))),
        "number": F.when(F.col("id") % 7 > 0, F.col("id") % 40),
        "time": F.when(F.col("id") % 7 > 0, F.timestamp_seconds(F.col("id") * 1000)),
    }[kind]
    frame = spark.range(200).select("id", value.alias("k"))
    ranges = Ranges("k", parts)
    frame.createOrReplaceTempView("ranged")
    loading = Loading({f"({ranges.bounds_query('ranged')}) AS tmp": spark.sql(ranges.bounds_query("ranged")), "ranged": frame})
    got = Database(BASE, {"ranged": ranges}).read(loading, table="ranged")
    assert sorted(r.id for r in got.collect()) == list(range(200))
    conditions = [c for entry in loading.read.log for c in entry.get("predicates", [])]
    assert len(conditions) <= parts and (parts == 1) == (conditions == [])
    if kind == "time":
        sizes = [frame.filter(c).count() for c in conditions]
        assert parts == 1 or max(sizes) <= 2 * 200 / parts + 40


def test_ranges_of_an_empty_table_are_one_read(spark):
    frame = spark.createDataFrame([], "k string")
    frame.createOrReplaceTempView("ranged")
    ranges = Ranges("k", 4)
    loading = Loading({f"({ranges.bounds_query('ranged')}) AS tmp": spark.sql(ranges.bounds_query("ranged")), "ranged": frame})
    assert Database(BASE, {"ranged": ranges}).read(loading, table="ranged").count() == 0


def test_jdbc_reads_by_conditions():
    parts = hash_buckets("crc32(order_id)", 3)
    assert parts == ["MOD(crc32(order_id), 3) = 0 OR MOD(crc32(order_id), 3) IS NULL", "MOD(crc32(order_id), 3) = 1", "MOD(crc32(order_id), 3) = 2"]
    assert hash_buckets("h", 2, remainder("jdbc:sqlserver://x")) == ["(h) % 2 = 0 OR (h) % 2 IS NULL", "(h) % 2 = 1"]
    assert hash_buckets("h", 2, remainder("jdbc:postgresql://x")) == hash_buckets("h", 2)
    db = Database(BASE, {"fact_sales": parts})
    assert db.read(FakeSpark(), table="fact_sales") == {**BASE, "dbtable": "fact_sales", "predicates": parts}
    parse = lambda *more: cli.parser().parse_args([*more, "--root", "r", "--loadtype", "full"])
    assert cli.splits(parse("raw", "--table", "fact_sales", "--part", "a < 1", "--part", "a >= 1")) == {"fact_sales": ["a < 1", "a >= 1"]}
    by_hash = parse("raw", "--table", "fact_sales", "--hash", "h", "--parts", "2")
    assert cli.splits(by_hash) == {"fact_sales": hash_buckets("h", 2)}
    assert cli.splits(by_hash, "jdbc:sqlserver://x") == {"fact_sales": ["(h) % 2 = 0 OR (h) % 2 IS NULL", "(h) % 2 = 1"]}
    assert cli.splits(parse("raw", "--table", "fact_sales", "--ranges", "--parts", "9")) == {"fact_sales": Ranges("order_id", 9)}
    found = cli.splits(parse("dimensions", "--ranges"))
    assert found["dim_item"] == Ranges("item_id", 16) and len(found) == 5
    assert cli.splits(parse("dimensions")) == {}


class RecordingDatabase(Database):
    """Collects written frames instead of sending them anywhere."""

    def __init__(self):
        super().__init__(BASE)
        object.__setattr__(self, "written", {})

    def write(self, df, table, mode, schema=None):
        self.written[self.write_options(table, schema)["dbtable"]] = (mode, df)


def test_jdbc_write():
    log = []

    class Frame:
        write = Recorder(log)

    Database(BASE).write(Frame(), "customer", "overwrite", "people")
    Database(BASE).write(Frame(), "customer", "append")
    assert log[0] == {"format": "jdbc", **BASE, "dbtable": "people.customer", "truncate": "true", "mode": "overwrite"}
    assert log[1] == {"format": "jdbc", **BASE, "dbtable": "customer", "mode": "append"}


def test_delta_statements():
    sql = delta.merge_statement("/lake/t", "s0", ["k", "a"], ["k"], ["a"])
    assert sql == (
        "MERGE INTO delta.`/lake/t` t USING s0 s ON t.`k` = s.`k` WHEN MATCHED THEN UPDATE SET `a` = s.`a` "
        "WHEN NOT MATCHED THEN INSERT (`k`, `a`) VALUES (s.`k`, s.`a`)"
    )


# --- table layout and versions -------------------------------------------------------------------


def test_paths():
    t = lake.lake_table("/lake/", "fact_sales")
    assert t.current == "/lake/Raw/fact_sales/current"
    assert t.staged("2025-11-10") == "/lake/Raw/fact_sales/delta/2025-11-10/fact_sales.parquet"
    assert lake.lake_table("/lake", "customer", "dev").current == "/lake/Sandbox/Enrich/Enriched/customer/current"
    assert t.delta_path == "/lake/Raw/fact_sales/current/fact_sales.delta"
    assert lake.input_path("/lake", "areas.geojson") == "/lake/Input/Borough/areas.geojson"
    assert lake.landing_path("/lake", "dim_item", "full") == "/lake/DataSource/*/dim_item.csv"
    assert lake.landing_path("/lake", "dim_item", "delta", "2025-11-10") == "/lake/DataSource/2025-11-10/dim_item.csv"
    assert lake.landing_path("/lake", "dim_item", "delta").split("/")[3] == lake.today()
    for bad in (lambda: lake.LakeTable("/l", "gold", "t"), lambda: lake.lake_table("/l", "t"), lambda: lake.LakeTable("/l", "raw", "t", "test")):
        with pytest.raises(ValueError):
            bad()


def test_landed_files_of_a_run_type(spark, tmp_path):
    for runtype, value in (("prod", 1), ("dev", 2)):
        path = lake.landing_path(str(tmp_path), "dim_item", "delta", "2025-11-10", runtype)
        spark.range(value, value + 1).write.option("header", True).csv(path)
    read = [
        lake.read_landing(spark, str(tmp_path), "dim_item", load, "2025-11-10", "id bigint", runtype).collect()[0].id
        for runtype in ("prod", "dev")
        for load in ("full", "delta")
    ]
    assert read == [1, 1, 2, 2]


@pytest.fixture
def numbers(spark, tmp_path):
    return lake.LakeTable(str(tmp_path), "raw", "numbers")


def ids(df):
    return sorted(r.id for r in df.collect())


def test_versions_append_restore_history(spark, numbers):
    with pytest.raises(ValueError, match="no data"):
        lake.read(spark, numbers)
    lake.commit(spark, numbers, spark.range(3))
    lake.commit(spark, numbers, spark.range(3, 5), "append")
    lake.commit(spark, numbers, lake.read(spark, numbers).filter("id > 0"))
    assert ids(lake.read(spark, numbers)) == [1, 2, 3, 4]
    assert [ids(lake.read(spark, numbers, n)) for n in (0, 1)] == [[0, 1, 2], [0, 1, 2, 3, 4]]
    assert lake.restore(spark, numbers, 1).number == 3
    lake.commit(spark, numbers, spark.range(9, 10), "append")
    assert ids(lake.read(spark, numbers)) == [0, 1, 2, 3, 4, 9]
    counts = {r.version: r.record_count for r in lake.history(spark, numbers).collect()}
    assert counts == {0: 3, 1: 5, 2: 4, 3: 5, 4: 6}
    with pytest.raises(ValueError, match="version 7"):
        lake.read(spark, numbers, 7)
    with pytest.raises(ValueError, match="merge"):
        lake.commit(spark, numbers, spark.range(1), "merge")


def test_unfinished_version_is_invisible_and_written_over(spark, numbers):
    lake.commit(spark, numbers, spark.range(3))
    second = lake.commit(spark, numbers, spark.range(10))
    os.unlink(os.path.join(numbers.path(second), "_SUCCESS"))
    assert ids(lake.read(spark, numbers)) == [0, 1, 2]
    assert lake.commit(spark, numbers, spark.range(2)) == second
    assert ids(lake.read(spark, numbers)) == [0, 1]


def test_compaction_merges_small_files_without_a_shuffle(spark, numbers):
    lake.commit(spark, numbers, spark.range(0, 5000, 1, 40))
    new = lake.compact(spark, numbers)
    assert len(glob.glob(numbers.path(new) + "/*.parquet")) == 1
    assert lake.read(spark, numbers).count() == 5000
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") != str(1 << 30)


def test_staging_keeps_the_batch_of_the_day(spark, numbers):
    df = lake.stage(spark, numbers, spark.range(2), "2025-11-10")
    assert ids(df) == [0, 1] and "delta/2025-11-10" in df.inputFiles()[0]


# --- incremental windows -------------------------------------------------------------------------


def test_change_window_bounds(spark):
    df = spark.range(1, 6).withColumnRenamed("id", "t")
    picked = lambda *a, **k: sorted(r.t for r in change_window(df, *a, **k).collect())
    assert picked("t", 2, 4) == [3, 4]
    assert picked("t", end=4) == [1, 2, 3, 4]
    assert picked("t", 2) == [3, 4, 5]
    assert picked("t") == picked(None, 2, 4) == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_change_window_reaches_the_scan(spark, tmp_path, kind):
    moments = spark.range(0, 200_000, 86_400).select(F.timestamp_seconds("id").cast(kind).alias("ts"))
    moments.write.parquet(str(tmp_path / "t"))
    df = change_window(spark.read.parquet(str(tmp_path / "t")), "ts", datetime(1970, 1, 1), datetime(1970, 1, 2))
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts" in text and "LessThanOrEqual(ts" in text
    assert [r.ts for r in df.collect()] == [datetime(1970, 1, 2)]


def test_change_window_over_text_times(spark):
    df = spark.createDataFrame([("2025-11-10T08:00:00",), ("2025-11-11 08:00:00",), ("soon",)], "t string")
    assert change_window(df, "t", datetime(2025, 11, 10, 12)).count() == 1


def test_high_water_mark_of_nothing(spark):
    assert last_loaded(spark.range(0), "id") is None and last_loaded(spark.range(4), "id") == 3


# --- jobs ----------------------------------------------------------------------------------------

# Source tables hold text times and no load columns.
LOAD_COLUMNS = {"ingested_at", "total_order_price_anomaly_flag"}


def source_of(spark, data):
    built = frames(spark, data)

    def fetch(name, start=None, end=None):
        df = built[name]
        texts = {f.name: F.date_format(f.name, "yyyy-MM-dd'T'HH:mm:ss") for f in df.schema if f.dataType.typeName() == "timestamp"}
        return df.withColumns(texts).drop(*LOAD_COLUMNS)

    return fetch


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    target = jobs.Lake(spark, str(tmp_path_factory.mktemp("lake")))
    fetch = source_of(spark, build())
    jobs.load_dimensions(target, fetch)
    for name in ("fact_sales", "fact_kitchen", "fact_stock"):
        jobs.load_raw(target, name, fetch)
    return target


def test_raw_load_full(loaded):
    sales = loaded.read("fact_sales")
    assert sales.count() == 300 and sales.schema["order_ts"].dataType.typeName() == "timestamp"
    assert {"ingested_at", "total_order_price_anomaly_flag"} <= set(sales.columns)
    assert loaded.read("dim_stock_item").count() == 3
    assert loaded.read("fact_stock").filter("unit_of_measure is null").count() == 0


def test_products_publish_and_maintenance(loaded):
    for name in PUBLISHED:
        jobs.enrich(loaded, name)
    assert loaded.read("fact_sales_enriched").count() == 300
    assert loaded.read("customer_preference").count() == loaded.read("dim_customer").count()
    assert loaded.has_days("fact_sales_items") and not loaded.has_days("fact_sales_enriched")
    jobs.enrich(loaded, "customer")
    assert len(lake.versions(loaded.spark, loaded.table("customer"))) == 2

    everything = RecordingDatabase()
    jobs.publish(loaded, everything)
    assert set(everything.written) == {f"{TABLES[n].publish_schema}.{n}" for n in PUBLISHED}
    some = RecordingDatabase()
    assert jobs.publish(loaded, some, ["customer", "outlet_performance"]) == ["customer", "outlet_performance"]
    assert {n: m for n, (m, _) in some.written.items()} == {"people.customer": "overwrite", "enrich.outlet_performance": "overwrite"}
    with pytest.raises(ValueError, match="not published"):
        jobs.publish(loaded, some, ["all", "customer"])
    before = loaded.read("customer").count()
    assert "customer" in jobs.maintain(loaded, "enrich") and loaded.read("customer").count() == before


def test_delta_load_merges_changes_above_the_mark(spark, tmp_path):
    target = jobs.Lake(spark, str(tmp_path), "dev")
    data = build(orders=40)
    for i, order in enumerate(data["fact_sales"]):
        order["order_ts"] = datetime(2025, 11, 10, 0, i)
    jobs.load_raw(target, "fact_sales", source_of(spark, data), "delta")
    assert target.read("fact_sales").count() == 40

    late, changed, fresh = (dict(data["fact_sales"][i]) for i in (3, 5, 0))
    late.update(total_order_price=1.0)
    changed.update(total_order_price=2.0, order_ts=datetime(2025, 11, 11))
    fresh.update(order_id="NEW", order_ts=datetime(2025, 11, 12))
    later = {**data, "fact_sales": [late, changed, fresh]}
    jobs.load_raw(target, "fact_sales", source_of(spark, later), "delta", until=datetime(2025, 11, 13))
    got = {r.order_id: r.total_order_price for r in target.read("fact_sales").collect()}
    assert len(got) == 41 and got[changed["order_id"]] == 2.0 and "NEW" in got
    assert got[late["order_id"]] == data["fact_sales"][3]["total_order_price"]
    assert "/Sandbox/Raw/" in target.days("fact_sales").path


def test_delta_load_hands_its_window_to_the_database(spark, tmp_path):
    target, data, asked = jobs.Lake(spark, str(tmp_path)), build(orders=3), []
    for i, order in enumerate(data["fact_sales"]):
        order["order_ts"] = datetime(2025, 11, 10, 0, i)
    source = source_of(spark, data)

    class Asked(Database):
        def read(self, spark, table=None, query=None, window=None):
            asked.append((table, window))
            return source(table)

    fetch = jobs.database_fetch(spark, Asked(BASE))
    for name, until in (("fact_sales", datetime(2025, 11, 11)), ("fact_sales", datetime(2025, 11, 12)), ("dim_outlet", None)):
        jobs.load_raw(target, name, fetch, "delta", until=until)
    first, second, outlets = [a[1] for a in asked]
    assert first == Window("order_ts", None, "2025-11-11 00:00:00")
    assert second == Window("order_ts", "2025-11-10 00:02:00", "2025-11-12 00:00:00")
    assert outlets is None


def test_delta_load_of_a_dimension_merges_and_of_stock_replaces(spark, tmp_path):
    target, data = jobs.Lake(spark, str(tmp_path)), build(orders=5)
    fetch = source_of(spark, data)
    for name in ("dim_outlet", "fact_stock"):
        jobs.load_raw(target, name, fetch)
    later = {**data, "dim_outlet": [{"outlet_id": "OUT1", "outlet_name": "Renamed"}], "fact_stock": data["fact_stock"][1:2]}
    for name in ("dim_outlet", "fact_stock"):
        jobs.load_raw(target, name, source_of(spark, later), "delta")
    names = {r.outlet_id: r.outlet_name for r in target.read("dim_outlet").collect()}
    assert len(names) == 5 and names["OUT1"] == "Renamed"
    assert target.read("fact_stock").count() == 1


def test_repeated_keys_keep_the_latest_change(spark, tmp_path):
    target, data = jobs.Lake(spark, str(tmp_path)), build(orders=3)
    early, late = (dict(data["fact_sales"][0], order_ts=datetime(2025, 11, d)) for d in (10, 12))
    fetch = source_of(spark, {**data, "fact_sales": [early, late, early]})
    jobs.load_raw(target, "fact_sales", fetch)
    assert [r.order_ts for r in target.read("fact_sales").collect()] == [datetime(2025, 11, 12)]


def test_failing_dimension_does_not_stop_the_others(spark, tmp_path):
    target, fetch = jobs.Lake(spark, str(tmp_path)), source_of(spark, build(orders=2))

    def broken(name, start, end):
        if name == "dim_item":
            raise RuntimeError("no such source")
        return fetch(name, start, end)

    with pytest.raises(ExceptionGroup, match="dim_item"):
        jobs.load_dimensions(target, broken)
    assert [n for n in SEEDED if target.has(n)] == ["dim_outlet", "dim_customer", "dim_stock_item", "dim_chef"]


def test_seed_turns_nested_lines_into_text(spark, tmp_path):
    for name in SEEDED:
        (tmp_path / f"{name}.json").write_text("[]")
    order = {"order_id": "O1", "order_ts": "2025-11-10T01:02:03", "order_menu_details": [{"item_id": "I1", "quantity": 2, "toppings": []}]}
    (tmp_path / "fact_sales.json").write_text(json.dumps([order], indent=2))
    database = RecordingDatabase()
    jobs.seed(spark, str(tmp_path), database)
    assert list(database.written) == list(SEEDED)
    assert {n: m for n, (m, _) in database.written.items()} == {n: table(n).seed_mode for n in SEEDED}
    row = database.written["fact_sales"][1].first()
    assert json.loads(row.order_menu_details) == [{"item_id": "I1", "quantity": 2, "toppings": []}]


def test_command_line_reads_landed_files(spark, tmp_path):
    folder = tmp_path / "drop" / "DataSource" / "2025-11-10"
    folder.mkdir(parents=True)
    (folder / "dim_outlet.csv").write_text("outlet_id,outlet_name\n OUT1 , North \n,none\n")
    common = ["--root", str(tmp_path / "lake"), "--landing", str(tmp_path / "drop")]
    cli.main(["raw", "--table", "dim_outlet", "--loadtype", "full", *common])
    stored = jobs.Lake(spark, str(tmp_path / "lake")).read("dim_outlet")
    assert [(r.outlet_id, r.outlet_name) for r in stored.collect()] == [("OUT1", "North")]
    assert cli.parser().parse_args(["publish", "--root", "x", "--tables", "customer", "chef_performance"]).tables == ["customer", "chef_performance"]


def test_schemas_of_the_registry_and_the_fixture_agree(spark):
    for name in SEEDED:
        fixture = spark.createDataFrame([], SCHEMAS[name]).columns
        declared = spark.createDataFrame([], table(name).schema).columns
        assert [c for c in fixture if c in declared] == declared


def test_command_line_keeps_all_days_of_stock(spark, tmp_path):
    for day, item in (("2025-11-10", "Rice"), ("2025-11-11", "Oil")):
        folder = tmp_path / "drop" / "DataSource" / day
        folder.mkdir(parents=True)
        row = f"OUT1,{item},5.0,kg,{day}T01:00:00\n"
        (folder / "fact_stock.csv").write_text("outlet_id,stock_item,available_quantity,unit_of_measure,stock_date\n" + row)
    common = ["--table", "fact_stock", "--root", str(tmp_path / "lake"), "--landing", str(tmp_path / "drop")]
    cli.main(["raw", "--loadtype", "full", *common])
    cli.main(["raw", "--loadtype", "delta", "--day", "2025-11-11", *common])
    stored = jobs.Lake(spark, str(tmp_path / "lake")).read("fact_stock")
    assert sorted(r.stock_item for r in stored.collect()) == ["Oil", "Rice"]
