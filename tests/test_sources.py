from __future__ import annotations

import datetime as dt
import json
import logging

import pytest
from pyspark.sql import functions as F

from ridelake.operators import gold
from ridelake.operators.digest import digest
from ridelake.operators.normalise import normalise_ride
from ridelake.operators.report import quality_report
from ridelake.plans.layers import LayerConfig, run_layers
from ridelake.sources import declared, files, schemas, tables
from ridelake.sources.scratch import shared_folder
from test_bronze_silver import ride


def raw_frames(spark):
    n = 40
    ids = spark.range(n)
    return {
        "passenger": ids.selectExpr(
            "CONCAT('P', id) passenger_id", "'a' first_name", "'b' last_name",
            "IF(id = 3, NULL, 'a@b.com') email", "'+12025551234' phone",
            "'2026-01-02T00:00:00' signup_timestamp", "'NY' city", "'US' country", "'active' status",
        ),
        "driver": ids.selectExpr(
            "CONCAT('D', id) driver_id", "'a' first_name", "'b' last_name",
            "'2026-01-02T00:00:00' signup_timestamp", "id / 8 AS rating", "'NY' city",
            "'US' country", "IF(id % 4 = 0, 'banned', 'active') status",
        ),
        "vehicle": ids.selectExpr(
            "CONCAT('V', id) vehicle_id", "CONCAT('D', id) driver_id", "'m' make", "'n' model",
            "2020 AS year", "'xl' vehicle_type", "CONCAT('p', id) license_plate",
        ),
        "ride": ids.selectExpr(
            "CONCAT('R', id % 30) ride_id", "CONCAT('P', id % 5) passenger_id",
            "CONCAT('D', id % 6) driver_id", "'V1' vehicle_id",
            "CONCAT('2026-0', id % 3 + 1, '-01T10:00:00') request_timestamp",
            "CONCAT('2026-0', id % 3 + 1, '-01T10:05:00') pickup_timestamp",
            "CONCAT('2026-0', id % 3 + 1, '-01T10:25:00') dropoff_timestamp",
            "1.0D pickup_latitude", "1.0D pickup_longitude", "2.0D dropoff_latitude",
            "2.0D dropoff_longitude",
            "CASE id % 4 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN 'New York' ELSE 'LA' END pickup_city",
            "'LA' dropoff_city", "CAST(id AS DOUBLE) distance_km", "20 duration_minutes",
            "10.5D fare_amount", "'USD' currency",
            "IF(id % 7 = 0, 'no_show', 'completed') ride_status",
        ),
        "payment": ids.selectExpr(
            "CONCAT('M', id) payment_id", "CONCAT('R', id) ride_id",
            "'2026-01-02T00:00:00' payment_timestamp", "'cash' payment_method",
            "10.5D amount", "'USD' currency", "'completed' payment_status",
        ),
    }


def test_landing_is_idempotent_per_date(spark, tmp_path):
    raw = str(tmp_path / "raw")
    df = raw_frames(spark)["ride"]
    for date in ("2026-05-01", "2026-05-02", "2026-05-01"):
        files.land_raw(df, raw, "ride", date)
    back = files.read_raw(spark, raw, "ride")
    assert back.groupBy("ingestion_date").count().orderBy("ingestion_date").collect() == [
        (dt.date(2026, 5, 1), 40),
        (dt.date(2026, 5, 2), 40),
    ]
    lines = next((tmp_path / "raw/ride/ingestion_date=2026-05-01").glob("*.json")).read_text()
    assert json.loads(lines.splitlines()[0])["currency"] == "USD"


def test_landed_files_can_be_compressed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "LANDED", 15)
    df = raw_frames(spark)["ride"].coalesce(1)
    files.land_raw(df, str(tmp_path / "raw"), "ride", "2026-05-01", "gzip")
    landed = list((tmp_path / "raw/ride/ingestion_date=2026-05-01").glob("part-*"))
    assert len(landed) == 3 and all(f.name.endswith(".json.gz") for f in landed)
    back = files.read_raw(spark, str(tmp_path / "raw"), "ride")
    assert sorted(r["distance_km"] for r in back.collect()) == [float(i) for i in range(40)]


def test_missing_entity_is_skipped(spark, tmp_path, caplog):
    frames = {"driver": raw_frames(spark)["driver"]}
    with caplog.at_level(logging.WARNING):
        assert files.land_all(frames, str(tmp_path), "2026-05-01") == ["driver"]
    assert "ride" in caplog.text


def test_raw_numbers(spark, tmp_path):
    place = tmp_path / "driver"
    place.mkdir()
    texts = ['{"driver_id":"a","rating":4.5}', '{"driver_id":"b","rating":"4.25"}',
             '{"driver_id":"c"}', '{"driver_id":"d","rating":"good"}']
    (place / "drivers.jsonl").write_text("\n".join(texts))
    typed = files.read_raw(spark, str(tmp_path), "driver")
    assert [r["rating"] for r in typed.orderBy("driver_id").collect()] == [4.5, 4.25, None, None]
    out = str(tmp_path / "bronze")
    files.ingest_bronze(spark, str(tmp_path), out, ["driver"])
    bronze = files.read_bronze(spark, out, "driver").orderBy("driver_id").collect()
    assert [r["rating"] for r in bronze] == [4.5, 4.25, 0.0, None]


def test_jsonl_round_trip(spark, tmp_path):
    df = raw_frames(spark)["payment"]
    files.write_jsonl(df, str(tmp_path / "p"))
    back = spark.read.schema(schemas.RAW["payment"]).json(str(tmp_path / "p"))
    assert sorted(back.collect()) == sorted(df.select(back.columns).collect())


def test_report_and_quarantine_files(spark, tmp_path):
    df = raw_frames(spark)["ride"]
    files.write_report(quality_report(df, "ride"), str(tmp_path / "report"))
    report = json.loads(next((tmp_path / "report").glob("*.json")).read_text())
    assert report["records"] == 40 and report["invalid_records"] == 0
    mixed = df.withColumn(
        "ride_status", F.when(F.col("ride_id") == "R1", "x").otherwise(F.col("ride_status"))
    )
    files.write_quarantine(mixed, "ride", str(tmp_path / "checked"))
    good, bad = files.read_quarantine(spark, str(tmp_path / "checked"))
    assert sorted(good.columns) == sorted(df.columns)
    assert good.count() == 38 and bad.count() == 2
    assert {tuple(r["errors"]) for r in bad.collect()} == {("ride_status 'x' is invalid",)}


def test_partitioned_table_keeps_values(spark):
    df = raw_frames(spark)["ride"]
    tables.write_table(df, "w_ride", "pickup_city")
    back = tables.read_table(spark, "w_ride")
    assert sorted(map(str, back.select(df.columns).collect())) == sorted(map(str, df.collect()))
    for values, n in ((("",), 10), (("LA",), 10), (("", "New York"), 20)):
        assert tables.in_partition(back, "pickup_city", *values).count() == n
    plan = tables.in_partition(back, "pickup_city", "LA")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(pickup_city_part" in plan
    tables.write_table(df.limit(3), "w_ride", "pickup_city")  # replaces
    assert tables.read_table(spark, "w_ride").count() == 3
    tables.reset_tables(spark, ["w_ride", "never_there"])
    assert "w_ride" not in [r["tableName"] for r in tables.list_layer(spark, "w").collect()]


def test_derived_partitions(spark):
    df = gold.ride_daily_metrics(raw_frames(spark)["ride"])
    tables.write_table(df, "gold_x", [("years", "date"), ("months", "date")])
    back = tables.read_table(spark, "gold_x")
    assert {(r["date_year"], r["date_month"]) for r in back.collect()} == {(2026, m) for m in (1, 2, 3)}
    assert [r["tableName"] for r in tables.list_layer(spark, "gold").collect()] == ["gold_x"]
    tables.reset_tables(spark, ["gold_x"])


@pytest.mark.parametrize("layer, n", [("bronze", 5), ("silver", 5), ("gold", 3)])
def test_create_tables(spark, layer, n):
    names = schemas.create_tables(spark, layer, prefix="made_")
    assert len(names) == n
    schemas.create_tables(spark, layer, prefix="made_")  # again: no error
    have = {r["tableName"] for r in tables.list_layer(spark, "made").collect()}
    assert have == set(names)
    tables.reset_tables(spark, names)


def test_iceberg_statement():
    text = schemas.create_statement("gold_city_metrics", "cat.db.city", fmt="iceberg")
    assert text.startswith("CREATE TABLE IF NOT EXISTS cat.db.city (date DATE NOT NULL")
    assert text.endswith("USING iceberg PARTITIONED BY (months(date))")
    assert "DEFAULT" not in schemas.create_statement("silver_ride", fmt="iceberg")
    assert schemas.create_statement("silver_driver", fmt="iceberg").endswith("(country, city)")


def test_conform(spark):
    df = spark.createDataFrame([ride()], schemas.RAW["ride"])
    out = schemas.conform(normalise_ride(df), "silver_ride")
    kinds = {f.name: f.dataType.simpleString() for f in out.schema.fields}
    assert kinds["fare_amount"] == "decimal(8,2)" and kinds["request_time"] == "timestamp_ntz"
    row = out.first()
    # No rule has looked at the row.
    assert row["valid_record"] is None and row["data_quality_checks"] is None
    checked = schemas.conform(normalise_ride(df, checks=True), "silver_ride").first()
    assert checked["valid_record"] is not None and checked["data_quality_checks"]
    assert row["request_time"] == dt.datetime(2026, 5, 1, 10)
    wide = spark.createDataFrame([ride(fare_amount=1e9)], schemas.RAW["ride"])
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        schemas.conform(normalise_ride(wide), "silver_ride").collect()


def test_the_gate_names_what_does_not_fit(spark):
    rows = [
        ride(ride_id="fits"),
        ride(ride_id="wide", fare_amount=1e9, pickup_latitude=12345.0),
        ride(ride_id="late", request_timestamp="soon", dropoff_timestamp=None),
        ride(ride_id="void", distance_km=None, pickup_latitude=None),
        ride(ride_id="half", fare_amount=12.345),
    ]
    df = normalise_ride(spark.createDataFrame(rows, schemas.RAW["ride"])).withColumn("more", F.lit(1))
    got = {r["ride_id"]: r for r in declared.gate(df, "silver_ride").collect()}
    assert {k: sorted(r["refused"]) for k, r in got.items()} == {
        "fits": [],
        "half": [],
        "wide": ["fare_amount_unfit", "pickup_location_latitude_unfit"],
        "late": ["dropoff_time_unfit", "request_time_unfit"],
        "void": ["distance_km_missing"],
    }
    assert str(got["half"]["fare_amount"]) == "12.35"
    bad = declared.refused_rows(df, "silver_ride")
    assert bad.columns == [*df.columns, "refused"]
    assert {r["ride_id"]: r["fare_amount"] for r in bad.collect()}["wide"] == 1e9
    # A required column that is not there.
    none = declared.gate(df.drop("currency"), "silver_ride").collect()
    assert all("currency_missing" in r["refused"] for r in none)


def test_refused_rows_keep_the_plan_small(spark):
    """The filter on the codes stays above them: moved down, every expression would be written out again."""
    from ridelake.operators.bronze import bronze_ride

    raw = spark.createDataFrame([ride()], schemas.RAW["ride"]).select(
        *(F.col(n).cast("string").alias(n) for n in ride())
    )
    df = normalise_ride(bronze_ride(raw), checks=True)

    def size(out):
        return len(out._jdf.queryExecution().optimizedPlan().toString())

    assert size(declared.refused_rows(df, "silver_ride")) < 1.5 * size(declared.gate(df, "silver_ride"))


def test_aggregates_are_made_once_for_both_passes(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def seen(city):
        made.add(1)
        return city

    df = spark.createDataFrame(
        [(dt.date(2026, 5, 1), c, 3, 2, 10.5, 3.5, 1.25) for c in ("LA", "NY", None)],
        "date date, name string, total_rides int, completed_rides int, total_revenue double, "
        "avg_fare double, avg_distance_km double",
    ).withColumn("city", F.udf(seen).asNondeterministic()("name")).drop("name")
    try:
        held, refused = declared.load_declared(df, "gold_city_metrics", "made_once", str(tmp_path / "refused"))
    finally:
        tables.reset_tables(spark, ["made_once"])
    assert (held.record_count, refused, made.value) == (2, 1, 3)


def test_declared_tables_replace_only_their_partitions(spark, tmp_path):
    def passengers(*rows):
        kinds = "passenger_id string, first_name string, last_name string, email string, phone string, signup_date date, city string, country string, status string"
        full = [(i, "a", "b", "e", "p", None, city, country, status) for i, city, country, status in rows]
        return spark.createDataFrame(full, kinds)

    def load(df):
        return declared.load_declared(df, "silver_passenger", "gated_passenger", str(tmp_path / "refused"))

    first = passengers(("1", "NY", "US", "x"), ("2", "NY", "US", "x"), ("3", "", "US", "x"), ("4", "LA", "US", None))
    made, refused = load(first)
    assert (made.record_count, refused) == (3, 1)
    bad = spark.read.parquet(str(tmp_path / "refused")).collect()
    assert [(r["passenger_id"], r["refused"]) for r in bad] == [("4", ["status_missing"])]
    made, refused = load(passengers(("5", "NY", "US", "x"), ("6", "LA", "US", "x")))
    assert (made.record_count, refused) == (3, 0)
    held = declared.read_declared(spark, "silver_passenger", "gated_passenger")
    assert sorted((r["passenger_id"], r["city"]) for r in held.collect()) == [("3", ""), ("5", "NY"), ("6", "LA")]
    assert held.columns == declared.declared_schema("silver_passenger").names
    tables.reset_tables(spark, ["gated_passenger"])


def test_the_run_into_declared_tables(spark, tmp_path):
    frames = raw_frames(spark)
    frames["payment"] = frames["payment"].withColumn("amount", F.expr("IF(payment_id = 'M3', 1e9D, amount)"))
    files.land_all(frames, str(tmp_path / "raw"), "2026-05-01")
    cfg = LayerConfig(str(tmp_path / "raw"), str(tmp_path / "bronze"), "ddl_", style="records", declared=True)
    held = {r[0]: r[1] for layer in run_layers(spark, cfg).values() for r in layer.collect()}
    assert held["payment"] == 39 and held["ride_daily_metrics"] == held["city_metrics"]
    assert [r["refused"] for r in spark.read.parquet(f"{cfg.bronze_dir}/refused_silver_payment").collect()] == [["amount_unfit"]]
    kinds = dict(spark.table("ddl_silver_ride").dtypes)
    assert kinds["fare_amount"] == "decimal(8,2)" and kinds["request_time_day"] == "date"
    assert {r["valid_record"] for r in spark.table("ddl_silver_payment").collect()} == {True}
    for layer in ("silver", "gold"):
        tables.reset_tables(spark, [r["tableName"] for r in tables.list_layer(spark, layer, "ddl_").collect()])
    with pytest.raises(ValueError):
        LayerConfig("a", "b", declared=True)


def test_shared_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark), shared_folder(spark)
    assert first.startswith(base) and first != second


@pytest.mark.parametrize("style", ["jobs", "notebooks", "records"])
def test_run_layers(spark, tmp_path, style):
    raw = str(tmp_path / "raw")
    files.land_all(raw_frames(spark), raw, "2026-05-01")
    cfg = LayerConfig(raw, str(tmp_path / "bronze"), f"{style}_", style=style)
    for _ in range(2 if style == "jobs" else 1):  # a second run replaces the first
        counts = run_layers(spark, cfg)
        got = {layer: {r[0]: r[1] for r in df.collect()} for layer, df in counts.items()}
        assert got["bronze"] == dict.fromkeys(schemas.ENTITIES, 40)
        if style == "records":
            assert got["silver"] == dict.fromkeys(schemas.ENTITIES, 40)
            assert got["gold"]["ride_daily_metrics"] == got["gold"]["city_metrics"]
        else:
            assert got["silver"]["passenger"] == 39 and got["silver"]["driver"] == 30
            # Completed with a positive distance; row i carries ride id i % 30.
            assert got["silver"]["ride"] == len({i % 30 for i in range(1, 40) if i % 7})
            assert got["gold"]["passenger_activity"] == 5


def test_an_empty_silver_table_stops_the_run(spark, tmp_path):
    frames = raw_frames(spark)
    frames["payment"] = frames["payment"].withColumn("amount", frames["payment"]["amount"] * 0)
    files.land_all(frames, str(tmp_path / "raw"), "2026-05-01")
    cfg = LayerConfig(str(tmp_path / "raw"), str(tmp_path / "bronze"), "empty_")
    with pytest.raises(RuntimeError, match="silver has no rows in payment"):
        run_layers(spark, cfg)
    assert tables.list_layer(spark, "gold", "empty_").count() == 0
    names = [r["tableName"] for r in tables.list_layer(spark, "silver", "empty_").collect()]
    assert len(names) == 5
    tables.reset_tables(spark, names)


def landed_payments(tmp_path, lines):
    place = tmp_path / "raw/payment/ingestion_date=2026-05-02"
    place.mkdir(parents=True, exist_ok=True)
    (place / "payments.jsonl").write_text("\n".join(lines) + "\n")
    return str(tmp_path / "raw")


GOOD = '{"payment_id":"M1","ride_id":"R1","amount":"3.5","payment_status":"completed"}'
BAD_LINES = [
    '{"payment_id": "PM1", "amo', "no json", "null", "[]", f"[{GOOD}]", "5", '"text"',
    f"{GOOD} trailing", f"{GOOD}{GOOD}", f"{GOOD},{GOOD}", f"{GOOD}] {GOOD}", f"{GOOD},",
    f'{GOOD},{{"_end":"1"}}] x', f"{GOOD} // why",
]


def test_text_behind_a_record_is_not_lost(spark, tmp_path):
    kept = [GOOD, f"  {GOOD}  ", "{}", '{"_end":"x","payment_id":"M2"}', '{"payment_id":{"a":1}}']
    raw = landed_payments(tmp_path, [*kept, "", "   ", *BAD_LINES])
    lines = files.malformed_lines(spark, raw, "payment")
    assert sorted(r["line"] for r in lines.collect()) == sorted(BAD_LINES)
    ids = [r["payment_id"] for r in files.read_raw(spark, raw, "payment").collect()]
    assert sorted(map(str, ids)) == sorted(["M1", "M1", "None", "M2", '{"a":1}'])


@pytest.mark.parametrize("project", [True, False])
def test_routed_lines_are_parsed_once(spark, tmp_path, project):
    invalid = ['{"payment_id":"M3","ride_id":"R1","amount":"x"}', '{"payment_id":"M4"}']
    raw = landed_payments(tmp_path, [GOOD, *invalid, *BAD_LINES])
    df = files.routed(spark, raw, "payment", project)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and "Exchange" not in plan
    assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    made = files.write_routed(spark, raw, str(tmp_path / "out"), "payment", project, verify=True)
    assert made.record_count == 3
    got = {d: files.read_routed(spark, str(tmp_path / "out"), "payment", d).collect()
           for d in (files.VALID, files.INVALID, files.MALFORMED)}
    assert [(r["payment_id"], r["amount"], r["errors"], r["line"]) for r in got["valid"]] == [("M1", 3.5, None, None)]
    missing = 0.0 if project else None
    assert {r["payment_id"]: r["amount"] for r in got["invalid"]} == {"M3": None, "M4": missing}
    assert all(r["errors"] and r["error_codes"] and r["line"] is None for r in got["invalid"])
    assert sorted(r["line"] for r in got["malformed"]) == sorted(BAD_LINES)
    assert all(r["payment_id"] is None and r["amount"] is None and r["errors"] is None for r in got["malformed"])
    back = files.read_bronze(spark, str(tmp_path / "out"), "payment")
    assert back.columns == [c.split()[0] for c in schemas.RAW["payment"].split(", ")]
    assert sorted(r["payment_id"] for r in back.collect()) == ["M1", "M3", "M4"]


def test_the_run_routes_malformed_lines(spark, tmp_path):
    raw = str(tmp_path / "raw")
    files.land_all(raw_frames(spark), raw, "2026-05-01")
    landed_payments(tmp_path, BAD_LINES)
    cfg = LayerConfig(raw, str(tmp_path / "bronze"), "bad_")
    contents = run_layers(spark, cfg)
    assert {r[0]: r[1] for r in contents["bronze"].collect()}["payment"] == 40
    lines = files.read_routed(spark, cfg.bronze_dir, "payment", files.MALFORMED)
    assert sorted(r["line"] for r in lines.collect()) == sorted(BAD_LINES)
    for layer in ("silver", "gold"):
        tables.reset_tables(spark, [r["tableName"] for r in tables.list_layer(spark, layer, "bad_").collect()])


def test_a_changed_value_stops_the_run(spark, tmp_path, monkeypatch):
    files.land_all(raw_frames(spark), str(tmp_path / "raw"), "2026-05-01")
    cfg = LayerConfig(str(tmp_path / "raw"), str(tmp_path / "bronze"), "changed_")
    real = tables.digest

    def changed(df):
        if "rating" in df.columns:
            df = df.withColumn("rating", F.when(F.col("driver_id") == "D1", 4.0).otherwise(F.col("rating")))
        return real(df)

    monkeypatch.setattr(tables, "digest", changed)
    with pytest.raises(RuntimeError, match="changed_silver_driver does not hold what was written"):
        run_layers(spark, cfg)
    # The version that differs was not published, and nothing after it was begun.
    have = {r["tableName"] for r in tables.list_layer(spark, "silver", "changed_").collect()}
    assert have == {"changed_silver_passenger"}
    assert tables.list_layer(spark, "gold", "changed_").count() == 0
    tables.reset_tables(spark, have)


def test_digest(spark):
    kind = "a string, b double, c map<string, boolean>, d struct<x: double, y: string>, e array<int>, f timestamp_ntz"
    when = dt.datetime(2026, 5, 1, 10)
    rows = [
        ("x", 0.1, {"p": True, "q": False}, (1.0, "y"), [1, None], when),
        (None, None, None, None, None, None),
        ("", 1e30, {}, (None, None), [], when),
        ("xx", float("inf"), {"p": None}, (float("nan"), ""), [12], None),
    ]

    def of(rows):
        return tuple(digest(spark.createDataFrame(rows, kind)).first())

    whole = of(rows)
    assert whole[0] == 4 and of(rows[::-1]) == whole
    assert of([]) == (0, 0, 0)
    assert of(rows + rows) == tuple(2 * x for x in whole)
    changes = [
        ("x", 0.1 + 2**-55, *rows[0][2:]), ("x", 0.1, {"p": True, "q": True}, *rows[0][3:]),
        ("x", 0.1, rows[0][2], (1.0, None), *rows[0][4:]), ("x", 0.1, rows[0][2], (None, "y"), *rows[0][4:]),
        ("x", 0.1, rows[0][2], rows[0][3], [1, 0], when), ("x", 0.1, rows[0][2], rows[0][3], [1], when),
        ("x", 0.1, *rows[0][2:5], dt.datetime(2026, 5, 1, 11)), ("", *rows[0][1:]),
    ]
    assert len({of([c, *rows[1:]]) for c in changes} | {whole}) == len(changes) + 1
    assert of([("", 1e30, *rows[2][2:])]) != of([("", 2e30, *rows[2][2:])])


def test_a_failing_rewrite_leaves_the_table(spark):
    df = raw_frames(spark)["ride"]
    tables.write_table(df, "steady", "pickup_city")
    before = tables.read_table(spark, "steady")  # planned on the version of now
    failing = df.withColumn("fare_amount", F.expr("IF(ride_id = 'R7', raise_error('no'), 1.0D)"))
    with pytest.raises(Exception, match="no"):
        tables.write_table(failing, "steady", "pickup_city")
    assert tables.read_table(spark, "steady").count() == 40
    made = tables.write_table(df.limit(5), "steady", "pickup_city", verify=True)
    assert made.record_count == 5 and tables.read_table(spark, "steady").count() == 5
    # A query that began on the old version still finds it, until versions are expired.
    assert before.count() == 40
    assert len(tables.expire_versions(spark, "steady")) == 1
    assert tables.expire_versions(spark, "steady") == []
    assert tables.read_table(spark, "steady").count() == 5
    # Other columns, other partitions.
    tables.write_table(df.select("ride_id", "fare_amount"), "steady", verify=True)
    assert tables.read_table(spark, "steady").columns == ["ride_id", "fare_amount"]
    tables.write_table(df.limit(0), "steady", "pickup_city", verify=True)
    assert tables.read_table(spark, "steady").count() == 0
    place = tables._details(spark, "steady")["Location"].rsplit("/", 1)[0]
    tables.reset_tables(spark, ["steady"])
    from ridelake.sources.scratch import subfolders

    assert subfolders(spark, place) == []


def test_a_given_location_outlives_its_table(spark, tmp_path):
    df = raw_frames(spark)["driver"]
    tables.write_table(df, "placed", location=str(tmp_path / "placed"))
    tables.reset_tables(spark, ["placed"])
    assert spark.read.parquet(str(next((tmp_path / "placed").glob("v-*")))).count() == 40


def test_list_layer_in_a_database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS lake_db")
    spark.range(3).write.saveAsTable("lake_db.x_silver_ride")
    assert [r["tableName"] for r in tables.list_layer(spark, "silver", "lake_db.x_").collect()] == ["x_silver_ride"]
    assert tables.list_layer(spark, "silver", "lake_db.").count() == 0
    spark.sql("DROP DATABASE lake_db CASCADE")


def test_run_stops_at_the_first_failure(spark, tmp_path):
    frames = raw_frames(spark)
    del frames["vehicle"]
    files.land_all(frames, str(tmp_path / "raw"), "2026-05-01")
    cfg = LayerConfig(str(tmp_path / "raw"), str(tmp_path / "bronze"), "stop_")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        run_layers(spark, cfg)
    assert tables.list_layer(spark, "stop").count() == 0
    with pytest.raises(ValueError):
        LayerConfig("a", "b", style="other")


def test_digest_makes_each_text_once(spark):
    """Texts of maps and arrays, made by lambdas, stand once in the plan, and are those of their values."""
    import hashlib

    kind = "flag boolean, words array<string>, checks map<string, boolean>, place struct<open: boolean, at: map<string, string>>"
    rows = [
        (True, ["a", None, ""], {"late": False, "far": True, "": None}, (None, {"b": None, "a": "x"})),
        (False, [], {}, (True, None)),
        (None, ["v1:a"], None, None),
    ]
    df = spark.createDataFrame(rows, kind)

    def mark(text):
        return "n" if text is None else f"v{len(text)}:{text}"

    def word(flag):
        return None if flag is None else str(flag).lower()

    def pairs(values, text):
        if values is None:
            return None
        return "".join(mark(mark(k) + mark(text(values[k]))) for k in sorted(values))

    def line(flag, words, checks, place):
        at = None if place is None else mark(word(place[0])) + mark(pairs(place[1], lambda t: t))
        return mark(word(flag)) + mark("".join(map(mark, words))) + mark(pairs(checks, word)) + mark(at)

    hashes = [hashlib.md5(line(*r).encode()).hexdigest() for r in rows]
    want = (3, sum(int(h[:6], 16) for h in hashes), sum(int(h[6:12], 16) for h in hashes))
    assert tuple(digest(df).first()) == want
    plan = digest(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("map_entries(checks") == 1


def test_rows_that_fit_build_no_codes(spark):
    kind = "payment_id string, ride_id string, payment_time string, payment_method string, amount double, currency string, payment_status string"
    fits = ("P", "R", "2026-01-01T00:00:00", "cash", 1.0, "USD", "completed")
    out = declared.gate(spark.createDataFrame([fits, (None, "R", "soon", "cash", 1e12, "USD", "completed")], kind), "silver_payment")
    assert "ELSE [] END AS refused" in out._jdf.queryExecution().optimizedPlan().toString()
    assert [r["refused"] for r in out.collect()] == [[], ["payment_id_missing", "payment_time_unfit", "amount_unfit"]]
    without = spark.createDataFrame([("r", "1")], "payment_id string, amount string")
    assert "ride_id_missing" in declared.gate(without, "silver_payment").first()["refused"]
