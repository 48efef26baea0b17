from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tierweave import functions as fn
from tierweave.operators import cleaning
from tierweave.plans.tables import BRONZE, SILVER, SOURCE
from tierweave.sources.incremental import DateWindow
from tierweave.sources.lookups import static_lookups
from tierweave.sources.readers import read_documents


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_text_and_number_defaults(spark):
    row = one(
        spark,
        fn.normal(F.lit("  MiXed ")).alias("text"),
        fn.normal(F.lit(None).cast("string"), "unknown").alias("default"),
        fn.normal(F.lit(None).cast("string")).alias("none"),
        fn.zero_if_null(F.lit(None).cast("decimal(38,2)"), fn.MONEY).alias("zero"),
    )
    assert tuple(row) == ("mixed", "unknown", None, Decimal("0.00"))


def test_discount_rounds_half_up_and_stays_decimal(spark):
    df = spark.sql("SELECT CAST(10.05 AS DECIMAL(18,2)) AS p, CAST(0.10 AS DECIMAL(18,2)) AS d")
    out = df.select(fn.discounted("p", "d").alias("final"))
    assert out.schema["final"].dataType.simpleString() == fn.MONEY
    assert out.first().final == Decimal("9.05")


def test_share_of_nothing_is_null(spark):
    assert one(spark, fn.share(F.lit(1), F.lit(0), 4).alias("x")).x is None
    assert one(spark, fn.share(F.lit(1), F.lit(3), 4).alias("x")).x == 0.3333


def test_calendar(spark):
    sunday, saturday, monday = (F.lit(d).cast("timestamp") for d in ("2024-01-07", "2024-01-06", "2024-01-08"))
    row = one(
        spark,
        fn.weekday(sunday).alias("a"),
        fn.weekday(saturday).alias("b"),
        fn.is_weekend(sunday).alias("c"),
        fn.is_weekend(monday).alias("d"),
        fn.booking_lead_days(monday, saturday).alias("e"),
        fn.booking_lead_days(saturday, monday).alias("f"),
    )
    assert tuple(row) == (1, 7, True, False, 2, 0)


def test_elapsed_takes_times_without_zone(spark):
    start, end = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), F.lit("2024-01-02 12:00:00").cast("timestamp_ntz")
    row = one(spark, fn.elapsed(start, end, "hours").alias("h"), fn.elapsed(end, start, "days").alias("d"))
    assert tuple(row) == (36.0, -1.5)


def test_surrogate_key_is_stable_and_not_negative(spark):
    df = spark.range(2000).select("id", fn.surrogate_key("id", F.lit("x")).alias("k"))
    assert df.where("k < 0").count() == 0
    assert df.select("k").distinct().count() == 2000


def test_bronze_cast_renames_types_and_tolerates_bad_text(spark):
    source = spark.createDataFrame(
        [(1, "n", "t", 5, "2024-01-01T09:00:00Z", "nonsense")], SOURCE["trains"]
    )
    bronze = cleaning.bronze_cast(source)
    declared = spark.createDataFrame([], BRONZE["trains"]).schema
    assert [(f.name, f.dataType) for f in bronze.schema] == [(f.name, f.dataType) for f in declared]
    row = bronze.first()
    assert row.created_at == datetime(2024, 1, 1, 9) and row.updated_at is None


def test_documents_keep_declared_fields_only(spark, tmp_path):
    path = tmp_path / "tickets.json"
    path.write_text('{"_id": 1, "ticket_id": "T", "payment": {"method": "cash", "location": "x"}, "note": 1}\n')
    df = read_documents(spark, SOURCE["tickets"], str(path))
    assert df.columns == [f.name for f in spark.createDataFrame([], SOURCE["tickets"]).schema]
    assert df.first().payment.asDict() == {"method": "cash", "bank": None, "provider": None}


def test_document_arrays(spark, tmp_path):
    path = tmp_path / "stations.json"
    path.write_text('[{"_id": 1, "name": "A"},\n {"_id": 2, "name": "B"}]')
    df = read_documents(spark, SOURCE["stations"], str(path), options={"multiLine": "true"})
    assert rows(df, "_id", "name") == [(1, "A"), (2, "B")]


def _dimension(spark, name, *values):
    return spark.createDataFrame(list(values), BRONZE[name])


AT = datetime(2024, 1, 1)


def test_silver_dimensions_have_their_declared_schema(spark):
    made = {
        "passengers": cleaning.silver_passengers(
            _dimension(spark, "passengers", (1, " Ann ", None, " 123 ", "A@B.C ", AT, AT), (1, " Ann ", None, " 123 ", "A@B.C ", AT, AT))
        ),
        "trains": cleaning.silver_trains(_dimension(spark, "trains", (1, "X", None, None, AT, AT))),
        "stations": cleaning.silver_stations(_dimension(spark, "stations", (1, "S", None, " JKT", AT, AT))),
    }
    for name, df in made.items():
        declared = spark.createDataFrame([], SILVER[name]).schema
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in declared], name
    assert rows(made["passengers"].drop("sk_id")) == [(1, "ann", "unknown", "123", "a@b.c", True, AT, None)]
    assert rows(made["trains"].drop("sk_id")) == [(1, "x", "unknown", 0, True, AT, None)]
    assert rows(made["stations"].drop("sk_id")) == [(1, "s", "unknown", "jkt", False)]


def test_overwritten_dimensions_keep_the_last_version_of_a_batch(spark):
    later = datetime(2024, 1, 2)
    stations = _dimension(spark, "stations", (1, "new", None, "x", later, AT), (1, "zz old", None, "x", AT, AT), (2, "b", None, "y", None, AT))
    assert rows(cleaning.silver_stations(stations), "id", "name") == [(1, "new"), (2, "b")]
    routes = _dimension(spark, "routes", (1, "a", "b", 1, 9, 9, AT, AT), (1, "a", "c", 1, None, 8, later, AT))
    assert rows(cleaning.normal_routes(routes).drop("sk_id")) == [(1, "a", "c", 1, 0, 8, False)]


def test_window_is_half_open_and_may_be_empty(spark):
    df = spark.sql("SELECT explode(sequence(timestamp'2024-01-01', timestamp'2024-01-04', interval 12 hours)) AS t")
    kept = DateWindow("2024-01-02", "2024-01-03").apply(df, "t")
    assert rows(kept) == [(datetime(2024, 1, 2),), (datetime(2024, 1, 2, 12),)]
    assert DateWindow("2024-01-02", "2024-01-02").apply(df, "t").isEmpty()
    with pytest.raises(ValueError):
        DateWindow("2024-01-03", "2024-01-02")
    assert DateWindow(datetime(2024, 1, 2, 9), date(2024, 1, 3)).start == date(2024, 1, 2)


def test_text_window_with_padded_dates_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    texts = ["2024-01-01T23:30:00-01:00", "2024-01-02T00:00:00Z", "2024-01-03T01:00:00+02:00", "2024-01-03T00:00:00Z", "2024-01-09", None]
    spark.createDataFrame([(t,) for t in texts], "at STRING").write.parquet(path)
    stored = spark.read.schema("at STRING").parquet(path)
    window = DateWindow("2024-01-02", "2024-01-03")
    padded = window.apply(stored, "at", text=True, padded=True)
    assert rows(padded) == rows(window.apply(stored, "at", text=True)) == [(t,) for t in texts[:3]]
    plan = padded._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(at,2024-01-01)" in plan and "LessThan(at,2024-01-04)" in plan


def test_window_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT 1 AS id, timestamp'2024-01-02' AS t, date'2024-01-02' AS t_day").write.partitionBy("t_day").parquet(path)
    stored = spark.read.schema("id INT, t TIMESTAMP, t_day DATE").parquet(path)
    plan = DateWindow("2024-01-01", "2024-01-05").apply(stored, "t", partition="t_day")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(t_day" in plan
    assert "GreaterThanOrEqual(t," in plan and "LessThan(t," in plan


def test_lookups(spark):
    made = static_lookups(spark)
    assert rows(made["status"]) == [(1, "paid"), (2, "unpaid"), (3, "cancelled"), (4, "refunded")]
    assert len(rows(made["class"])) == 4 and len(rows(made["payment"])) == 5
    for name, df in made.items():
        assert df.schema.simpleString() == spark.createDataFrame([], SILVER[name]).schema.simpleString()
