"""Message sources, flat files and change encoding."""

import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.changes import encode_changes, tombstones
from tidemark.operators import raw
from tidemark.session import scratch_root
from tidemark.sources import bus, flat_files


def test_bus_options():
    options = bus.bus_options(
        "host:9093",
        [bus.topic_name(t) for t in bus.CAPTURED_TABLES],
        sasl_jaas_config="from the caller",
        maxOffsetsPerTrigger=1000,
    )
    assert options == {
        "kafka.bootstrap.servers": "host:9093",
        "subscribe": "retail.public.sales_orders,retail.public.customers,retail.public.products",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.jaas.config": "from the caller",
        "kafka.request.timeout.ms": "60000",
        "kafka.session.timeout.ms": "60000",
        "failOnDataLoss": "false",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "1000",
    }
    plain = bus.bus_options("host:9092", "t", starting_offsets="latest", fail_on_data_loss=True)
    assert not any("sasl" in name or "protocol" in name for name in plain)
    assert (plain["subscribe"], plain["failOnDataLoss"], plain["startingOffsets"]) == (
        "t", "true", "latest",
    )


def test_message_view_and_limit(spark, tmp_path):
    rows = spark.range(9).select(F.col("id").cast("string").alias("key"), F.lit("v").alias("value"))
    rows.write.json(f"{tmp_path}/m")
    schema = schemas.struct(key=schemas.STRING, value=schemas.STRING)
    options = {"path": f"{tmp_path}/m"}
    bus.message_batch(spark, "json", options, schema=schema, view="messages_now")
    assert spark.sql("SELECT * FROM messages_now LIMIT 5").count() == 5
    stream = bus.message_stream(spark, "json", options, schema=schema, view="messages_stream")
    assert stream.isStreaming and spark.table("messages_stream").isStreaming


def test_as_text_keeps_the_other_columns(spark):
    row = (b"k", "é".encode(), "t", 0, 5, None, 0)
    frame = spark.createDataFrame([row, (None,) * 7], schemas.BUS_MESSAGE)
    text = raw.as_text(frame)
    assert text.columns == schemas.BUS_MESSAGE.names
    assert [(r.key, r.value, r.offset) for r in text.collect()] == [("k", "é", 5), (None, None, None)]
    assert raw.only_topic(text, "t").count() == 1


def test_encoded_changes(spark):
    rows = spark.createDataFrame(
        [(1, "é\"", [1], "c"), (2, None, None, "d")], "id int, name string, items array<int>, op string"
    )
    got = encode_changes(
        rows, ["id"], op=F.col("op"), columns=rows.columns[:3], json_columns=["items"], topic="x.y"
    ).collect()
    first, second = [json.loads(r.value) for r in got]
    image = {"id": 1, "name": "é\"", "items": "[1]"}
    assert first["payload"] == {"before": None, "after": image, "op": "c"}
    assert first["schema"]["name"] == "x.y.Envelope"
    assert second["payload"]["after"] is None and second["payload"]["before"]["id"] == 2
    assert json.loads(got[0].key)["payload"] == {"id": 1} and got[0].topic == "x.y"
    (empty, _) = tombstones(rows, ["id"], topic="x.y").collect()
    assert empty.value is None and json.loads(empty.key)["payload"] == {"id": 1}


def test_json_lines(spark, tmp_path):
    path = tmp_path / "orders.json"
    path.write_text(
        '{"order_number": 5, "number_of_line_items": "2", "ordered_products": [{"id": "a, b"}], "x": 1}\n'
        '{"order_number": 70000, "clicked_items": "[]", "customer_name": "\\u00e9"}\n'
    )
    rows = flat_files.read_json_lines(spark, str(path), schemas.ORDER_FILE).orderBy("order_number")
    assert [f.dataType for f in rows.schema] == [f.dataType for f in schemas.ORDER_FILE]
    a, b = rows.collect()
    assert (a.order_number, a.number_of_line_items, a.ordered_products) == (5, 2, '[{"id": "a, b"}]')
    assert (b.clicked_items, b.customer_name, b.ordered_products) == ("[]", "é", None)


@pytest.mark.parametrize("text", ['{"order_number": "many"}\n', "not json\n"])
def test_bad_json_line(spark, tmp_path, text):
    path = tmp_path / "orders.json"
    path.write_text(text)
    with pytest.raises((PySparkException, Py4JJavaError)):
        flat_files.read_json_lines(spark, str(path), schemas.ORDER_FILE).collect()
    rows = flat_files.read_json_lines(spark, str(path), schemas.ORDER_FILE, on_error="null")
    assert rows.first().order_number is None
    with pytest.raises(ValueError):
        flat_files.read_json_lines(spark, str(path), schemas.ORDER_FILE, on_error="skip")


def test_csv(spark, tmp_path):
    path = tmp_path / "products.csv"
    path.write_text(
        "product_id;product_category;product_name;sales_price;EAN13;EAN5;product_unit\n"
        'A1;Tools;"5"" disk; blue";1574.05;2198122549930;00042;pcs\n'
        "A2;;;;;;\n"
    )
    a, b = flat_files.read_csv(spark, str(path), schemas.PRODUCT_FILE, delimiter=";").collect()
    assert (a.product_name, a.ean13, a.ean5) == ('5" disk; blue', 2198122549930.0, "00042")
    assert str(a.sales_price) == "1574.0500000000"
    assert b.product_id == "A2" and set(b[1:]) == {None}


def test_csv_with_a_bad_number(spark, tmp_path):
    path = tmp_path / "products.csv"
    path.write_text("a;b;c;d;e;f;g\nA1;T;N;dear;1;1;pcs\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        flat_files.read_csv(spark, str(path), schemas.PRODUCT_FILE, delimiter=";").collect()
    read = flat_files.read_csv(
        spark, str(path), schemas.PRODUCT_FILE, delimiter=";", on_error="null"
    )
    assert (read.first().product_id, read.first().sales_price) == ("A1", None)


def test_scratch_follows_the_cluster_setting(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_one_more_row(spark):
    """A literal row, captured and cleansed."""
    from tidemark.functions.decimals import decode_scaled_decimal, encode_scaled_decimal
    from tidemark.operators.cleanse import cleanse_customers

    row = spark.sql(
        "SELECT 100 AS customer_id, 'Ann' AS customer_name, CAST(-83.1629844 AS DOUBLE) AS lon, "
        "15740 AS units"
    ).withColumn("units_purchased", encode_scaled_decimal(F.col("units"), 1))
    message = encode_changes(row, ["customer_id"], topic="retail.public.customers")
    (got,) = cleanse_customers(raw.as_text(message)).withColumn(
        "units_purchased", decode_scaled_decimal(F.col("units_purchased"), 1)
    ).collect()
    assert (got.customer_id, got.customer_name, str(got.lon)) == (100, "Ann", "-83.162984")
    assert str(got.units_purchased) == "1574.0"


CSV_TEXT = schemas.struct(a=schemas.STRING, b=schemas.STRING, n=schemas.INT)


def test_csv_tells_empty_from_missing(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b,n\n"",,1\n,"",\n"x ""y""",z,3\n')
    rows = flat_files.read_csv(spark, str(tmp_path), CSV_TEXT).collect()
    assert list(map(tuple, rows)) == [("", None, 1), (None, "", None), ('x "y"', "z", 3)]


def test_csv_with_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b,n\n"two\nlines",,1\n"","p\n\nq",2\n')
    rows = flat_files.read_csv(spark, str(tmp_path), CSV_TEXT, multi_line=True).collect()
    assert list(map(tuple, rows)) == [("two\nlines", None, 1), ("", "p\n\nq", 2)]
