"""Hand-made change events with known results."""

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import json_text
from tidemark.operators import cleanse


def order(products, **fields):
    """An envelope whose json columns are text, as the capture connector sends them."""
    after = {
        "order_number": 1,
        "customer_id": 7,
        "customer_name": "Ann",
        "order_datetime": "1534928698",
        "number_of_line_items": 1,
        "clicked_items": json.dumps([["p", "3"]]),
        "promo_info": "[]",
        "ordered_products": products if products is None else json.dumps(products),
    }
    return envelope({**after, **fields})


def envelope(after, op="c"):
    payload = {"before": None, "after": after, "op": op, "ts_ms": 1}
    return json.dumps({"schema": {}, "payload": payload})


def product(name="disk", price=5, **fields):
    return {"curr": "USD", "id": "p", "name": name, "price": price, "qty": 2, "unit": "pcs", **fields}


def lines(spark, values, mode="nested", **options):
    frame = spark.createDataFrame([(v,) for v in values], "value string")
    return cleanse.cleanse_orders(frame, mode=mode, **options).collect()


@pytest.mark.parametrize("mode", ["nested", "strip"])
@pytest.mark.parametrize(
    "value, rows",
    [
        (order([product(), product(id="q")]), 2),
        (envelope(None, op="d"), 0),
        (None, 0),
        ("not json", 0),
        ("", 0),
        (order([]), 0),
        (order(None), 0),
        (order([product()])[:-40], 0),
    ],
)
def test_rows_per_order_event(spark, mode, value, rows):
    assert len(lines(spark, [value], mode)) == rows


@pytest.mark.parametrize("mode", ["nested", "strip"])
def test_line_columns(spark, mode):
    promotion = {"promo_id": 4, "promo_qty": 1, "promo_disc": 0.25, "promo_item": "p"}
    (row,) = lines(spark, [order([product(promotion_info=promotion)])], mode)
    assert row.__fields__ == schemas.ORDER_LINE.names
    assert (row.order_number, row.customer_id, row.customer_name) == (1, 7, "Ann")
    assert row.order_datetime == "2018-08-22 09:04:58"
    assert (row.product_id, row.unit_price, row.quantity) == ("p", 5, 2)
    assert row.ordered_products.promotion_info.promo_disc == Decimal("0.25")
    assert row.clicked_items == [["p", "3"]]
    assert row.promo_info == []


@pytest.mark.parametrize(
    "event, name, customer",
    [
        (order([product("[x] y")]), "[x] y", "Ann"),
        (order([product('5" disk')]), '5" disk', "Ann"),
        (order([product()], customer_name="A [B]"), "disk", "A [B]"),
        (order([product('5" [x]')], customer_name="A [B]"), '5" [x]', "A [B]"),
    ],
)
def test_quotes_and_brackets_survive_only_in_nested_mode(spark, event, name, customer):
    (row,) = lines(spark, [event])
    assert (row.ordered_products.name, row.customer_name) == (name, customer)
    assert lines(spark, [event], "strip") == []


def test_newline_in_a_name(spark):
    event = order([product()], customer_name="é\nz")
    assert lines(spark, [event])[0].customer_name == "é\nz"
    assert lines(spark, [event], "strip")[0].customer_name == "énz"


@pytest.mark.parametrize("mode", ["nested", "strip"])
def test_fraction_in_an_int_field_keeps_the_row(spark, mode):
    (row,) = lines(spark, [order([product(price=7.5)])], mode)
    assert (row.unit_price, row.quantity) == (None, 2)


@pytest.mark.parametrize("seconds", ["", "soon", None])
def test_unreadable_datetime_is_null(spark, seconds):
    assert lines(spark, [order([product()], order_datetime=seconds)])[0].order_datetime is None


def test_arrays_that_are_not_quoted(spark):
    plain = order([product()]).replace('\\"', '"').replace('"[', "[").replace(']"', "]")
    for mode in ("nested", "strip"):
        assert lines(spark, [plain], mode)[0].product_id == "p"


def test_null_product_in_the_array_keeps_its_row(spark):
    for mode in ("nested", "strip"):
        rows = lines(spark, [order([product(), None])], mode)
        assert [r.product_id for r in rows] == ["p", None]


def test_column_choice(spark):
    (row,) = lines(spark, [order([product()])], columns=["quantity", "customer_id"])
    assert row.asDict() == {"quantity": 2, "customer_id": 7}
    with pytest.raises(ValueError):
        lines(spark, [order([product()])], columns=["colour"])
    with pytest.raises(ValueError):
        lines(spark, [order([product()])], mode="other")


CUSTOMER = {"customer_id": 1, "customer_name": "Ann", "lon": -83.1629844, "loyalty_segment": 0}


def customers(spark, values, **options):
    frame = spark.createDataFrame([(v,) for v in values], "value string")
    return cleanse.cleanse_customers(frame, **options).collect()


def test_customer_values(spark):
    (row,) = customers(spark, [envelope(CUSTOMER)])
    assert row.__fields__ == schemas.CUSTOMER.names
    assert row.lon == Decimal("-83.162984")
    assert row.loyalty_segment == "0"
    (row,) = customers(spark, [envelope({"customer_id": 1, "lon": 123456.5})])
    assert (row.customer_id, row.lon, row.customer_name) == (1, None, None)


def test_number_in_a_text_field_reads_as_in_the_after_image(spark):
    value = envelope(CUSTOMER).replace('"loyalty_segment": 0', '"tax_id": 340758025.0')
    frame = spark.createDataFrame([(value,)], "value string")
    text = json_text.json_field(json_text.after_image(F.col("value")), "tax_id")
    assert customers(spark, [value])[0].tax_id == frame.select(text).first()[0]


def test_deletes_and_tombstones(spark):
    values = [envelope(CUSTOMER), envelope(None, op="d"), None, "not json"]
    assert [r.customer_id for r in customers(spark, values)] == [1]
    kept = customers(spark, values, keep_null_rows=True)
    assert sorted((r.customer_id for r in kept), key=str) == [1, None, None, None]


def test_product_id_padding(spark):
    after = {"product_id": "AB12                ", "ean13": 2198122549930.0}
    frame = spark.createDataFrame([(envelope(after),)], "value string")
    (row,) = cleanse.cleanse_products(frame).collect()
    assert (row.product_id, row.ean13) == ("AB12", 2198122549930.0)


def test_each_message_is_parsed_once(spark, tmp_path):
    spark.createDataFrame([(order([product()]),)], "value string").write.parquet(f"{tmp_path}/m")
    frame = spark.read.parquet(f"{tmp_path}/m")
    for rows, parses in [
        (cleanse.cleanse_orders(frame, columns=["order_number", "quantity"]), 2),
        (cleanse.cleanse_orders(frame, columns=["order_number"], mode="strip"), 1),
        (cleanse.cleanse_customers(frame), 1),
    ]:
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json(") == parses
        assert "Exchange" not in plan and "Python" not in plan


def test_only_needed_fields_are_parsed(spark):
    frame = spark.createDataFrame([(order([product()]),)], "value string")
    rows = cleanse.cleanse_orders(frame, columns=["order_number", "quantity"])
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "clicked_items" not in plan and "promo" not in plan and "curr" not in plan
    assert rows.where(F.col("quantity") == 2).count() == 1
