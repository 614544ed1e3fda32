"""Variable-scale decimals."""

from base64 import b64encode
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions.decimals import decode_scaled_decimal, encode_scaled_decimal


def pack(unscaled: int) -> str:
    size = 1
    while not -(1 << (8 * size - 1)) <= unscaled < 1 << (8 * size - 1):
        size += 1
    return b64encode(unscaled.to_bytes(size, "big", signed=True)).decode()


def decoded(spark, rows, scale=10):
    frame = spark.createDataFrame([(r,) for r in rows], "d struct<scale int, value string>")
    return [r[0] for r in frame.select(decode_scaled_decimal(F.col("d"), scale)).collect()]


@pytest.mark.parametrize(
    "scale, value, expected",
    [
        (1, "PXw=", "1574.0"),
        (0, "/w==", "-1"),
        (0, "gA==", "-128"),
        (0, "AA==", "0"),
        (2, "/zg=", "-2.00"),
        (-2, "Bw==", "700"),
        (0, pack(2**63), str(2**63)),
        (0, pack(-(2**63)), str(-(2**63))),
        (0, pack(2**64 + 5), str(2**64 + 5)),
        (3, pack(-(10**27) - 1), "-1000000000000000000000000.001"),
    ],
)
def test_decode(spark, scale, value, expected):
    assert decoded(spark, [(scale, value)]) == [Decimal(expected)]


def test_what_does_not_decode_is_null(spark):
    rows = [None, (None, "AA=="), (0, None), (0, ""), (0, "?"), (0, pack(2**127 - 1)), (0, pack(2**200))]
    assert decoded(spark, rows) == [None] * len(rows)


def test_digits_beyond_the_scale_round(spark):
    assert decoded(spark, [(3, pack(1234)), (3, pack(1235))], 2) == [Decimal("1.23"), Decimal("1.24")]


@pytest.mark.parametrize(
    "number, text",
    [(15740, "PXw="), (200, "AMg="), (7, "Bw=="), (1534928698, "W30nOg=="), (0, "AA=="), (-1, "/w==")],
)
def test_encode(spark, number, text):
    row = spark.range(1).select(encode_scaled_decimal(F.lit(number), 2).alias("d")).first()
    assert (row.d.scale, row.d.value) == (2, text)


def test_encode_null(spark):
    null = F.lit(None).cast("bigint")
    assert spark.range(1).select(encode_scaled_decimal(null, 2)).first()[0] is None


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(-(2**63), 2**63 - 1), min_size=200, max_size=200))
def test_round_trip(spark, numbers):
    edges = [s * (256**n // 2 + d) for n in range(1, 8) for s in (1, -1) for d in (-1, 0, 1)]
    numbers = numbers + edges
    frame = spark.createDataFrame([(n,) for n in numbers], "n bigint")
    rows = frame.select("n", encode_scaled_decimal(F.col("n"), 4).alias("d"))
    rows = rows.select("n", "d.value", decode_scaled_decimal(F.col("d"), 4).alias("back"))
    for row in rows.collect():
        assert row.value == pack(row.n)
        assert row.back == Decimal(row.n).scaleb(-4)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(-(10**27), 10**27), min_size=100, max_size=100))
def test_decode_wide(spark, numbers):
    got = decoded(spark, [(2, pack(n)) for n in numbers])
    assert got == [Decimal(n).scaleb(-2) for n in numbers]
