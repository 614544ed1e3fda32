"""Times the headline queries; prints one JSON line.

Change events are derived from the base tables once and written as files, so
the times below cover the library and not the making of its input.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
import uuid

from pyspark.sql import functions as F

from tidemark.functions.decimals import decode_scaled_decimal
from tidemark.operators import cleanse, facts, raw
from tidemark.operators.keys import assign_keys
from tidemark.plans import replay
from tidemark.plans.retail import retail_datasets
from tidemark.session import build_session
from tidemark.sources.bus import CAPTURED_TABLES, message_batch, message_stream
from tidemark.streaming.lake import Lake

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
SALES = ["order_number", "customer_id", "order_datetime", "product_id", "unit_price", "quantity"]


def main() -> None:
    work = tempfile.mkdtemp(prefix="tidemark-bench-")
    spark = build_session(
        "tidemark-bench",
        f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory="12g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=f"{work}/shared",
        spark__sql__warehouse__dir=f"{work}/warehouse",
    )
    spark.sparkContext.setLogLevel("ERROR")

    make = {
        "sales_orders": replay.order_messages,
        "customers": replay.customer_messages,
        "products": replay.product_messages,
    }
    paths = {t: f"{work}/bus/{t}" for t in CAPTURED_TABLES}

    def write_messages():
        for t in CAPTURED_TABLES:
            make[t](spark, FOLDER).select("key", "value").write.mode("overwrite").parquet(paths[t])

    def messages(t):
        return raw.as_text(message_batch(spark, "parquet", {}, path=paths[t]))

    def lines():
        return cleanse.cleanse_orders(messages("sales_orders"), columns=SALES)

    def products():
        return cleanse.cleanse_products(messages("products"))

    def customers():
        return cleanse.cleanse_customers(messages("customers"))

    def dim_products():
        return assign_keys(
            products(), "product_key", order_by=["product_id"], stable_input=True
        )

    def dim_customers():
        return assign_keys(
            customers(), "customer_key", order_by=["customer_id"], stable_input=True
        )

    def fact():
        return facts.fact_sales_orders(lines(), dim_products(), dim_customers())

    def stream_lake():
        # A lake of its own each time, so no run finds anything done.
        sources = {
            t: (lambda s, t=t: message_stream(s, "parquet", {}, path=paths[t]))
            for t in CAPTURED_TABLES
        }
        root, database = f"{work}/lake-{uuid.uuid4().hex}", f"bench_{uuid.uuid4().hex}"
        lake = Lake(spark, root, database, retail_datasets(sources))
        lake.update()
        return lake.read("customer_sales")

    queries = {
        "cleansed_orders_nested": lambda: cleanse.cleanse_orders(messages("sales_orders")),
        "cleansed_orders_strip": lambda: cleanse.cleanse_orders(
            messages("sales_orders"), mode="strip"
        ),
        "cleansed_sales_columns": lines,
        "cleansed_customers": customers,
        "decoded_prices": lambda: products().select(
            "product_id", decode_scaled_decimal(F.col("sales_price"), 2).alias("sales_price")
        ),
        "dim_customers": dim_customers,
        "identity_order_lines": lambda: assign_keys(lines(), "id"),
        "fact_customer_sales": lambda: facts.fact_customer_sales(lines(), products(), customers()),
        "fact_sales_orders": fact,
        "customer_sales": lambda: facts.customer_sales(fact()),
        "streams_update_all_tables": stream_lake,
    }

    def timed(run) -> float:
        begin = time.perf_counter()
        frame = run()
        if frame is not None:
            frame.write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - begin, 3)

    seconds = {}
    print("write_change_messages", timed(write_messages), file=sys.stderr)
    for name, run in queries.items():
        # The first run warms the JVM up.
        runs = 2 if name.startswith("streams") else 3
        seconds[name] = min(timed(run) for _ in range(runs))
        print(name, seconds[name], file=sys.stderr)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
