"""The retail lake: three captured tables to two dimensions and two facts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark import schemas
from tidemark.operators import cleanse, current, facts, incremental, raw
from tidemark.operators.expectations import Rule
from tidemark.streaming.lake import JOINED, KEYED, MERGED, ONCE, RECOMPUTED, STREAM, Dataset

GOLD = {"quality": "gold"}

Source = Callable[[SparkSession], DataFrame]


def retail_datasets(
    sources: Mapping[str, Source],
    *,
    order_mode: str = "nested",
    product_salt: int = 4,
    customer_salt: int = 4,
    read_options: Mapping[str, str] | None = None,
    keep_null_rows: bool = False,
    output_partitions: int | None = None,
    late: facts.Lateness | None = None,
    exactly_once: bool = False,
    order_rules: Sequence[Rule] = (),
) -> list[Dataset]:
    """All datasets, given a message source per captured table.

    ``sources`` maps ``sales_orders``, ``customers`` and ``products`` to a
    function that opens the stream of its messages.  ``keep_null_rows`` keeps an
    all-NULL row for each customer or product message without a row: deletes,
    tombstones, and messages that do not parse.

    Before the order-line fact starts, the lines that are there show which
    products and customers hold more than their share of rows, and over how many
    join partitions each has to spread.  The salts are for all other keys: every
    key spreads over so many partitions, at the price of as many copies of its
    dimension row in the join state.  A key that grows hot later stays on them
    until ``Lake.rebuild("fact_sales_orders")`` measures anew.

    ``read_options`` go to the reads of the tables.  ``maxBytesPerTrigger`` lets
    the filling of a lake from a long history go in steps that each commit, but
    surrogate keys then follow their order within each step only.
    ``output_partitions`` bounds the files that a cleansed table or the fact
    gets per micro-batch.  ``late`` bounds the state of the fact's joins by an
    event time that the lines and both dimensions must carry; off by default, as
    it drops late matches.

    ``exactly_once`` keeps a message that the bus delivers again out of the raw
    tables; messages then come with their topic, partition and offset.
    ``order_rules`` are checked on the cleansed order lines.
    """
    options = {} if read_options is None else read_options
    rows = {"read_options": options, "output_partitions": output_partitions}
    return [
        _raw("sales_orders", sources, reset_allowed=False, exactly_once=exactly_once),
        _raw("customers", sources, reset_allowed=True, exactly_once=exactly_once),
        _raw("products", sources, reset_allowed=False, exactly_once=exactly_once),
        Dataset(
            "sales_orders_cleansed",
            lambda spark, messages: cleanse.cleanse_orders(messages, mode=order_mode),
            ["sales_orders_raw"],
            schema=schemas.ORDER_LINE,
            comment="Order lines with typed columns",
            rules=order_rules,
            # Each line repeats the lists of its order.
            together=["order_number", "customer_id", "order_datetime"],
            **rows,
        ),
        Dataset(
            "customers_cleansed",
            lambda spark, messages: cleanse.cleanse_customers(
                messages, keep_null_rows=keep_null_rows
            ),
            ["customers_raw"],
            schema=schemas.CUSTOMER,
            comment="Customer versions with typed columns",
            **rows,
        ),
        Dataset(
            "products_cleansed",
            lambda spark, messages: cleanse.cleanse_products(
                messages, keep_null_rows=keep_null_rows
            ),
            ["products_raw"],
            schema=schemas.PRODUCT,
            comment="Product versions with typed columns",
            **rows,
        ),
        Dataset(
            "dim_products",
            "SELECT * FROM products_cleansed",
            ["products_cleansed"],
            kind=KEYED,
            key="product_key",
            order_by=["product_id"],
            stable_input=True,
            schema=schemas.DIM_PRODUCT,
            comment="Product dimension",
            properties=GOLD,
            read_options=options,
        ),
        Dataset(
            "dim_customers",
            "SELECT * FROM customers_cleansed",
            ["customers_cleansed"],
            kind=KEYED,
            key="customer_key",
            order_by=["customer_id"],
            stable_input=True,
            schema=schemas.DIM_CUSTOMER,
            comment="Customer dimension",
            properties=GOLD,
            read_options=options,
        ),
        Dataset(
            "fact_sales_orders",
            lambda spark, *inputs, hot_products=(), hot_customers=(): facts.fact_sales_orders(
                *inputs,
                product_salting=facts.Salting(product_salt, hot_products),
                customer_salting=facts.Salting(customer_salt, hot_customers),
                late=late,
            ),
            ["sales_orders_cleansed", "dim_products", "dim_customers"],
            # A bound forgets rows by their time, which the state of streaming joins does.
            kind=JOINED if late is None else STREAM,
            schema=schemas.FACT_SALES_ORDER,
            comment="Order lines by customer and product key",
            properties=GOLD,
            **rows,
            pinned={"product_salt": product_salt, "customer_salt": customer_salt},
            measure=_hot_keys,
        ),
        Dataset(
            "fact_customer_sales",
            _measured_customer_sales,
            ["sales_orders_cleansed", "dim_products", "dim_customers"],
            kind=RECOMPUTED,
            schema=schemas.FACT_CUSTOMER_SALES,
            comment="Sales by product and customer",
            properties=GOLD,
        ),
        Dataset(
            "customer_sales",
            lambda spark, fact: facts.customer_sales(fact),
            ["fact_sales_orders"],
            kind=RECOMPUTED,
            schema=schemas.CUSTOMER_SALES,
            comment="Sales by customer and product key",
            properties=GOLD,
        ),
    ]


def current_datasets(*, buckets: int = 64) -> list[Dataset]:
    """The customers and products as they are now, from the raw tables of ``retail_datasets``.

    Updates replace and deletes remove.  The raw tables must keep the ``offset`` of
    their messages.
    """
    kinds = {"customers": (schemas.CUSTOMER, "customer_id"), "products": (schemas.PRODUCT, "product_id")}
    return [
        Dataset(
            f"current_{table}",
            lambda spark, messages, row=row, key=key: current.keyed_changes(
                messages, schemas.pick(row, [key]), row
            ),
            [f"{table}_raw"],
            kind=MERGED,
            merge=current.LastWriter([key], buckets=buckets),
            schema=row,
            comment=f"The {table} as they are now",
            properties=GOLD,
        )
        for table, (row, key) in kinds.items()
    ]


def incremental_datasets(*, grid: int = 16) -> list[Dataset]:
    """The sales by product and customer of ``retail_datasets``, kept from what is new."""
    return [
        Dataset(
            "customer_sales_incremental",
            lambda spark, *inputs: incremental.sales_changes(*inputs),
            ["sales_orders_cleansed", "dim_products", "dim_customers"],
            kind=MERGED,
            merge=incremental.SalesTotals(grid),
            schema=schemas.FACT_CUSTOMER_SALES,
            comment="Sales by product and customer, kept from changes",
            properties=GOLD,
        )
    ]


def _hot_keys(spark: SparkSession, lines: DataFrame, *dimensions: DataFrame) -> dict | None:
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = facts.hot_keys(lines, ["product_id", "customer_id"], partitions)
    if hot is None:
        return None
    return {"hot_products": hot["product_id"], "hot_customers": hot["customer_id"]}


def _measured_customer_sales(
    spark: SparkSession, lines: DataFrame, products: DataFrame, customers: DataFrame
) -> DataFrame:
    """The aggregate, its hot keys measured anew each time it is computed."""
    hot = _hot_keys(spark, lines) or {"hot_products": (), "hot_customers": ()}
    return facts.fact_customer_sales(
        lines,
        products,
        customers,
        product_salting=facts.Salting(1, hot["hot_products"]),
        customer_salting=facts.Salting(1, hot["hot_customers"]),
    )


def _raw(
    table: str, sources: Mapping[str, Source], *, reset_allowed: bool, exactly_once: bool
) -> Dataset:
    return Dataset(
        f"{table}_raw",
        lambda spark: raw.as_text(sources[table](spark)),
        kind=ONCE if exactly_once else STREAM,
        trigger="1 seconds",
        reset_allowed=reset_allowed,
    )
