"""Message-bus topics and recorded message files as frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark import schemas

# One topic per captured table, and the timeouts of the source.
CAPTURED_TABLES = ("sales_orders", "customers", "products")
TOPIC_PREFIX = "retail.public"
TIMEOUT_MS = 60000


def topic_name(table: str, prefix: str = TOPIC_PREFIX) -> str:
    return f"{prefix}.{table}"


def bus_options(
    servers: str,
    topics,
    *,
    sasl_jaas_config: str | None = None,
    sasl_mechanism: str = "PLAIN",
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = False,
    timeout_ms: int = TIMEOUT_MS,
    **extra: str,
) -> dict[str, str]:
    """Options for Spark's Kafka source.

    The login text comes from the caller, e.g. out of a secret store; nothing is
    kept here.  Use ``extra`` for any other option, such as
    ``maxOffsetsPerTrigger`` to bound a micro-batch while the topic is replayed,
    or ``minPartitions`` to read one large topic partition with several tasks.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topics if isinstance(topics, str) else ",".join(topics),
        "kafka.request.timeout.ms": str(timeout_ms),
        "kafka.session.timeout.ms": str(timeout_ms),
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        "startingOffsets": starting_offsets,
    }
    if sasl_jaas_config is not None:
        options |= {
            "kafka.sasl.mechanism": sasl_mechanism,
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.jaas.config": sasl_jaas_config,
        }
    return options | {name: str(value) for name, value in extra.items()}


def message_stream(
    spark: SparkSession,
    fmt: str,
    options: dict[str, str],
    *,
    path: str | None = None,
    schema: T.StructType | None = None,
    view: str | None = None,
) -> DataFrame:
    """A stream of bus messages: ``fmt="kafka"``, or files of recorded messages.

    Recorded files need ``key`` and ``value`` (``schema`` names what they hold).
    ``view`` also registers the stream as a temporary view for SQL.
    """
    return _messages(spark.readStream, fmt, options, path, schema, view)


def message_batch(
    spark: SparkSession,
    fmt: str,
    options: dict[str, str],
    *,
    path: str | None = None,
    schema: T.StructType | None = None,
    view: str | None = None,
) -> DataFrame:
    """As ``message_stream``, reading once what is there."""
    return _messages(spark.read, fmt, options, path, schema, view)


def _messages(reader, fmt, options, path, schema, view) -> DataFrame:
    reader = reader.format(fmt).options(**options)
    if fmt != "kafka":
        reader = reader.schema(schema or schemas.pick(schemas.BUS_MESSAGE, ["key", "value"]))
    messages = reader.load(path) if path else reader.load()
    if view:
        messages.createOrReplaceTempView(view)
    return messages
