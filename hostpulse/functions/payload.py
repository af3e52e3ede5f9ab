"""Building and reading the JSON payload inside an envelope."""

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import LOG, METRICS, PAYLOAD


def decode(value: Column, *fields: str) -> Column:
    """JSON text, or its bytes, to the payload struct, or to the given fields of it.

    Text that is no JSON object gives a struct of nulls, a mistyped field gives null for that field.
    """
    schema = T.StructType([PAYLOAD[name] for name in fields]) if fields else PAYLOAD
    return F.from_json(value.cast("string"), schema)


def payload_type(value: Column) -> Column:
    """Only the routing key; the parser skips over all other fields."""
    return decode(value, "type")["type"]


def may_have_type(value: Column, *kinds: str) -> Column:
    """False only where no parser could find one of `kinds` in the text; a cheap test before it.

    Any JSON string that reads `kind` spells it out or uses a unicode escape.
    """
    text = value.cast("string")
    return reduce(or_, (text.contains(part) for part in [*kinds, "\\u"]))


def metrics_payload(
    seconds: Column,
    cpu_percent: Column,
    memory_total: Column,
    memory_available: Column,
    memory_percent: Column,
    read_bytes: Column,
    write_bytes: Column,
) -> Column:
    return F.to_json(
        F.struct(
            seconds.alias("timestamp"),
            F.lit(METRICS).alias("type"),
            cpu_percent.alias("cpu_percent"),
            F.struct(
                memory_total.alias("total"),
                memory_available.alias("available"),
                memory_percent.alias("percent"),
            ).alias("memory"),
            F.struct(read_bytes.alias("read_bytes"), write_bytes.alias("write_bytes")).alias(
                "disk_io"
            ),
        )
    )


def log_payload(seconds: Column, category: Column, line: Column) -> Column:
    return F.to_json(
        F.struct(
            seconds.alias("timestamp"),
            F.lit(LOG).alias("type"),
            category.alias("category"),
            line.alias("log_raw"),
        )
    )
