"""Payloads to Kafka. Needs the spark-sql-kafka-0-10 package on the session."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Secret
from ..operators.collect import TOPIC_OF, topic_for
from ..sources.kafka import connection_options

# Delivery settings.
DELIVERY = {
    "kafka.acks": "all",
    "kafka.retries": "3",
    "kafka.max.in.flight.requests.per.connection": "1",
}

#: Longest value that a broker takes by default, less what the record's frame needs.
MOST_BYTES = 1_000_000


def write_options(namespace: str, connection: Secret | None) -> dict[str, str]:
    return connection_options(namespace, connection) | DELIVERY


def records(
    messages: DataFrame,
    kind: str = "type",
    value: str = "value",
    topics: dict[str, str] = TOPIC_OF,
) -> DataFrame:
    """Rows for the Kafka sink, which sends each one to the topic in its `topic` column.

    A row whose type has no topic fails the job: `deliverable` leaves such rows out, and `dead_letters` keeps them.
    """
    missing = F.raise_error(F.concat(F.lit("no topic for type "), F.coalesce(F.col(kind), F.lit("null"))))
    topic = F.coalesce(topic_for(F.col(kind), topics), missing)
    return messages.select(topic.alias("topic"), F.col(value).alias("value"))


def flaw(
    kind: str = "type", value: str = "value", topics: dict[str, str] = TOPIC_OF, most: int = MOST_BYTES
) -> Column:
    """Why a row can't be sent: `no topic`, `no value` (it would delete a key) or `too large`; null if it can."""
    return (
        F.when(topic_for(F.col(kind), topics).isNull(), "no topic")
        .when(F.col(value).isNull(), "no value")
        .when(F.octet_length(value) > most, "too large")
    )


def deliverable(messages: DataFrame, kind: str = "type", value: str = "value", **limits) -> DataFrame:
    """The rows that can be sent, as records."""
    names = {"topics": limits["topics"]} if "topics" in limits else {}
    return records(messages.where(flaw(kind, value, **limits).isNull()), kind, value, **names)


def dead_letters(messages: DataFrame, kind: str = "type", value: str = "value", **limits) -> DataFrame:
    """All other rows with all their columns and the `reason`, which replaces a column of that name."""
    if "reason" in (kind, value):
        raise ValueError("a dead letter's reason would replace its type or value")
    return messages.withColumn("reason", flaw(kind, value, **limits)).where("reason IS NOT NULL")


def delivering(send: Callable[[DataFrame], None], dead: str, **names) -> Callable[[DataFrame, int], None]:
    """A function per micro-batch that sends what can be sent and keeps the rest in the folder `dead`.

    The rest goes first, to a folder of the batch that a repeated batch replaces: no row is lost, and no dead letter is kept twice.
    """

    def write(messages: DataFrame, batch: int) -> None:
        dead_letters(messages, **names).write.mode("overwrite").parquet(f"{dead}/batch_id={batch}")
        send(deliverable(messages, **names))

    return write


def publish(
    messages: DataFrame, namespace: str, connection: Secret | None, dead: str | None = None, batch: int = 0
) -> None:
    """Sends all rows; with a folder for `dead` letters a row that can't be sent is kept there and fails nothing."""
    options = write_options(namespace, connection)

    def send(rows: DataFrame) -> None:
        rows.write.format("kafka").options(**options).save()

    if dead is None:
        return send(records(messages))
    return delivering(send, dead)(messages, batch)
