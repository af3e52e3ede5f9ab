"""What happens to host logs and samples before they are sent: filter, fan out, wrap, address."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import LOG_KEYWORDS, has_keyword, strip_blanks
from ..functions.times import iso_text
from ..schemas import LOG, METRICS

# The log categories and the rule of each.
SUBSYSTEM_OF = {
    "system": "com.apple.system",
    "power": "com.apple.power",
    "wifi": "com.apple.wifi",
    "bluetooth": "com.apple.bluetooth",
}
MESSAGE_CONTAINS = {"kernel": "kernel"}

# The topic of each message type.
TOPIC_OF = {METRICS: "system-metrics", LOG: "system-logs"}


def useful_lines(
    lines: DataFrame, column: str = "line", keywords: tuple[str, ...] = LOG_KEYWORDS
) -> DataFrame:
    """Trimmed lines that hold at least one of the quoted keywords.

    The untrimmed line is tested, so that lines without a keyword are never trimmed. Only a keyword
    with a blank at its end could be lost by trimming.
    """
    line = F.col(column)
    trimmed = lines.where(has_keyword(line, keywords)).withColumn(column, strip_blanks(line))
    if any(word != word.strip() for word in keywords):
        return trimmed.where(has_keyword(line, keywords))
    return trimmed


def by_category(
    records: DataFrame, subsystem: str = "subsystem", message: str = "event_message"
) -> DataFrame:
    """One row per record and matching category; a record that matches none is dropped.

    All rules are tested in one pass, where one filter per category and a union would read the
    input once for each of them.
    """
    rules = [
        F.when(F.col(subsystem) == value, F.lit(name)) for name, value in SUBSYSTEM_OF.items()
    ] + [
        F.when(F.col(message).contains(word), F.lit(name))
        for name, word in MESSAGE_CONTAINS.items()
    ]
    matching = F.array_compact(F.array(*rules))
    return records.withColumn("category", F.explode(matching))


def envelope(
    payload: Column, topic: Column, partition: Column, offset: Column, time: Column
) -> list[Column]:
    """The columns of an envelope around a payload, in the text form of the JSON files."""
    return [
        payload.alias("value"),
        F.lit(None).cast("string").alias("key"),
        topic.alias("topic"),
        partition.cast("int").alias("partition"),
        offset.cast("string").alias("offset"),
        iso_text(time).alias("timestamp"),
    ]


def topic_for(kind: Column, topics: dict[str, str] = TOPIC_OF) -> Column:
    """Topic by message type; null for a type that has none."""
    return F.when(kind == METRICS, F.lit(topics[METRICS])).when(kind == LOG, F.lit(topics[LOG]))


def addressed(
    messages: DataFrame, kind: str = "type", topics: dict[str, str] = TOPIC_OF
) -> DataFrame:
    return messages.withColumn("topic", topic_for(F.col(kind), topics))
