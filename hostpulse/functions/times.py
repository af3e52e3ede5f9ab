"""Broker time and payload time."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def broker_time(text: Column) -> Column:
    """ISO text to a timestamp. Bad text becomes null; a plain cast would fail the query."""
    return text.try_cast("timestamp")


def iso_text(time: Column) -> Column:
    """All six digits: the JSON writer on its own keeps milliseconds only."""
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def to_wall_time(time: Column, zone: str = "Europe/Berlin") -> Column:
    """Moves a UTC time to the wall clock of `zone`.

    The autumn hour maps two times to one, so lag and windows must use the time from before this.
    """
    return F.from_utc_timestamp(time, zone)


# First second of the year 1 and of the year 10000: what lies outside is no time of a sample.
FIRST_SECOND = -62135596800.0
END_SECOND = 253402300800.0


def epoch_micros(seconds: Column) -> Column:
    """Epoch seconds as a double to whole microseconds, null for what cannot be a time.

    A stray value would otherwise overflow the arithmetic on times and end the whole job.
    """
    plausible = (seconds >= FIRST_SECOND) & (seconds < END_SECOND)
    return F.when(plausible, F.round(seconds * F.lit(1e6)).cast("bigint"))


def payload_instant(seconds: Column) -> Column:
    return F.timestamp_micros(epoch_micros(seconds))


def lag_micros(broker: Column, payload_seconds: Column) -> Column:
    """Microseconds from the sample to its arrival at the broker."""
    return F.unix_micros(broker) - epoch_micros(payload_seconds)
