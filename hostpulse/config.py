"""Run parameters. Nothing here touches Spark, and no secret shows up in a repr."""

import os
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from typing import Literal

StreamName = Literal["logs", "metrics"]
Mode = Literal["kafka", "files"]


class Secret:
    """A value fetched when it is needed and never printed."""

    def __init__(self, fetch: Callable[[], str]):
        self._fetch = fetch

    def reveal(self) -> str:
        return self._fetch()

    def __repr__(self) -> str:
        return "Secret(***)"

    @classmethod
    def from_env(cls, name: str) -> "Secret":
        return cls(lambda: os.environ[name])


def event_hubs_servers(namespace: str | None) -> str:
    """Bootstrap address of the Kafka endpoint of an Event Hubs namespace."""
    if not namespace:
        raise ValueError("Kafka mode needs the name of a namespace")
    return f"{namespace}.servicebus.windows.net:9093"


@dataclass(frozen=True)
class StreamLimits:
    """How one stream reads: where it starts and how much it takes per micro-batch."""

    starting_offsets: str
    max_offsets: int | None
    max_files: int | None = 10
    # Instead of `max_files`; the better unit when file sizes differ.
    max_bytes: int | None = None
    request_timeout_ms: int | None = None
    session_timeout_ms: int | None = None
    # Both split a topic partition over several tasks: for a wider embedding call, and for the case
    # that one partition holds much of the topic.
    min_partitions: int | None = None
    max_records_per_partition: int | None = None


# Start position, limits and timeouts of the two streams.
LOGS_LIMITS = StreamLimits("latest", 100, request_timeout_ms=60000, session_timeout_ms=30000)
METRICS_LIMITS = StreamLimits("earliest", 10000)


@dataclass(frozen=True)
class Target:
    catalog: str = "workspace"
    schema: str = "default"

    def table(self, name: str) -> str:
        return ".".join(part for part in (self.catalog, self.schema, name) if part)


@dataclass(frozen=True)
class Config:
    mode: Mode = "kafka"
    # `dev` or `main`: keeps test and production folders apart.
    environment: str = "dev"
    volume_root: str = "/Volumes"
    # Has no default: names are global, and the login is sent there.
    namespace: str | None = None
    # One topic or a comma-separated list.
    topics: str = "system_data"
    target: Target = field(default_factory=Target)
    connection: Secret | None = None
    fail_on_data_loss: bool = True
    logs: StreamLimits = LOGS_LIMITS
    metrics: StreamLimits = METRICS_LIMITS
    # Zone that broker times from Kafka are shifted to; None keeps them in UTC. Files hold local time.
    broker_zone: str | None = "Europe/Berlin"
    clean: Literal["full", "prefix"] = "full"
    # `parts`: figures of each batch are written and added up on reading, so no row is late.
    # `closed`: each window is written once, `window_delay` after the newest time; later rows are lost.
    windows: Literal["parts", "closed"] = "parts"
    # Parts in a folder are merged after so many batches, while the stream runs; None leaves them as they are.
    merge_every: int | None = None
    window_delay: str = "10 seconds"
    # A sample time this far after the broker's is a wrong clock and must not close windows.
    clock_ahead: str = "10 minutes"
    # Files that have been read: moved to a folder beside the scanned one, deleted, or left, where they are listed at every trigger.
    # For a folder that one stream alone reads.
    clean_source: Literal["archive", "delete", "off"] = "off"
    # Older files, by the newest one's time, are passed over; such as "7d".
    max_file_age: str | None = None
    # Only files whose path matches are read, such as "2024-05-*".
    file_glob: str | None = None
    # The scanned folder in file mode, if it is not the one made of root and environment.
    input_path: str | None = None

    @property
    def zone(self) -> str | None:
        return self.broker_zone if self.mode == "kafka" else None

    @property
    def base_path(self) -> str:
        return self.input_path or f"{self.volume_root}/{self.environment}/default/streaming_data"

    @property
    def file_options(self) -> dict[str, str]:
        """Options of the file source besides its limits."""
        options = {"maxFileAge": self.max_file_age, "pathGlobFilter": self.file_glob}
        if self.clean_source != "off":
            options["cleanSource"] = self.clean_source
        if self.clean_source == "archive":
            options["sourceArchiveDir"] = f"{self.base_path.rstrip('/')}_archive"
        return {key: value for key, value in options.items() if value is not None}

    def checkpoint(self, stream: str) -> str:
        """One checkpoint per source mode and stream: file and Kafka offsets cannot be mixed.

        It lies in the scanned folder; the leading underscore hides it from the file scan.
        """
        return f"{self.base_path}/_checkpoints/{self.mode}_{stream}"

    def limits(self, stream: StreamName) -> StreamLimits:
        return self.logs if stream == "logs" else self.metrics

    def for_backlog(self, max_bytes: int | None = None) -> "Config":
        """For a large backlog: batches as wide as the cluster, where the usual limits would cut it
        into a great many small ones.

        A limit in bytes bounds what a failed batch has to repeat. Windows that are
        `closed` must do without it: input that is not in the order of time would be late in the
        batches after the first.
        """
        wide = {
            "max_offsets": None,
            "max_files": None,
            "max_bytes": max_bytes,
            "max_records_per_partition": 1_000_000,
        }
        return replace(
            self, logs=replace(self.logs, **wide), metrics=replace(self.metrics, **wide)
        )

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> "Config":
        """Defaults, overridden by HOSTPULSE_* variables."""
        names = {
            "mode": "HOSTPULSE_MODE",
            "environment": "HOSTPULSE_ENVIRONMENT",
            "volume_root": "HOSTPULSE_VOLUME_ROOT",
            "namespace": "HOSTPULSE_NAMESPACE",
            "topics": "HOSTPULSE_TOPICS",
        }
        given = {name: env[key] for name, key in names.items() if key in env}
        target = Target(
            env.get("HOSTPULSE_CATALOG", Target.catalog), env.get("HOSTPULSE_SCHEMA", Target.schema)
        )
        connection = (
            Secret.from_env("HOSTPULSE_CONNECTION") if "HOSTPULSE_CONNECTION" in env else None
        )
        return cls(target=target, connection=connection, **given)
