"""Job configuration, read from the environment. Window, watermark, batch size
and flush interval have the original job's defaults; broker address, topic and
group id are this package's own. The sink password has no default on purpose."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from .constants import DEFAULT_WINDOW_MINUTES, WATERMARK_DELAY


@dataclass(frozen=True)
class JobConfig:
    kafka_bootstrap: str = "localhost:9092"
    kafka_topic: str = "events"
    kafka_group_id: str = "eventide"
    jdbc_url: str | None = None
    jdbc_user: str = "analytics"
    jdbc_password: str | None = field(default=None, repr=False)
    summary_table: str = "analytics_summary"
    window_minutes: int = DEFAULT_WINDOW_MINUTES
    watermark_delay: str = WATERMARK_DELAY
    starting_offsets: str = "latest"
    trigger_interval: str = "5 seconds"
    jdbc_batch_size: int = 100
    strict_time: bool = True

    @property
    def window_duration(self) -> str:
        return f"{self.window_minutes} minutes"

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None, require_password: bool = False) -> "JobConfig":
        env = dict(os.environ if env is None else env)
        password = env.get("POSTGRES_PASSWORD")
        if require_password and not password:
            raise KeyError("POSTGRES_PASSWORD must be set; it has no default")
        return cls(
            kafka_bootstrap=env.get("KAFKA_BOOTSTRAP_SERVERS", cls.kafka_bootstrap),
            kafka_topic=env.get("KAFKA_TOPIC", cls.kafka_topic),
            kafka_group_id=env.get("KAFKA_GROUP_ID", cls.kafka_group_id),
            jdbc_url=env.get("POSTGRES_URL", cls.jdbc_url),
            jdbc_user=env.get("POSTGRES_USER", cls.jdbc_user),
            jdbc_password=password,
            window_minutes=int(env.get("WINDOW_MINUTES", cls.window_minutes)),
        )
