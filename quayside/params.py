"""Parameters of one load."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone


def parse_load_id(load_id: str) -> datetime:
    """The UTC instant a load id (``yyyyMMddHHmmss``) stands for."""
    return datetime.strptime(load_id, "%Y%m%d%H%M%S").replace(tzinfo=timezone.utc)


@dataclass(frozen=True)
class ChangeWindow:
    """Watermark of the last load and time of the current one, both UTC."""

    last: datetime
    current: datetime


@dataclass(frozen=True)
class LoadParams:
    """Identity of one load: which source, for which country, under which load
    id, and the name of the job that runs it, if it has one."""

    source: str
    country: str
    region: str
    load_id: str
    job_name: str | None = None

    @property
    def current(self) -> datetime:
        return parse_load_id(self.load_id)

    @property
    def process_id(self) -> str:
        return f"{self.source}_{self.region}"

    @property
    def source_cluster(self) -> str:
        return f"{self.source}-{self.country}".lower()
