"""Values that are fixed once per run and must not differ between tasks."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RunContext:
    """One run: its id and its clock, both plain literals in every plan."""

    run_id: str
    now: datetime

    @classmethod
    def start(cls) -> RunContext:
        now = datetime.now(timezone.utc)
        return cls(f"{now:%Y%m%dT%H%M%SZ}-{uuid.uuid4().hex[:8]}", now)

    @property
    def iso_now(self) -> str:
        return self.now.isoformat()

    def run_id_column(self) -> Column:
        return F.lit(self.run_id)

    def timestamp_column(self) -> Column:
        """The run's clock as a zone-free UTC timestamp."""
        utc = self.now.astimezone(timezone.utc).replace(tzinfo=None)
        return F.lit(f"{utc:%Y-%m-%d %H:%M:%S.%f}").cast("timestamp_ntz")
