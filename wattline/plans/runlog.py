"""Phase log of a job, written when it succeeds and when it fails."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from contextlib import contextmanager
from datetime import UTC, datetime

from pyspark.sql import SparkSession

from wattline.sources.tables import RUN_PHASES_SCHEMA, append_rows


def now() -> datetime:
    """Current UTC time without zone, as the tables keep it."""
    return datetime.now(UTC).replace(tzinfo=None)


class RunLog:
    """Collects the phases of one run; ``with log.phase("fit"):`` times one of them."""

    def __init__(self, spark: SparkSession, path: str | None, job: str, options: Mapping[str, object] | None = None):
        self.spark = spark
        self.path = path
        self.job = job
        self.run_id = uuid.uuid4().hex
        self.options = {k: str(v) for k, v in (options or {}).items()}
        self.phases: list[tuple] = []

    @contextmanager
    def phase(self, name: str):
        started, status, message = now(), "SUCCESS", None
        try:
            yield
        except Exception as error:
            status, message = "FAILED", str(error)
            raise
        finally:
            ended = now()
            millis = int((ended - started).total_seconds() * 1000)
            self.phases.append((name, status, started, ended, millis, message))

    def __enter__(self):
        return self

    def __exit__(self, kind, error, trace):
        if self.path and self.phases:
            outcome = "FAILED" if error else "SUCCESS"
            rows = [(self.run_id, self.job, outcome, *phase, self.options) for phase in self.phases]
            append_rows(self.spark, self.path, rows, RUN_PHASES_SCHEMA)
        return False
