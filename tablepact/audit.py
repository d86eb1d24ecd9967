"""Run audit: structured events of a load, kept as an append-only table."""

from __future__ import annotations

import json
import traceback
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from .functions.frames import rows_frame

# The keys of an event, and the form of a job id.
EVENT_SCHEMA = (
    "timestamp string, level string, job_nm string, job_id string, "
    "stage string, message string, details map<string,string>"
)


@dataclass
class AuditLog:
    """Events of one run. A run logs per stage, never per row, so they stay few."""

    job: str
    job_id: str
    events: list[dict] = field(default_factory=list)

    @classmethod
    def start(cls, job: str, moment: datetime | None = None) -> AuditLog:
        moment = moment or datetime.now(timezone.utc)
        return cls(job, f"{job}_{moment:%Y%m%d_%H%M%S}")

    def event(self, level: str, stage: str, message: str, **details: object) -> None:
        stamp = datetime.now(timezone.utc).isoformat()
        text = {
            k: v if isinstance(v, str) else json.dumps(v, default=str) for k, v in details.items()
        }
        self.events.append(
            {
                "timestamp": stamp,
                "level": level.upper(),
                "job_nm": self.job,
                "job_id": self.job_id,
                "stage": stage,
                "message": message,
                "details": text,
            }
        )

    def info(self, stage: str, message: str, **details: object) -> None:
        self.event("info", stage, message, **details)

    def warn(self, stage: str, message: str, **details: object) -> None:
        self.event("warn", stage, message, **details)

    def error(self, stage: str, message: str, **details: object) -> None:
        self.event("error", stage, message, **details)

    def frame(self, spark: SparkSession) -> DataFrame:
        return rows_frame(spark, self.events, EVENT_SCHEMA)

    def append_to(self, spark: SparkSession, path: str) -> None:
        self.frame(spark).coalesce(1).write.mode("append").parquet(path)


@contextmanager
def audited(
    spark: SparkSession, job: str, path: str | None = None, moment: datetime | None = None
) -> Iterator[AuditLog]:
    """Record a run; a failure is logged with its traceback and raised again.

    If a failed run's events cannot be written either, the run's own error is raised,
    with a note of that.
    """
    log = AuditLog.start(job, moment)
    try:
        log.info("init", "Run started")
        yield log
        log.info("complete", "Run finished")
    except Exception as error:
        log.error("failure", f"Run failed: {error}", traceback=traceback.format_exc())
        if path:
            try:
                log.append_to(spark, path)
            except Exception as unwritten:
                error.add_note(f"the run's events could not be written: {unwritten}")
        raise
    if path:
        log.append_to(spark, path)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EVENT_SCHEMA).parquet(path)
