"""What a load reports back: counts and paths, never rows."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Observation

from ..audit import AuditLog
from ..contract import Contract
from ..operators.gates import Gate


@dataclass
class LoadResult:
    metrics: dict[str, Any] = field(default_factory=dict)
    gates: list[Gate] = field(default_factory=list)
    paths: dict[str, str] = field(default_factory=dict)
    schema_ok: bool = True
    snapshot: str | None = None
    log: AuditLog | None = None


def log_ignored(contract: Contract, log: AuditLog) -> None:
    """Record what a contract says and a load doesn't do: rules left out, target formats."""
    if contract.ignored:
        log.warn("contract", "Rules left out", ignored=list(contract.ignored))
    formats = [f.target for f in contract.fields if f.target_format]
    if formats:
        # columns are typed in every layer, so there is no text to give a format to
        log.warn("contract", "Target formats are not enforced", columns=formats)


def watched(df: DataFrame, metrics: Sequence[Column]) -> tuple[DataFrame, Observation]:
    """The frame with metrics that are counted while something else writes it.

    Only put this where the writing stage itself evaluates it (no shuffle in
    between): those tasks count once each, however often they are retried.
    """
    observation = Observation(f"metrics-{uuid.uuid4().hex}")
    return df.observe(observation, *metrics), observation
