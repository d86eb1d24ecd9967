"""Whole loads: read, map, check, write, merge, with a fixed number of actions."""

from .etl import (
    lenient_frame,
    load_lenient,
    load_strict,
    load_with_policy,
    policy_tagged,
    read_output,
    strict_tagged,
)
from .layered import (
    DuplicateKeys,
    Layers,
    compact,
    layered_tagged,
    load_daily_scd2,
    load_hourly_scd2,
    load_scd1,
    read_business,
)
from .result import LoadResult

__all__ = [
    "DuplicateKeys",
    "Layers",
    "LoadResult",
    "compact",
    "layered_tagged",
    "lenient_frame",
    "load_daily_scd2",
    "load_hourly_scd2",
    "load_lenient",
    "load_scd1",
    "load_strict",
    "load_with_policy",
    "policy_tagged",
    "read_business",
    "read_output",
    "strict_tagged",
]
