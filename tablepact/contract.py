"""One model for the four contract dialects.

============  ============================================================
``fields``    ``{dataset_name, thresholds?, fields: [...]}``
``ds``        ``{ds: {nm, cols: [...], id_cols, upd_cols, dq_rules, ...}}``
``dataset``   ``{dataset: {name, fields: [...], id_columns, ...}}``
``lines``     a list of mappings, one JSON object per line of the file
============  ============================================================

Blank text, ``null`` and a missing key all mean "not given". A rule that is given but
cannot be understood raises, or with ``on_bad_rule="ignore"`` is left out and listed
in ``Contract.ignored``, which loads record.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace
from typing import Any

NOT_IN_SOURCE = "-"


class ContractError(ValueError):
    """The contract document cannot be understood or contradicts itself."""


@dataclass(frozen=True)
class Field:
    """How one target column is obtained and what its values must satisfy."""

    target: str
    source: str | None = None
    source_type: str | None = None
    target_type: str | None = None
    source_format: str | None = None
    target_format: str | None = None
    nullable: bool = True
    primary_key: bool = False
    regex: str | None = None
    minimum: Any = None
    maximum: Any = None
    allowed: tuple[Any, ...] = ()
    change_types: tuple[str, ...] = ()
    comment: str | None = None
    expr: str | None = None

    @property
    def added(self) -> bool:
        """True when the source has no such column."""
        return self.source is None


@dataclass(frozen=True)
class SchemaPolicy:
    check_schema: bool = True
    check_row_count: bool = True
    allow_extra_columns: bool = True
    allow_missing_columns: bool = False


@dataclass(frozen=True)
class Thresholds:
    """Batch limits; the defaults are the ones contracts rely on when silent."""

    min_valid_ratio: float = 0.95
    max_reject_pct: float = 0.05
    max_null_pct: float = 0.10


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[Field, ...]
    version: str | None = None
    description: str | None = None
    source_format: str | None = None
    source_path: str | None = None
    id_columns: tuple[str, ...] = ()
    update_columns: tuple[str, ...] = ()
    policy: SchemaPolicy = field(default_factory=SchemaPolicy)
    thresholds: Thresholds = field(default_factory=Thresholds)
    ignored: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        targets = [f.target for f in self.fields]
        repeated = sorted({t for t in targets if targets.count(t) > 1})
        if repeated:
            raise ContractError(f"target columns named twice: {repeated}")

    @property
    def source_columns(self) -> list[str]:
        """Columns the source is expected to have, in contract order."""
        return list(dict.fromkeys(f.source for f in self.fields if f.source))

    @property
    def target_columns(self) -> list[str]:
        return [f.target for f in self.fields]

    @property
    def key_columns(self) -> list[str]:
        """Target names of the business key: flagged fields, else id columns."""
        flagged = [f.target for f in self.fields if f.primary_key]
        if flagged:
            return flagged
        renamed = {f.source: f.target for f in self.fields if f.source}
        return [renamed.get(name, name) for name in self.id_columns]

    @property
    def tracked_columns(self) -> list[str]:
        """Target columns whose change makes a new version: all but the key."""
        keys = set(self.key_columns)
        return [t for t in self.target_columns if t not in keys]

    def but(self, **changes: Any) -> Contract:
        return replace(self, **changes)


BAD_RULE = ("raise", "ignore")


class _Rules:
    """What to do with rules that cannot be understood."""

    def __init__(self, on_bad_rule: str) -> None:
        if on_bad_rule not in BAD_RULE:
            raise ValueError(f"on_bad_rule={on_bad_rule!r}")
        self.strict = on_bad_rule == "raise"
        self.ignored: list[str] = []

    def bad(self, what: str) -> None:
        if self.strict:
            raise ContractError(what)
        self.ignored.append(what)


def parse_contract(
    document: Mapping[str, Any] | Iterable[Mapping[str, Any]], on_bad_rule: str = "raise"
) -> Contract:
    """Contract from a decoded JSON document of any dialect."""
    rules = _Rules(on_bad_rule)
    if not isinstance(document, Mapping):
        contract = Contract(name="", fields=tuple(_mapped_field(m, rules) for m in document))
    elif "ds" in document:
        contract = _from_ds(document["ds"])
    elif "dataset" in document:
        contract = _from_dataset(document["dataset"])
    elif "fields" in document:
        contract = _from_fields(document, rules)
    elif "target_field" in document:
        return parse_contract([document], on_bad_rule)
    else:
        raise ContractError("no 'fields', 'ds' or 'dataset' in the contract document")
    return contract.but(ignored=tuple(rules.ignored))


def parse_contract_text(text: str, on_bad_rule: str = "raise") -> Contract:
    """Contract from JSON text: one document, or one mapping per line."""
    try:
        document = json.loads(text)
    except json.JSONDecodeError as whole:
        lines = [line for line in text.splitlines() if line.strip()]
        try:
            document = [json.loads(line) for line in lines]
        except json.JSONDecodeError:
            raise ContractError(f"contract is not JSON: {whole}") from whole
    return parse_contract(document, on_bad_rule)


def _given(value: Any) -> Any:
    """None for everything a dialect uses to say "not given"."""
    if isinstance(value, str) and not value.strip():
        return None
    return value


def _flag(value: Any, default: bool) -> bool:
    value = _given(value)
    if isinstance(value, str):
        return value.strip().lower() in ("true", "yes", "1")
    return default if value is None else bool(value)


def _names(value: Any) -> tuple[str, ...]:
    value = _given(value)
    if value is None:
        return ()
    return (value,) if isinstance(value, str) else tuple(v for v in value if _given(v))


def _decoded(value: Any, kind: type, what: str, rules: _Rules) -> Any:
    """Rule details as an object or a list, given as nested JSON or as JSON text."""
    value = _given(value)
    if isinstance(value, str):
        try:
            value = json.loads(value)
        except json.JSONDecodeError:
            rules.bad(f"{what} is not JSON: {value}")
            return None
    if value is not None and not isinstance(value, kind):
        rules.bad(f"{what} is not {'a list' if kind is list else 'an object'}: {value}")
        return None
    return value


def _bounds(value: Any, what: str, rules: _Rules) -> Mapping[str, Any]:
    bounds = _decoded(value, dict, what, rules) or {}
    unknown = sorted(set(bounds) - {"min", "max"})
    if unknown:
        rules.bad(f"{what} has {unknown}, not min or max")
    return bounds


def _source(name: Any) -> str | None:
    name = _given(name)
    return None if name == NOT_IN_SOURCE else name


def _type_name(name: Any) -> str | None:
    name = _given(name)
    return None if name == NOT_IN_SOURCE else name


def _mapped_field(entry: Mapping[str, Any], rules: _Rules) -> Field:
    """An entry of the ``fields`` or ``lines`` dialect."""
    target = _given(entry.get("target_field")) or _given(entry.get("field_name"))
    if target is None:
        raise ContractError(f"mapping without target_field: {dict(entry)}")
    bounds = _bounds(entry.get("constraints"), f"constraints of {target}", rules)
    allowed = _decoded(entry.get("allowed_values"), list, f"allowed_values of {target}", rules)
    source = _source(entry.get("source_field"))
    changes = _names(entry.get("change_type"))
    return Field(
        target=target,
        source=source,
        source_type=_type_name(entry.get("source_type")),
        target_type=_type_name(entry.get("target_type")),
        nullable=_flag(entry.get("nullable"), True),
        primary_key=_flag(entry.get("primary_key"), False),
        minimum=_given(bounds.get("min")),
        maximum=_given(bounds.get("max")),
        allowed=tuple(v for v in allowed or () if v is not None),
        change_types=changes,
        expr=_given(entry.get("expr")),
    )


def _from_fields(document: Mapping[str, Any], rules: _Rules) -> Contract:
    known = {}
    for name, value in (document.get("thresholds") or {}).items():
        if name not in Thresholds.__dataclass_fields__:
            rules.bad(f"threshold {name} is unknown")
            continue
        try:
            known[name] = float(value)
        except (TypeError, ValueError):
            rules.bad(f"threshold {name} is not a number: {value}")
    return Contract(
        name=_given(document.get("dataset_name")) or "",
        description=_given(document.get("description")),
        fields=tuple(_mapped_field(entry, rules) for entry in document["fields"]),
        thresholds=Thresholds(**known),
    )


def _from_ds(ds: Mapping[str, Any]) -> Contract:
    rules = ds.get("dq_rules") or {}
    defaults = SchemaPolicy()
    policy = SchemaPolicy(
        **{k: _flag(rules.get(k), getattr(defaults, k)) for k in SchemaPolicy.__dataclass_fields__}
    )
    fmt = _given(ds.get("format"))
    return Contract(
        name=_given(ds.get("nm")) or "",
        version=_given(ds.get("ver")),
        description=_given(ds.get("desc")),
        # "csv|parquet" names a choice, not a format: fall back to the path.
        source_format=None if fmt and "|" in fmt else fmt,
        source_path=_given(ds.get("src_prefix")),
        id_columns=_names(ds.get("id_cols")),
        update_columns=_names(ds.get("upd_cols")),
        policy=policy,
        fields=tuple(
            Field(
                target=_given(c.get("tgt_nm")) or c["src_nm"],
                source=_source(c.get("src_nm")),
                source_type=_type_name(c.get("src_dtype")),
                target_type=_type_name(c.get("tgt_dtype")),
                source_format=_given(c.get("src_fmt")),
                target_format=_given(c.get("tgt_fmt")),
                nullable=_flag(c.get("nullable"), True),
                regex=_given(c.get("regex")),
                change_types=_names(c.get("chg_types")),
                comment=_given(c.get("comment")),
            )
            for c in ds["cols"]
        ),
    )


def _from_dataset(dataset: Mapping[str, Any]) -> Contract:
    return Contract(
        name=_given(dataset.get("name")) or "",
        version=_given(dataset.get("version")),
        description=_given(dataset.get("description")),
        id_columns=_names(dataset.get("id_columns")),
        update_columns=_names(dataset.get("update_id")),
        fields=tuple(
            Field(
                target=_given(f.get("target_name")) or f["name"],
                source=_source(f.get("source_name")),
                source_type=_type_name(f.get("source_data_type")),
                target_type=_type_name(f.get("target_data_type")),
                source_format=_given(f.get("source_format")),
                target_format=_given(f.get("target_format")),
                nullable=_flag(f.get("nullable"), True),
                regex=_given(f.get("validation_regex")),
                change_types=tuple(c for c in _names(f.get("change_type")) if c != "none"),
                comment=_given(f.get("row_level_comments")),
            )
            for f in dataset["fields"]
        ),
    )
