"""Plain, frozen settings for the operators. No parsing, no templates."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any


@dataclass(frozen=True)
class Relation:
    """A child of an entity: ``one_to_many``, ``one_to_one`` or ``key_value``."""

    column: str
    table: str
    foreign_key: str
    kind: str = "one_to_many"


@dataclass(frozen=True)
class FieldMap:
    """``target`` comes from ``source`` by the named transformation."""

    target: str
    source: str
    transformation: str = "direct"
    type: str | None = None


@dataclass(frozen=True)
class ColumnSpec:
    type: str
    nullable: bool = True
    primary_key: bool = False
    calculated: bool = False
    formula: str | None = None
    source_field: str | None = None
    data_gap: bool = False


@dataclass(frozen=True)
class TableSpec:
    name: str
    fields: dict[str, ColumnSpec]
    partition_by: tuple[str, ...] = ()
    valid_values: dict[str, tuple[Any, ...]] = field(default_factory=dict)

    @property
    def primary_key(self) -> tuple[str, ...]:
        return tuple(n for n, f in self.fields.items() if f.primary_key)

    @property
    def gap_fields(self) -> tuple[str, ...]:
        """Fields with no source that nothing calculates."""
        return tuple(
            n for n, f in self.fields.items() if (f.data_gap or f.source_field is None) and not f.calculated
        )


@dataclass(frozen=True)
class When:
    """When ``column`` equals ``value``, ``required`` must not be null."""

    column: str
    value: Any
    required: str


@dataclass(frozen=True)
class RuleSet:
    critical: tuple[str, ...] = ()
    valid_values: dict[str, tuple[Any, ...]] = field(default_factory=dict)
    ranges: dict[str, tuple[float | None, float | None]] = field(default_factory=dict)
    consistency: tuple[When, ...] = ()
    formats: dict[str, str] = field(default_factory=dict)
    expressions: dict[str, str] = field(default_factory=dict)
    threshold: float = 0.8
    #: Sets of columns whose values may occur once: primary keys, or an id within its client.
    unique: tuple[tuple[str, ...], ...] = ()


@dataclass(frozen=True)
class Metric:
    column: str
    functions: tuple[str, ...]


@dataclass(frozen=True)
class AggSpec:
    dimensions: tuple[str, ...]
    metrics: tuple[Metric, ...]
    date_column: str | None = None


@dataclass(frozen=True)
class GoldSpec:
    """Everything one Silver to Gold run needs."""

    table: str
    field_map: tuple[FieldMap, ...] = ()
    formulas: dict[str, str] = field(default_factory=dict)
    timestamp_column: str | None = None
    aggregate: AggSpec | None = None
    rules: RuleSet | None = None
    recovery: str = "flag"
    pipeline_id: str = "gold"
    source: str = "unknown"


@dataclass(frozen=True)
class SilverSpec:
    """Everything one Bronze to Silver run needs."""

    keys: tuple[str, ...]
    order_column: str | None = None
    normalize: dict[str, dict] = field(default_factory=dict)
    convert: dict[str, dict] = field(default_factory=dict)
    infer: bool = True
    exclude: tuple[str, ...] = ()
    critical: tuple[str, ...] = ()
    defaults: dict[str, Any] = field(default_factory=dict)
    reject_incomplete: bool = False
    arrays: str = "keep"
