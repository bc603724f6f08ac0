"""Table registrations: what is replicated, under which key and cursor, and how each column is stored."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame

LOGICAL_TYPES = ("text", "integer", "bigint", "numeric", "real", "boolean", "timestamp", "json", "blob")
KEY_TYPES = ("uuid", "text", "integer", "bigint")
NUMERIC_KEYS = ("integer", "bigint")
MIRROR, PURGE = "mirror", "purge"
MAX_COLUMNS = 100
DEFAULT_PAGE, MAX_PAGE = 500, 5000
DEFAULT_LAG = 5.0
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


class SpecError(ValueError):
    """A registration that must not run."""


@dataclass(frozen=True)
class SyncColumn:
    source: str
    type: str = "text"
    target: str | None = None

    @property
    def name(self) -> str:
        return self.target or self.source


@dataclass(frozen=True)
class SoftDelete:
    """A tombstone column: ``mirror`` keeps such rows, ``purge`` deletes them from the replica."""

    column: str
    mode: str = MIRROR


@dataclass(frozen=True)
class TableSpec:
    key: str
    source_table: str
    target_table: str
    primary_key: str
    primary_key_type: str
    cursor_column: str
    columns: tuple[SyncColumn, ...]
    schema: str = "public"
    soft_delete: SoftDelete | None = None
    page_size: int = DEFAULT_PAGE
    safety_lag: float = DEFAULT_LAG
    reconcile_deletes: bool = False
    map_rows: Callable[[DataFrame], DataFrame] | None = field(default=None, compare=False)
    on_drop: str = "keep"

    def column(self, source: str) -> SyncColumn:
        return next(c for c in self.columns if c.source == source)

    @property
    def key_name(self) -> str:
        """The primary key's name in the replica."""
        return self.column(self.primary_key).name

    @property
    def cursor_name(self) -> str:
        return self.column(self.cursor_column).name


def _fail(spec: TableSpec, what: str, action: str, rule: str) -> None:
    raise SpecError(f'invalid TableSpec "{spec.key}": {what}. {action} (rule: {rule})')


def _name(spec: TableSpec, what: str, value: Any) -> None:
    # fullmatch: a trailing newline is no identifier.
    if not isinstance(value, str) or not _NAME.fullmatch(value):
        _fail(spec, f"{what} {value!r} is not an identifier", "Use letters, digits and underscores", "identifier")


def validate_spec(spec: TableSpec, key_only_ok: bool = False) -> TableSpec:
    """The spec itself, or a SpecError at the first rule that it breaks.

    ``key_only_ok`` admits a cursor that isn't stored as a timestamp: the degenerate table whose only
    column is its key, which is inserted where absent.
    """
    for what in ("schema", "source_table", "target_table", "primary_key", "cursor_column"):
        _name(spec, what, getattr(spec, what))
    if not spec.columns:
        _fail(spec, "no columns are registered", "List the columns to copy", "columns-non-empty")
    if len(spec.columns) > MAX_COLUMNS:
        _fail(spec, f"{len(spec.columns)} columns are registered", f"Register at most {MAX_COLUMNS}", "column-limit")
    sources: set[str] = set()
    targets: set[str] = set()
    for c in spec.columns:
        _name(spec, "column source", c.source)
        _name(spec, "column target", c.name)
        if c.source in sources:
            _fail(spec, f"source column {c.source} is registered twice", "Remove one", "unique-source")
        if c.name in targets:
            _fail(spec, f"target column {c.name} is registered twice", "Rename one", "unique-target")
        if c.type not in LOGICAL_TYPES:
            _fail(spec, f"column {c.source} has the unknown type {c.type}", f"Use one of {', '.join(LOGICAL_TYPES)}", "column-type")
        sources.add(c.source)
        targets.add(c.name)
    if spec.primary_key not in sources:
        _fail(spec, f"primary key {spec.primary_key} is not a column", "Register it", "key-registered")
    if spec.cursor_column not in sources:
        _fail(spec, f"cursor column {spec.cursor_column} is not a column", "Register it", "cursor-registered")
    if spec.column(spec.cursor_column).type != "timestamp" and not key_only_ok:
        _fail(spec, f"cursor column {spec.cursor_column} is not stored as a timestamp", "Give it the type timestamp", "cursor-encoding")
    if spec.soft_delete:
        _name(spec, "soft-delete column", spec.soft_delete.column)
        if spec.soft_delete.column not in sources:
            _fail(spec, f"soft-delete column {spec.soft_delete.column} is not a column", "Register it", "soft-delete-registered")
        if spec.soft_delete.mode not in (MIRROR, PURGE):
            _fail(spec, f"soft-delete mode {spec.soft_delete.mode} is unknown", "Use mirror or purge", "soft-delete-mode")
    if isinstance(spec.page_size, bool) or not isinstance(spec.page_size, int) or not 1 <= spec.page_size <= MAX_PAGE:
        _fail(spec, f"page size {spec.page_size} is out of range", f"Use 1 to {MAX_PAGE}", "page-size")
    if not math.isfinite(spec.safety_lag) or spec.safety_lag < 0:
        _fail(spec, f"safety lag {spec.safety_lag} is not a duration", "Use 0 seconds or more", "safety-lag")
    if spec.primary_key_type not in KEY_TYPES:
        _fail(spec, f"key type {spec.primary_key_type} is unknown", f"Use one of {', '.join(KEY_TYPES)}", "key-type")
    if spec.reconcile_deletes:
        # Key ranges are walked on both sides: both must order keys the same way.
        stored, numeric = spec.column(spec.primary_key).type, spec.primary_key_type in NUMERIC_KEYS
        if numeric and stored != "integer":
            _fail(spec, f"the numeric key is stored as {stored}", "Store it as integer, or switch reconcile off", "reconcile-order")
        if not numeric and stored == "integer":
            _fail(spec, f"the {spec.primary_key_type} key is stored as integer", "Store it as text, or switch reconcile off", "reconcile-order")
    return spec


def validate_registry(specs: Iterable[TableSpec]) -> tuple[TableSpec, ...]:
    seen: set[str] = set()
    out = tuple(validate_spec(s) for s in specs)
    for s in out:
        if s.key in seen:
            _fail(s, "the key is registered twice", "Rename one", "unique-key")
        seen.add(s.key)
    return out


def parse_tables(param: str | None) -> list[str] | None:
    """Names of a comma-separated parameter; None means all."""
    names = [p.strip() for p in (param or "").split(",")]
    return [n for n in names if n] or None


def list_specs(registry: Iterable[TableSpec], tables: list[str] | None = None) -> list[TableSpec]:
    specs = list(registry)
    if not tables:
        return specs
    by = {s.key: s for s in specs}
    unknown = [t for t in tables if t not in by]
    if unknown:
        raise SpecError(f"unknown tables: {', '.join(unknown)}. Registered: {', '.join(sorted(by))}")
    return [by[t] for t in tables]


def rows_per_statement(n_columns: int, parameters: int = 100) -> int:
    """Rows that fit a statement of so many bound parameters. Spark writes need no such limit; the rule is kept for tests."""
    return max(1, parameters // n_columns)


#: The table that ships with the engine.
DEMO = TableSpec(
    key="demo_items",
    source_table="demo_items",
    target_table="demo_items",
    primary_key="id",
    primary_key_type="uuid",
    cursor_column="updated_at",
    columns=(
        SyncColumn("id", "text"),
        SyncColumn("name", "text"),
        SyncColumn("qty", "integer"),
        SyncColumn("price_cents", "bigint"),
        SyncColumn("metadata", "json"),
        SyncColumn("is_active", "boolean"),
        SyncColumn("deleted_at", "timestamp"),
        SyncColumn("created_at", "timestamp"),
        SyncColumn("updated_at", "timestamp"),
    ),
    soft_delete=SoftDelete("deleted_at"),
    reconcile_deletes=True,
)
REGISTRY: tuple[TableSpec, ...] = (DEMO,)
