from dataclasses import replace

import pytest

from strandlog.spec import DEMO, SoftDelete, SpecError, SyncColumn, TableSpec, list_specs, parse_tables, rows_per_statement, validate_registry, validate_spec


def wide(n):
    return TableSpec("wide", "wide", "wide", "id", "text", "updated_at", (SyncColumn("id"), SyncColumn("updated_at", "timestamp"), *[SyncColumn(f"c{k}") for k in range(2, n)]))


def test_demo_is_valid():
    assert validate_registry([DEMO]) == (DEMO,)


@pytest.mark.parametrize("field", ["schema", "source_table", "target_table", "primary_key", "cursor_column"])
@pytest.mark.parametrize("bad", ['items"; drop table x', "1st", "", "id\n", "a-b"])
def test_identifiers(field, bad):
    with pytest.raises(SpecError, match="identifier"):
        validate_spec(replace(DEMO, **{field: bad}))


@pytest.mark.parametrize(
    ("change", "rule"),
    [
        ({"columns": ()}, "columns-non-empty"),
        ({"primary_key": "nope"}, "key-registered"),
        ({"cursor_column": "nope"}, "cursor-registered"),
        ({"cursor_column": "name"}, "cursor-encoding"),
        ({"soft_delete": SoftDelete("nope")}, "soft-delete-registered"),
        ({"page_size": 0}, "page-size"),
        ({"page_size": 5001}, "page-size"),
        ({"page_size": 1.5}, "page-size"),
        ({"safety_lag": -1.0}, "safety-lag"),
        ({"safety_lag": float("nan")}, "safety-lag"),
        ({"columns": (*DEMO.columns, SyncColumn("name"))}, "unique-source"),
        ({"columns": (*DEMO.columns, SyncColumn("other", "text", "name"))}, "unique-target"),
        ({"columns": (*DEMO.columns, SyncColumn("bad name"))}, "identifier"),
    ],
)
def test_rules(change, rule):
    with pytest.raises(SpecError, match=rule):
        validate_spec(replace(DEMO, **change))


def test_column_limit():
    validate_spec(wide(100))
    with pytest.raises(SpecError, match="column-limit"):
        validate_spec(wide(101))


@pytest.mark.parametrize(("kind", "stored", "fine"), [("bigint", "text", False), ("uuid", "integer", False), ("bigint", "integer", True), ("text", "text", True)])
def test_reconcile_order(kind, stored, fine):
    spec = replace(wide(3), primary_key_type=kind, reconcile_deletes=True, columns=(SyncColumn("id", stored), SyncColumn("updated_at", "timestamp")))
    if fine:
        validate_spec(spec)
    else:
        with pytest.raises(SpecError, match="reconcile-order"):
            validate_spec(spec)
    validate_spec(replace(spec, reconcile_deletes=False))


def test_registry_and_filter():
    with pytest.raises(SpecError, match="unique-key"):
        validate_registry([DEMO, DEMO])
    assert parse_tables(" a, ,b ,") == ["a", "b"] and parse_tables(" ,") is None and parse_tables(None) is None
    assert list_specs([DEMO], ["demo_items"]) == [DEMO] and list_specs([DEMO]) == [DEMO]
    with pytest.raises(SpecError, match="unknown tables: x"):
        list_specs([DEMO], ["x"])


def test_rows_per_statement():
    assert [rows_per_statement(n) for n in (100, 50, 51, 9, 1)] == [1, 2, 1, 11, 100]
