import random
import sqlite3
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from strandlog.operators import merge, pull
from strandlog.plans import status
from strandlog.plans.run import Budget, RunFailed, reconcile_table, reset_table, run_reconcile, run_sync, run_table
from strandlog.sources.store import CommitConflict, Store
from strandlog.spec import SoftDelete, SyncColumn, TableSpec
from strandlog.streaming.follow import commit_batch, follow_files

SPEC = TableSpec("t", "t", "t", "id", "bigint", "at", (SyncColumn("id", "integer"), SyncColumn("v", "text"), SyncColumn("gone", "timestamp"), SyncColumn("at", "timestamp")), reconcile_deletes=True, page_size=7)
SCHEMA = "id long, v string, gone timestamp_ntz, at timestamp_ntz"
T0 = datetime(2026, 8, 27, 10, 0, 0, 123456)
NOW = datetime(2027, 1, 1)


def rows(spark, items):
    return spark.createDataFrame([(i, v, g, t) for i, v, g, t in items], SCHEMA)


def tied(n, step=5):
    return [(i, f"v{i}", None, T0 + timedelta(seconds=i // step)) for i in range(n)]


def replica(store, spec=SPEC):
    return sorted((r["id"], r["v"]) for r in store.replica(spec).collect())


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, f"file://{tmp_path}/store")


def test_fold_equals_sequential_sqlite(spark):
    rng = random.Random(5)
    logs, want = [], {}
    for trace in range(60):
        db = sqlite3.connect(":memory:")
        db.execute("create table r (id text primary key, c text, v text)")
        for seq in range(1, 13):
            key = f"{trace}-{rng.randrange(3)}"
            if rng.random() < 0.25:
                db.execute("delete from r where id = ?", (key,))
                logs.append((key, None, None, "D", seq))
            else:
                c, v = str(rng.randrange(4)), f"{trace}.{seq}"
                db.execute("insert into r values (?, ?, ?) on conflict (id) do update set c = excluded.c, v = excluded.v where excluded.c >= r.c", (key, c, v))
                logs.append((key, c, v, "U", seq))
        want |= {k: (c, v) for k, c, v in db.execute("select * from r")}
    got = merge.fold(spark.createDataFrame(logs, "id string, c string, v string, _op string, _seq long"), "id", "c").collect()
    assert {r["id"]: (r["c"], r["v"]) for r in got} == want


def test_resume_predicate_is_pushed_down(spark, tmp_path):
    rows(spark, tied(40)).write.parquet(f"{tmp_path}/src")
    page = pull.changes(spark.read.parquet(f"{tmp_path}/src"), SPEC, pull.Cursor(str(T0), 3), str(NOW))
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(at" in plan and "LessThanOrEqual(at" in plan
    assert sorted(r["id"] for r in page.collect()) == list(range(4, 40))


@pytest.mark.parametrize("mode", ["bulk", "paged"])
def test_backfill_resume_and_idempotence(spark, store, mode):
    source = rows(spark, tied(30))
    first = run_table(store, SPEC, source, Budget(), NOW, mode)
    assert (first.status, first.rows) == ("ok", 30) and replica(store) == [(i, f"v{i}") for i in range(30)]
    again = run_table(store, SPEC, source, Budget(), NOW, mode)
    assert (again.status, again.rows, again.pages) == ("ok", 0, 0)
    changed = source.withColumn("at", F.when(F.col("id") == 3, F.lit(T0 + timedelta(days=1)).cast("timestamp_ntz")).otherwise(F.col("at"))).withColumn("v", F.when(F.col("id") == 3, F.lit("new")).otherwise(F.col("v")))
    assert run_table(store, SPEC, changed, Budget(), NOW, mode).rows == 1
    assert dict(replica(store))[3] == "new"
    state = store.state("t")
    assert (state.rows_synced_total, state.rows_synced_last_run, state.runs_total, state.cursor_pk) == (31, 1, 3, "3")
    assert state.cursor_updated_at.endswith(".123456Z")


def test_ties_over_a_page_edge(spark, store):
    result = run_table(store, replace(SPEC, page_size=4), rows(spark, tied(21, 21)), Budget(), NOW, "paged")
    assert result.rows == 21 and len(replica(store)) == 21


def test_budget_and_max_pages(spark, store):
    source = rows(spark, tied(30))
    assert run_table(store, SPEC, source, Budget(batches=2), NOW, "paged").status == "partial"
    assert len(replica(store)) == 14
    assert run_table(store, SPEC, source, Budget(), NOW, "paged", max_pages=1).status == "partial"
    assert len(replica(store)) == 21
    assert run_table(store, SPEC, source, Budget(), NOW, "paged").status == "ok" and len(replica(store)) == 30


def test_safety_lag(spark, store):
    source = rows(spark, [(1, "a", None, T0), (2, "b", None, T0 + timedelta(seconds=4))])
    assert run_table(store, SPEC, source, Budget(), T0 + timedelta(seconds=8)).rows == 1
    assert run_table(store, SPEC, source, Budget(), T0 + timedelta(seconds=9)).rows == 1


def test_failed_page_changes_nothing(spark, store):
    run_table(store, SPEC, rows(spark, tied(10)), Budget(), NOW)
    before, state = replica(store), store.state("t")
    bad = rows(spark, [*tied(10), (2**53, "bad", None, T0 + timedelta(days=2))])
    result = run_table(store, SPEC, bad, Budget(), NOW)
    after = store.state("t")
    assert result.status == "error" and "t.id: not a safe integer" in result.error
    assert replica(store) == before and after.cursor_updated_at == state.cursor_updated_at and after.rows_synced_total == state.rows_synced_total
    assert after.last_run_status == "error"


def test_uncommitted_delta_is_rollback(spark, store):
    run_table(store, SPEC, rows(spark, tied(5)), Budget(), NOW)
    full = store.replica(SPEC)
    store.write("t", merge.as_upserts(full.withColumn("v", F.lit("lost")), 99))
    assert all(v != "lost" for _, v in replica(store))
    assert len(store.vacuum("t")) >= 1 and len(replica(store)) == 5


def test_conflicting_commits(store):
    head = store.head("t")
    store.commit(head, head.state)
    with pytest.raises(CommitConflict):
        store.commit(head, head.state)


def test_soft_deletes(spark, store, tmp_path):
    items = [(1, "a", None, T0), (2, "b", T0, T0)]
    mirror = replace(SPEC, soft_delete=SoftDelete("gone"))
    run_table(store, mirror, rows(spark, items), Budget(), NOW)
    assert {r["id"]: r["gone"] for r in store.replica(mirror).collect()} == {1: None, 2: "2026-08-27T10:00:00.123456Z"}
    purge, other = replace(SPEC, soft_delete=SoftDelete("gone", "purge")), Store(spark, f"file://{tmp_path}/purge")
    run_table(other, purge, rows(spark, [(1, "a", None, T0), (2, "b", None, T0)]), Budget(), NOW)
    run_table(other, purge, rows(spark, [(2, "b", T0, T0 + timedelta(hours=1))]), Budget(), NOW)
    assert replica(other, purge) == [(1, "a")]
    run_table(other, purge, rows(spark, [(2, "back", None, T0 + timedelta(hours=2))]), Budget(), NOW)
    assert replica(other, purge) == [(1, "a"), (2, "back")]


def test_mapping(spark, store):
    spec = replace(SPEC, map_rows=lambda df: df.where("id % 2 = 0").withColumn("v", F.upper("v")))
    result = run_table(store, spec, rows(spark, tied(6)), Budget(), NOW)
    assert result.rows == 6 and replica(store, spec) == [(0, "V0"), (2, "V2"), (4, "V4")] and store.state("t").cursor_pk == "5"


def test_reconcile(spark, store):
    run_table(store, SPEC, rows(spark, tied(20)), Budget(), NOW)
    left = rows(spark, [x for x in tied(20) if x[0] not in (4, 19)])
    assert reconcile_table(store, SPEC, left, "range").deleted == 1
    assert reconcile_table(store, SPEC, left).deleted == 1 and len(replica(store)) == 18
    assert store.state("t").reconciled_at and store.state("t").cursor_pk == "19"
    refused = reconcile_table(store, SPEC, left.limit(0))
    assert refused.status == "error" and "allow_empty_source" in refused.error
    assert reconcile_table(store, SPEC, left.limit(0), allow_empty_source=True).deleted == 18 and replica(store) == []
    with pytest.raises(RunFailed):
        run_table(store, SPEC, rows(spark, [(99, "z", None, T0 + timedelta(days=9))]), Budget(), NOW)
        run_reconcile(spark, store, lambda s: left.limit(0), [SPEC], trigger="schedule")


def test_reset_and_compact(spark, store):
    reset_table(store, "t")
    assert store.state("t").full_sync_epoch == 1
    run_table(store, SPEC, rows(spark, tied(9)), Budget(), NOW, "paged")
    before = replica(store)
    store.compact(SPEC)
    assert replica(store) == before and len(store.head("t").deltas) == 1 and store.size_bytes("t") > 0
    reset_table(store, "t")
    assert replica(store) == before and store.state("t").cursor_pk is None and store.state("t").rows_synced_total == 9
    assert run_table(store, SPEC, rows(spark, tied(9)), Budget(), NOW).rows == 9 and replica(store) == before
    reset_table(store, "t", truncate=True)
    assert replica(store) == [] and store.state("t").full_sync_epoch == 3


def test_run_sync(spark, store):
    good, bad = rows(spark, tied(3)), replace(SPEC, key="b")

    def opener(spec):
        if spec.key == "b":
            raise OSError("no such table")
        return good

    out = run_sync(spark, store, opener, [SPEC, bad], now=NOW)
    assert [t.status for t in out.tables] == ["ok", "error"] and out.failed == "b" and not out.budget_exhausted
    with pytest.raises(RunFailed, match="b"):
        run_sync(spark, store, opener, [SPEC, bad], trigger="schedule", now=NOW)
    assert run_sync(spark, store, opener, [SPEC], enabled=False).tables == ()
    assert [r["table_key"] for r in store.states().collect()] == ["t"]


def test_status_and_preflight(spark, store):
    run_table(store, SPEC, rows(spark, tied(3)), Budget(), NOW)
    specs = status.spec_table(spark, [SPEC, replace(SPEC, key="u")])
    got = {r["table_key"]: r for r in status.status_df(specs, store.states(), F.lit("2026-08-27 10:01:00+00:00")).collect()}
    assert got["t"]["lag_seconds"] == 60 and not got["t"]["never_synced"] and got["u"]["never_synced"] and got["u"]["lag_seconds"] is None
    assert status.preflight(None, SPEC) == ["table public.t does not exist"]
    assert status.preflight(rows(spark, tied(2)), SPEC, check_nulls=True) == []
    odd = spark.createDataFrame([(1, "x"), (1, None)], "id long, at string")
    found = status.preflight(odd, SPEC, check_nulls=True)
    assert [f.split(" ")[0] for f in found] == ["missing", "cursor", "cursor", "primary"]
    asked = status.preflight(rows(spark, tied(2)), SPEC, status.Catalog((("at", "id"),), True))
    assert asked == ["primary key id is nullable", "cursor column at is nullable"]


def test_streams(spark, store, tmp_path):
    source = rows(spark, tied(12))
    source.where("id < 6").coalesce(1).write.parquet(f"{tmp_path}/feed")
    query = follow_files(spark, store, SPEC, f"{tmp_path}/feed", source.schema, f"{tmp_path}/cp")
    query.awaitTermination(120)
    source.where("id >= 4").withColumn("v", F.concat(F.lit("w"), "id")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/feed")
    query = follow_files(spark, store, SPEC, f"{tmp_path}/feed", source.schema, f"{tmp_path}/cp")
    query.awaitTermination(120)
    assert replica(store) == [(i, f"v{i}" if i < 4 else f"w{i}") for i in range(12)]
    assert store.head("t").stream_batch == 1 and not commit_batch(store, SPEC, source, 1)
    assert store.state("t").rows_synced_total == 14
