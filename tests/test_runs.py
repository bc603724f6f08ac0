import json
import logging
from dataclasses import replace
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from strandlog.functions import encode as E
from strandlog.plans import run, status
from strandlog.plans.run import Budget, RunFailed, reconcile_table, reset_table, run_reconcile, run_sync, run_table
from strandlog.sources import connect, scratch, store as stores
from strandlog.spec import SoftDelete, SpecError, SyncColumn, TableSpec
from strandlog.streaming.follow import commit_batch, follow_reconcile
from tests.test_replication import NOW, SCHEMA, SPEC, T0, replica, rows, store, tied  # noqa: F401

PURGE = replace(SPEC, soft_delete=SoftDelete("gone", "purge"))


def late(i):
    return (i, f"v{i}", None, T0 + timedelta(days=1))


def test_reconcile_opens_the_source_after_the_log(spark, store, tmp_path):
    path = f"{tmp_path}/src"
    rows(spark, tied(2)).write.parquet(path)
    run_table(store, SPEC, connect.open_parquet(spark, path), Budget(), NOW)
    listed = connect.open_parquet(spark, path)
    rows(spark, [late(3)]).write.mode("append").parquet(path)
    run_table(store, SPEC, connect.open_parquet(spark, path), Budget(), NOW)
    # A frame that was listed before the third row came is refused; a function that opens it anew is right.
    assert reconcile_table(store, SPEC, listed).status == "error"
    assert reconcile_table(store, SPEC, lambda: connect.open_parquet(spark, path)).deleted == 0
    assert [i for i, _ in replica(store)] == [0, 1, 3]


def test_reconcile_tries_again_with_a_new_source(spark, store, tmp_path):
    path, opened = f"{tmp_path}/src", []
    rows(spark, tied(3)).write.parquet(path)
    run_table(store, SPEC, connect.open_parquet(spark, path), Budget(), NOW)

    def opener():
        source = connect.open_parquet(spark, path)
        if not opened:  # another run brings a row between the listing and the commit
            rows(spark, [late(7)]).write.mode("append").parquet(path)
            run_table(store, SPEC, connect.open_parquet(spark, path), Budget(), NOW)
        opened.append(1)
        return source

    result = reconcile_table(store, SPEC, opener)
    assert (result.status, result.deleted, len(opened)) == ("ok", 0, 2) and [i for i, _ in replica(store)] == [0, 1, 2, 7]


def test_walk_is_resumed(spark, store):
    run_table(store, SPEC, rows(spark, tied(20)), Budget(), NOW)
    left = rows(spark, [x for x in tied(20) if x[0] not in (2, 9, 18, 19)])
    first = reconcile_table(store, SPEC, left, "walk", budget=Budget(batches=1), keys_per_step=4)
    assert (first.status, first.deleted, first.keys_scanned, first.completed) == ("partial", 1, 4, False)
    assert store.state("t").reconcile_cursor_pk == "4" and store.state("t").reconciled_at is None
    second = reconcile_table(store, SPEC, left, "walk", keys_per_step=4)
    assert (second.status, second.deleted, second.completed) == ("ok", 3, True) and len(replica(store)) == 16
    assert store.state("t").reconcile_cursor_pk is None and store.state("t").reconciled_at
    assert reconcile_table(store, SPEC, left, budget=Budget(batches=0)).status == "partial"


def test_reconcile_runs(spark, store, caplog):
    run_table(store, SPEC, rows(spark, tied(6)), Budget(), NOW)
    other = replace(SPEC, key="b")

    def opener(spec):
        if spec.key == "b":
            raise OSError("no such table")
        return rows(spark, tied(5))

    assert run_reconcile(spark, store, opener, [other, SPEC], enabled=False).tables == () and len(replica(store)) == 6
    with caplog.at_level(logging.INFO, "strandlog"):
        out = run_reconcile(spark, store, opener, [other, SPEC])
    assert [(t.table_key, t.status, t.deleted) for t in out.tables] == [("b", "error", 0), ("t", "ok", 1)] and out.failed == "b" and out.deleted == 1 and not out.budget_exhausted
    said = [json.loads(r.message) for r in caplog.records]
    assert {x["run_id"] for x in said} == {out.run_id} and [x["event"] for x in said] == ["sync.reconcile.start", "sync.error", "sync.reconcile.done"]
    assert run_reconcile(spark, store, opener, [SPEC], max_steps=0).budget_exhausted
    with pytest.raises(RunFailed, match="b"):
        follow_reconcile(spark, store, opener, [SPEC, other], 0, 1, trigger="schedule")


def test_results_and_reset(spark, store):
    out = run_sync(spark, store, lambda s: rows(spark, tied(4)), [SPEC], now=NOW)
    (one,) = out.tables
    assert one.cursor_before is None and one.cursor_after.pk == "3" and one.duration_ms > 0 and one.replica_bytes > 0 and out.started_at
    with pytest.raises(SpecError, match="unknown tables: x"):
        reset_table(store, "x", registry=[SPEC])
    assert store.states().count() == 1
    reset_table(store, "t", registry=[SPEC])


def test_one_batch_deletes_and_recreates(spark, store):
    at = lambda n: T0 + timedelta(hours=n)
    commit_batch(store, PURGE, rows(spark, [(k, "old", None, at(0)) for k in range(5)]), 0)
    commit_batch(store, PURGE, rows(spark, [(1, "dead", at(1), at(1)), (1, "reborn", None, at(5)), (2, "new", None, at(1)), (2, "dead", at(2), at(2)), (3, "x", None, at(1)), (3, "x", at(1), at(1))]), 1)
    assert replica(store, PURGE) == [(0, "old"), (1, "reborn"), (4, "old")]
    # Rows of one change time: the same one is taken whatever their order.
    for n, part in enumerate((["a", "b"], ["b", "a"])):
        commit_batch(store, PURGE, rows(spark, [(9 + n, v, None, at(9)) for v in part]).repartition(2), 2 + n)
    assert dict(replica(store, PURGE))[9] == dict(replica(store, PURGE))[10] == "b"


def test_empty_deltas_and_copies_are_not_kept(spark, store):
    result = run_table(store, PURGE, rows(spark, tied(4)), Budget(), NOW)
    head = store.head("t")
    assert result.rows_deleted == 0 and len(head.deltas) == 1 and not head.has_deletes and store._names(f"{store.root}/t/data") == list(head.deltas)
    mapped = replace(SPEC, map_rows=lambda df: df.where("id > 100"))
    run_table(store, mapped, rows(spark, [late(50)]), Budget(), NOW)
    assert store.head("t").deltas == head.deltas and store.state("t").cursor_pk == "50"


def test_overlap(spark, store):
    run_table(store, SPEC, rows(spark, tied(10)), Budget(), NOW)
    early = (77, "committed late", None, T0)
    source = rows(spark, [*tied(10), early])
    assert run_table(store, SPEC, source, Budget(), NOW).rows == 0
    run_table(store, SPEC, source, Budget(), NOW, overlap_s=30.0)
    assert (77, "committed late") in replica(store) and store.state("t").cursor_pk == "9"
    assert run_table(store, SPEC, source, Budget(), NOW, "paged", overlap_s=1.0).status == "error"


def test_long_logs(spark, store, monkeypatch):
    monkeypatch.setattr(stores, "COMPACT_DELTAS", 3)
    run_table(store, replace(SPEC, page_size=3), rows(spark, tied(20)), Budget(), NOW, "paged")
    assert len(store.head("t").deltas) < 3 and len(replica(store)) == 20
    run_table(store, SPEC, rows(spark, [late(4), late(30)]), Budget(), NOW)
    reconcile_table(store, SPEC, rows(spark, [*tied(8), late(30)]))
    want = replica(store)
    assert [i for i, _ in want] == [*range(8), 30]
    monkeypatch.setattr(stores, "TOUCHED_BYTES", -1)  # the other way to merge
    assert replica(store) == want
    n = store.head("t").n
    store.vacuum("t", keep=1)
    assert store.head("t").n == n and len(store._names(f"{store.root}/t/_log")) == 2 and replica(store) == want
    store._fs(store.root).delete(store._path(f"{store.root}/t/_log/_last"), False)  # without the hint, by listing
    assert store.head("t").n == n


def test_pages_of_files_are_one_scan(spark, store, tmp_path, monkeypatch):
    """Every page has an entry of its own, but no page is sought in the files by itself."""
    rows(spark, tied(20, 5)).repartition(3).write.parquet(f"{tmp_path}/src")
    source = lambda: connect.open_parquet(spark, f"{tmp_path}/src")
    monkeypatch.setattr(run.pull, "page", None)
    paged = replace(SPEC, page_size=3)
    commit, done = stores.Store.commit, []

    def stopped(self, head, state, *args, **named):
        if named.get("base"):
            done.append((state.cursor_pk, state.rows_synced_total, len(named["base"])))
            if len(done) == 6:
                raise stores.CommitConflict("another writer")
        return commit(self, head, state, *args, **named)

    monkeypatch.setattr(stores.Store, "commit", stopped)
    assert run_table(store, paged, source(), Budget(), NOW, "paged").status == "error"
    assert done[:5] == [("2", 3, 1), ("5", 6, 1), ("8", 9, 1), ("11", 12, 1), ("14", 15, 1)]
    assert replica(store) == [(i, f"v{i}") for i in range(15)] and store.state("t").cursor_pk == "14"
    assert not store.vacuum("t") and replica(store) == [(i, f"v{i}") for i in range(15)]
    result = run_table(store, paged, source(), Budget(), NOW, "paged")
    assert (result.status, result.rows, result.pages) == ("ok", 5, 2) and replica(store) == [(i, f"v{i}") for i in range(20)]
    result = run_table(store, paged, source(), Budget(), NOW, "paged")
    assert (result.status, result.rows, result.pages) == ("ok", 0, 0) and len(store._names(f"{store.root}/t/data")) == 2
    rows(spark, [late(4), late(30)]).write.mode("append").parquet(f"{tmp_path}/src")
    reset_table(store, "t")
    assert run_table(store, paged, source(), Budget(), NOW, "paged").rows == 22
    assert [i for i, _ in replica(store)] == [*range(20), 30]


def test_key_only_table(spark, store):
    """A table of keys alone takes the cursor from another column that isn't kept in the source's order."""
    spec = TableSpec("k", "k", "k", "id", "bigint", "at", (SyncColumn("id", "integer"), SyncColumn("at", "timestamp")), page_size=3)
    source = rows(spark, tied(8)).select("id", "at")
    for mode in ("paged", "bulk"):
        run_table(store, spec, source, Budget(), NOW, mode)
        assert sorted(r["id"] for r in store.replica(spec).collect()) == list(range(8))


@pytest.mark.parametrize(("logical", "kind", "value", "want"), [("bigint", "double", 42.0, "42"), ("numeric", "double", 1.5, "1.5"), ("bigint", "double", float(2**53 + 2), None), ("numeric", "float", float("nan"), None), ("boolean", "int", 1, 1), ("boolean", "string", "1", None), ("boolean", "double", 0.0, 0), ("boolean", "int", 2, None)])
def test_numbers_that_lost_digits(spark, logical, kind, value, want):
    df = spark.createDataFrame([(value,)], f"v {kind}").select(E.encode(F.col("v"), logical, "t.c", spark.createDataFrame([], f"v {kind}").schema["v"].dataType).alias("o"))
    if want is None:
        with pytest.raises(Exception, match="t.c: "):
            df.collect()
    else:
        assert df.collect()[0]["o"] == want


def test_jdbc(spark, store):
    """A database at hand that Spark brings along: the page's filters run there, and runs go through it."""
    url, options = "jdbc:derby:memory:strandlog;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    spec = replace(SPEC, schema="APP", source_table="items", primary_key="ID", cursor_column="AT", columns=(SyncColumn("ID", "integer", "id"), SyncColumn("V", "text", "v"), SyncColumn("AT", "timestamp", "at")), page_size=4)
    source = rows(spark, tied(10)).selectExpr("id AS ID", "v AS V", "CAST(at AS timestamp) AS AT")
    source.write.format("jdbc").option("url", url).options(**options).option("dbtable", '"APP"."items"').save()
    opened = lambda s: connect.open_jdbc(spark, s, url, options)
    for mode in ("paged", "bulk"):
        out = run_sync(spark, store, opened, [spec], now=NOW, mode=mode, budget_s=600)
        assert not out.failed and len(replica(store, spec)) == 10
    assert connect.open_jdbc(spark, spec, url, options, partitions=3).count() == 10
    ask = connect.jdbc_query(spark, url, options)
    assert [r[0] for r in ask('SELECT "V" AS V FROM "APP"."items" WHERE "ID" = 3').collect()] == ["v3"]


def test_catalogue_is_read(spark):
    answers = {
        "columns": [("id", "bigint", "NO"), ("v", "text", "YES"), ("gone", "timestamp", "YES"), ("at", "date", "YES")],
        "pg_indexes": [('CREATE INDEX i ON public.t USING btree ("at" DESC, id) WHERE (id > 0)',), ("CREATE INDEX j ON t USING btree (lower(at), id)",)],
        "triggers": [("1",)],
    }
    asked = []

    def query(sql):
        asked.append(sql)
        found = next(v for k, v in answers.items() if k in sql)
        return spark.createDataFrame(found, ", ".join(f"c{k} string" for k in range(len(found[0])))) if found else spark.createDataFrame([], "c0 string, c1 string, c2 string")

    catalog = connect.read_catalog(query, SPEC)
    assert catalog.indexes == (("at", "id"), ("", "id")) and catalog.has_update_trigger and all("'public'" in q and "'t'" in q for q in asked)
    assert status.preflight(None, SPEC, catalog) == ["cursor column at is nullable", "cursor column at is date, not a timestamp"]
    answers |= {"columns": [], "pg_indexes": [], "triggers": [("0",)]}
    assert status.preflight(None, SPEC, connect.read_catalog(query, SPEC)) == ["table public.t does not exist"]


def test_scratch_is_shared(spark, monkeypatch):
    assert scratch.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))

    class Cluster:
        class conf:
            get = staticmethod(lambda *a: None)

        class sparkContext:
            master = "yarn"

            class _jsc:
                class sc:
                    class getCheckpointDir:
                        isDefined = staticmethod(lambda: False)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.scratch_dir(Cluster)
    assert run.RETRIES > 1 and SCHEMA
