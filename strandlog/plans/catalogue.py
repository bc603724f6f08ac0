"""Queries that show every operator on the driver's tables, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlog.functions import encode as E
from strandlog.functions.scalars import cursor_of, lag_seconds, stuck
from strandlog.operators import flatten, merge, pull, reconcile
from strandlog.operators.pull import Cursor
from strandlog.plans import status
from strandlog.plans.run import Budget, reconcile_table, run_sync, run_table
from strandlog.sources.scratch import scratch_path
from strandlog.sources.store import Store, SyncState
from strandlog.spec import SoftDelete, SyncColumn, TableSpec
from strandlog.streaming.follow import commit_batch

NOW = "2030-01-01 00:00:00"
ORDERS = TableSpec(
    "orders", "orders", "orders_replica", "o_orderkey", "bigint", "o_orderdate",
    (SyncColumn("o_orderkey", "integer"), SyncColumn("o_custkey", "integer"), SyncColumn("o_orderstatus", "text"), SyncColumn("o_totalprice", "real"), SyncColumn("o_orderdate", "timestamp"), SyncColumn("o_orderpriority", "text")),
    reconcile_deletes=True,
)
EVENTS = TableSpec(
    "events", "events", "events_replica", "event_id", "bigint", "ts",
    (SyncColumn("event_id", "integer"), SyncColumn("ts", "timestamp"), SyncColumn("user_id", "bigint"), SyncColumn("event_type", "text"), SyncColumn("value", "real"), SyncColumn("props", "json")),
    reconcile_deletes=True,
)
CUSTOMER = TableSpec("customer", "customer", "customer", "c_name", "text", "c_name", (SyncColumn("c_name", "text"),))

#: A tie in the middle of a date that several orders share: every query that resumes starts here.
TIE_SQL = "(SELECT o_orderdate AS d, min(o_orderkey) AS k FROM orders WHERE o_orderdate = (SELECT o_orderdate FROM orders GROUP BY 1 HAVING count(*) > 1 ORDER BY count(*) DESC, 1 LIMIT 1) GROUP BY 1)"


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _store(spark: SparkSession) -> Store:
    """A store of its own in the shared folder."""
    return Store(spark, scratch_path(spark, "replica"))


def _fine(result):
    if result.error:
        raise RuntimeError(result.error)
    return result


def _synced(spark: SparkSession, source: DataFrame, spec: TableSpec, mode: str = "bulk") -> Store:
    """A store after one whole run."""
    store = _store(spark)
    _fine(run_table(store, spec, source, Budget(), mode=mode))
    return store


def _tie(orders: DataFrame) -> Cursor:
    top = orders.groupBy("o_orderdate").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("k")).where("n > 1").orderBy(F.desc("n"), "o_orderdate").limit(1).collect()[0]
    return Cursor(top["o_orderdate"], top["k"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None):
    """Register a query under its function's name, with the SQL of the same result."""

    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return add


ISO = "strftime({}, '%Y-%m-%dT%H:%M:%S.%fZ')"
_D = ISO.format("o_orderdate")
_PAGE = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, " + _D + " AS o_orderdate, o_orderpriority"


# -- scans and predicates ----------------------------------------------------------------------------------


@query(f"SELECT {_PAGE} FROM (SELECT * FROM orders WHERE o_orderdate <= TIMESTAMP '{NOW}' - INTERVAL 5 SECOND ORDER BY orders.o_orderdate, o_orderkey LIMIT 500)")
def pull_initial_page(spark, d):
    return E.encode_frame(pull.page(_t(spark, d, "orders"), ORDERS, None, NOW), ORDERS)


@query(f"SELECT {_PAGE} FROM (SELECT orders.* FROM orders, {TIE_SQL} t WHERE (orders.o_orderdate, o_orderkey) > (t.d, t.k) ORDER BY orders.o_orderdate, o_orderkey LIMIT 500)")
def pull_resume_page(spark, d):
    orders = _t(spark, d, "orders")
    return E.encode_frame(pull.page(orders, ORDERS, _tie(orders), NOW), ORDERS)


@query(f"SELECT o_orderkey, {_D} AS o_orderdate FROM (SELECT orders.* FROM orders, {TIE_SQL} t WHERE o_orderdate = t.d AND o_orderkey > t.k)")
def pull_boundary_tie(spark, d):
    """Rows of the tied date that a bare comparison of dates would lose."""
    orders = _t(spark, d, "orders")
    tie = _tie(orders)
    rest = pull.changes(orders, ORDERS, tie, NOW).where(F.col("o_orderdate") == pull.typed(orders, "o_orderdate", tie.updated_at))
    return E.encode_frame(rest, ORDERS).select("o_orderkey", "o_orderdate")


@query("SELECT CAST(count(*) AS BIGINT) AS n FROM orders WHERE o_orderdate <= TIMESTAMP '1996-06-30 00:00:00' - INTERVAL 86400 SECOND")
def safety_lag_cutoff(spark, d):
    spec = replace(ORDERS, safety_lag=86400.0)
    return pull.changes(_t(spark, d, "orders"), spec, None, "1996-06-30 00:00:00").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT o_orderkey AS id, o_orderstatus AS status, {_D} AS changed FROM orders")
def pull_projection_rename(spark, d):
    spec = replace(ORDERS, columns=(SyncColumn("o_orderkey", "integer", "id"), SyncColumn("o_orderstatus", "text", "status"), SyncColumn("o_orderdate", "timestamp", "changed")))
    return E.encode_frame(pull.project(_t(spark, d, "orders"), spec), spec)


@query(f"SELECT {ISO.format('d')} AS updated_at, k AS pk FROM (SELECT o_orderdate AS d, o_orderkey AS k FROM orders ORDER BY 1, 2 LIMIT 500) ORDER BY d DESC, k DESC LIMIT 1")
def next_cursor(spark, d):
    page = pull.page(_t(spark, d, "orders"), ORDERS, None, NOW)
    return pull.last_of(page, "o_orderdate", "o_orderkey").select(F.date_format("updated_at", E.ISO).alias("updated_at"), "pk")


@query("SELECT o_orderkey, CAST(ceil(row_number() OVER (ORDER BY o_orderdate, o_orderkey) / 500.0) AS BIGINT) AS page FROM orders")
def page_numbering(spark, d):
    """The page of each row, without walking pages."""
    return pull.page_numbers(_t(spark, d, "orders"), ORDERS, scratch_path(spark, "pages")).withColumnRenamed("pk", "o_orderkey")


@query("SELECT event_id AS pk FROM events ORDER BY 1 LIMIT 1000")
def key_page_first(spark, d):
    return pull.key_page(_t(spark, d, "events"), EVENTS)


@query("SELECT event_id AS pk FROM events WHERE event_id > 700 ORDER BY 1 LIMIT 1000")
def key_page_resume(spark, d):
    return pull.key_page(_t(spark, d, "events"), EVENTS, 700)


@query("SELECT c_name AS pk FROM customer WHERE c_name > 'Customer#00000005' ORDER BY c_name LIMIT 100")
def key_page_text(spark, d):
    return pull.key_page(_t(spark, d, "customer"), CUSTOMER, "Customer#00000005", 100)


@query("SELECT event_id AS pk FROM events WHERE event_id > 100 AND event_id <= 350")
def key_range(spark, d):
    return pull.key_range(_t(spark, d, "events"), "event_id", 100, 350)


@query(f"SELECT CAST(count(*) AS VARCHAR) AS n, {ISO.format('max(ts)')} AS hwm FROM events")
def high_water_mark(spark, d):
    return pull.high_water_mark(_t(spark, d, "events"), EVENTS).select("n", F.date_format("hwm", E.ISO).alias("hwm"))


@query("SELECT CAST(count(*) AS BIGINT) AS n FROM orders")
def replica_count(spark, d):
    return _synced(spark, _t(spark, d, "orders"), ORDERS).replica(ORDERS).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, event_type FROM events WHERE event_id IN (1, 5, 9, 77, 1000)")
def membership(spark, d):
    events = _t(spark, d, "events")
    keys = spark.createDataFrame([(k,) for k in (1, 5, 9, 77, 1000)], "event_id long")
    return events.join(keys, "event_id", "left_semi").select("event_id", "event_type")


# -- encoders ----------------------------------------------------------------------------------------------


@query(f"SELECT event_id, {ISO.format('ts')} AS ts, {ISO.format('ts')} AS from_text FROM events")
def encode_timestamp(spark, d):
    events = _t(spark, d, "events")
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS'+00'")
    return events.select("event_id", E.encode_timestamp(F.col("ts"), "events.ts", events.schema["ts"].dataType).alias("ts"), E.encode_timestamp(text, "events.ts").alias("from_text"))


@query("SELECT event_id, CAST(user_id * 900719925474 AS VARCHAR) AS big FROM events")
def encode_bigint(spark, d):
    return _t(spark, d, "events").select("event_id", E.encode_bigint(F.col("user_id") * F.lit(900719925474), "events.user_id").alias("big"))


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END AS flag FROM events")
def encode_boolean(spark, d):
    even = F.when(F.col("event_id") % 2 == 0, F.lit("t")).otherwise(F.lit("f"))
    return _t(spark, d, "events").select("event_id", E.encode_boolean(even, "events.flag").alias("flag"))


@query("SELECT o_orderkey, CAST(o_custkey AS BIGINT) AS n FROM orders")
def encode_integer(spark, d):
    return _t(spark, d, "orders").select("o_orderkey", E.encode_integer(F.col("o_custkey").cast("string"), "orders.o_custkey").alias("n"))


@query("SELECT o_orderkey, o_totalprice AS price FROM orders")
def encode_real(spark, d):
    return _t(spark, d, "orders").select("o_orderkey", E.encode_real(F.col("o_totalprice"), "orders.o_totalprice").alias("price"))


@query("SELECT o_orderkey, o_orderpriority AS priority FROM orders")
def encode_text(spark, d):
    return _t(spark, d, "orders").select("o_orderkey", E.encode_text(F.col("o_orderpriority"), "orders.o_orderpriority").alias("priority"))


@query("SELECT event_id, props FROM events")
def encode_json(spark, d):
    return _t(spark, d, "events").select("event_id", E.encode_json(F.col("props"), "events.props").alias("props"))


@query("SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) AS price FROM orders")
def encode_numeric(spark, d):
    return _t(spark, d, "orders").select("o_orderkey", E.encode_numeric(F.col("o_totalprice").cast("decimal(18,2)"), "orders.o_totalprice").alias("price"))


@query("SELECT doc_id, lower(hex(encode(text))) AS body FROM documents WHERE n_chars < 200")
def encode_blob(spark, d):
    docs = _t(spark, d, "documents").where("n_chars < 200")
    return docs.select("doc_id", F.lower(F.hex(E.encode_blob(F.encode("text", "UTF-8"), "documents.text"))).alias("body"))


@query("SELECT doc_id, lower(hex(encode(text))) AS body FROM documents")
def encode_blob_all(spark, d):
    return _t(spark, d, "documents").select("doc_id", F.lower(F.hex(E.encode_blob(F.encode("text", "UTF-8"), "documents.text"))).alias("body"))


@query("SELECT doc_id, CAST(octet_length(encode(text)) AS BIGINT) AS n FROM documents WHERE octet_length(encode(text)) > 20000")
def encode_size_guard(spark, d):
    n = E.size_of(E.guard_size(F.col("text"), "documents.text"))
    return _t(spark, d, "documents").select("doc_id", n.cast("long").alias("n")).where("n > 20000")


@query("SELECT doc_id, CAST(octet_length(encode(text)) AS BIGINT) AS n FROM documents")
def encode_size_all(spark, d):
    n = E.size_of(E.guard_size(F.col("text"), "documents.text"))
    return _t(spark, d, "documents").select("doc_id", n.cast("long").alias("n"))


# -- merge -------------------------------------------------------------------------------------------------

#: Changes to orders: key % 5 = 0 newer, 1 stale, 2 of the same time; 3 and 4 unchanged.
_CHANGED_SQL = """(SELECT o_orderkey, o_orderdate + (CASE o_orderkey % 5 WHEN 0 THEN 1 WHEN 1 THEN -1 ELSE 0 END) * INTERVAL 1 DAY AS o_orderdate,
  'X' || o_orderstatus AS o_orderstatus FROM orders WHERE o_orderkey % 5 < 3)"""
_BASE_SQL = "(SELECT o_orderkey, o_orderdate, o_orderstatus FROM orders)"
_LWW_SQL = f"""SELECT o_orderkey, {_D} AS o_orderdate, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate DESC, seq DESC) AS r
  FROM (SELECT *, 0 AS seq FROM {_BASE_SQL} UNION ALL SELECT o_orderkey, o_orderdate, o_orderstatus, 1 AS seq FROM {_CHANGED_SQL})) WHERE r = 1"""


def _small(spark, d):
    spec = replace(ORDERS, columns=tuple(ORDERS.column(c) for c in ("o_orderkey", "o_orderdate", "o_orderstatus")))
    return pull.project(_t(spark, d, "orders"), spec), spec


def _changed(rows):
    k = F.col("o_orderkey") % 5
    days = F.when(k == 0, F.expr("INTERVAL 1 DAY")).when(k == 1, F.expr("INTERVAL -1 DAY")).otherwise(F.expr("INTERVAL 0 DAY"))
    return rows.where(k < 3).select("o_orderkey", (F.col("o_orderdate") + days).alias("o_orderdate"), F.concat(F.lit("X"), "o_orderstatus").alias("o_orderstatus"))


@query(_LWW_SQL)
def upsert_lww(spark, d):
    rows, spec = _small(spark, d)
    base = E.encode_frame(rows, spec)
    return merge.upsert(base, [E.encode_frame(_changed(rows), spec)], "o_orderkey", "o_orderdate")


@query(f"SELECT o_orderkey, {_D} AS o_orderdate, o_orderstatus FROM orders")
def upsert_stale_noop(spark, d):
    rows, spec = _small(spark, d)
    stale = _changed(rows).where("o_orderkey % 5 = 1")
    return merge.upsert(E.encode_frame(rows, spec), [E.encode_frame(stale, spec)], "o_orderkey", "o_orderdate")


@query(f"SELECT o_orderkey, {_D} AS o_orderdate, CASE WHEN o_orderkey % 5 = 2 THEN 'X' || o_orderstatus ELSE o_orderstatus END AS o_orderstatus FROM orders")
def upsert_tie_later_wins(spark, d):
    rows, spec = _small(spark, d)
    same = _changed(rows).where("o_orderkey % 5 = 2")
    return merge.upsert(E.encode_frame(rows, spec), [E.encode_frame(same, spec)], "o_orderkey", "o_orderdate")


@query(_LWW_SQL)
def upsert_idempotent(spark, d):
    rows, spec = _small(spark, d)
    batch = E.encode_frame(_changed(rows), spec)
    return merge.upsert(E.encode_frame(rows, spec), [batch, batch, batch], "o_orderkey", "o_orderdate")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 0 UNION SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 0")
def insert_if_absent(spark, d):
    keys = _t(spark, d, "orders").select("o_orderkey")
    return merge.insert_if_absent(keys.where("o_orderkey % 2 = 0"), keys.where("o_orderkey % 3 = 0"), "o_orderkey")


_DEAD_SQL = f"CASE WHEN o_orderstatus = 'F' THEN {_D} END"


@query(f"SELECT o_orderkey, {_DEAD_SQL} AS deleted_at FROM orders")
def soft_delete_mirror(spark, d):
    orders = _t(spark, d, "orders")
    gone = E.encode_timestamp(F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")), "orders.deleted_at", orders.schema["o_orderdate"].dataType)
    return orders.select("o_orderkey", gone.alias("deleted_at"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'dead' ELSE 'live' END AS side FROM orders")
def soft_delete_purge(spark, d):
    rows = _t(spark, d, "orders").withColumn("deleted_at", F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")))
    live, dead = merge.split_purged(rows, "deleted_at")
    return live.select("o_orderkey", F.lit("live").alias("side")).unionByName(dead.select("o_orderkey", F.lit("dead").alias("side")))


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 7 <> 0")
def delete_by_key(spark, d):
    orders = _t(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    keys = orders.where("o_orderkey % 7 = 0").select(F.col("o_orderkey").cast("string").alias("o_orderkey"))
    return merge.delete_keys(orders, keys, "o_orderkey")


@query(f"""WITH l AS (SELECT o_orderkey, o_orderdate, o_orderstatus, 1 AS seq FROM orders
  UNION ALL SELECT o_orderkey, o_orderdate, 'Y' || o_orderstatus, 3 FROM orders WHERE o_orderkey % 6 = 0),
c AS (SELECT o_orderkey, 2 AS cut FROM orders WHERE o_orderkey % 3 = 0)
SELECT o_orderkey, {_D} AS o_orderdate, o_orderstatus FROM
 (SELECT l.*, row_number() OVER (PARTITION BY l.o_orderkey ORDER BY l.o_orderdate DESC, seq DESC) AS r FROM l LEFT JOIN c USING (o_orderkey) WHERE cut IS NULL OR seq > cut) WHERE r = 1""")
def upsert_then_delete_fold(spark, d):
    """Upserts, then deletes of every third key, then upserts of every sixth: the closed form."""
    rows, spec = _small(spark, d)
    base = E.encode_frame(rows, spec)
    again = E.encode_frame(rows.where("o_orderkey % 6 = 0").withColumn("o_orderstatus", F.concat(F.lit("Y"), "o_orderstatus")), spec)
    log = merge.as_upserts(base, 1).unionByName(merge.as_deletes(base.where("o_orderkey % 3 = 0").select("o_orderkey"), base, "o_orderkey", 2)).unionByName(merge.as_upserts(again, 3))
    return merge.fold(log, "o_orderkey", "o_orderdate")


@query(f"SELECT CAST(count(*) FILTER (WHERE o_orderkey % 4 <> 0) AS BIGINT) AS kept, CAST(max(o_orderkey) FILTER (WHERE o_orderdate = m) AS BIGINT) AS cursor_pk, {ISO.format('max(o_orderdate)')} AS cursor_at FROM orders, (SELECT max(o_orderdate) AS m FROM orders)")
def map_row_drop(spark, d):
    """Rows that a mapping drops don't hold the cursor back: it comes from the unmapped page."""
    spec = replace(ORDERS, map_rows=lambda df: df.where("o_orderkey % 4 <> 0"))
    store = _synced(spark, _t(spark, d, "orders"), spec)
    cursor = F.lit(store.state(spec.key).cursor_pk).cast("long").alias("cursor_pk"), F.lit(store.state(spec.key).cursor_updated_at).alias("cursor_at")
    return store.replica(spec).agg(F.count(F.lit(1)).alias("kept")).select("kept", *cursor)


@query(f"SELECT o_orderkey, {_D} AS o_orderdate, o_orderstatus, m AS mode FROM orders, (VALUES ('bulk'), ('paged')) AS v(m)")
def bulk_equals_paged(spark, d):
    """Whole runs in both modes through the commit log: every row of both replicas."""
    rows, spec = _small(spark, d)
    spec = replace(spec, page_size=5000)
    found = [_synced(spark, rows, spec, mode).replica(spec).withColumn("mode", F.lit(mode)) for mode in ("bulk", "paged")]
    return found[0].unionByName(found[1])


@query(_LWW_SQL)
def replica_after_changes(spark, d):
    """A load and then a batch of newer, older and equal versions: the store's own merge on read."""
    rows, spec = _small(spark, d)
    store = _synced(spark, rows, spec)
    commit_batch(store, spec, _changed(rows), 0)
    return store.replica(spec)


#: Versions of one micro-batch: every order is deleted, and every third born again a day later.
@query(f"SELECT o_orderkey, {ISO.format('o_orderdate + INTERVAL 2 DAY')} AS o_orderdate, 'again' AS o_orderstatus FROM orders WHERE o_orderkey % 3 = 0 UNION ALL SELECT o_orderkey, {_D}, o_orderstatus FROM orders WHERE o_orderkey % 2 <> 0 AND o_orderkey % 3 <> 0")
def purge_within_batch(spark, d):
    """A replica, then one batch in which even keys are deleted and multiples of three come back."""
    rows = _t(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus", F.lit(None).cast("timestamp_ntz").alias("gone"))
    spec = replace(ORDERS, columns=(SyncColumn("o_orderkey", "integer"), SyncColumn("o_orderdate", "timestamp"), SyncColumn("o_orderstatus"), SyncColumn("gone", "timestamp")), soft_delete=SoftDelete("gone", "purge"))
    store = _synced(spark, rows, spec)
    day = lambda n: F.col("o_orderdate") + F.expr(f"INTERVAL {n} DAY")
    dead = rows.where("o_orderkey % 2 = 0 OR o_orderkey % 3 = 0").withColumn("gone", F.col("o_orderdate")).withColumn("o_orderdate", day(1))
    born = rows.where("o_orderkey % 3 = 0").withColumn("o_orderstatus", F.lit("again")).withColumn("o_orderdate", day(2))
    commit_batch(store, spec, born.unionByName(dead), 0)
    return store.replica(spec).select("o_orderkey", "o_orderdate", "o_orderstatus")


# -- reconcile ---------------------------------------------------------------------------------------------

_LEFT_SQL = "(SELECT event_id FROM events WHERE event_id % 10 <> 3 AND event_id < (SELECT max(event_id) - 20 FROM events))"


def _remaining(events: DataFrame) -> DataFrame:
    top = events.agg(F.max("event_id") - 20).collect()[0][0]
    return events.where((F.col("event_id") % 10 != 3) & (F.col("event_id") < top))


@query(f"SELECT event_id AS pk FROM events WHERE event_id NOT IN {_LEFT_SQL}")
def reconcile_orphans(spark, d):
    events = _t(spark, d, "events")
    return reconcile.orphans(events, _remaining(events), "event_id", "event_id")


@query(f"SELECT event_id AS pk FROM events WHERE event_id NOT IN {_LEFT_SQL} AND event_id <= (SELECT max(event_id) FROM {_LEFT_SQL})")
def reconcile_range(spark, d):
    events = _t(spark, d, "events")
    return reconcile.orphans_up_to_source(events, _remaining(events), "event_id", "event_id")


@query(f"SELECT event_id AS pk FROM events WHERE event_id NOT IN {_LEFT_SQL} AND event_id > 50 AND event_id <= 250")
def reconcile_step(spark, d):
    events = _t(spark, d, "events")
    return reconcile.orphans_in_range(events, _remaining(events), "event_id", "event_id", 50, 250)


def _walked(spark, d, budget=None, **options):
    """The replica of all events after a reconcile against those that are left, and what came of it."""
    events = _t(spark, d, "events")
    store = _synced(spark, events, EVENTS)
    left = _remaining(events)
    return store, _fine(reconcile_table(store, EVENTS, lambda: left, budget=budget, **options))


@query(f"SELECT event_id, false AS walking, CAST((SELECT count(*) FROM events WHERE event_id NOT IN {_LEFT_SQL}) AS BIGINT) AS deleted FROM events WHERE event_id IN {_LEFT_SQL}")
def reconcile_run(spark, d):
    """A whole reconcile through the log: every key of the replica that is left."""
    store, result = _walked(spark, d)
    walking = store.state(EVENTS.key).reconcile_cursor_pk is not None
    return store.replica(EVENTS).select("event_id", F.lit(walking).alias("walking"), F.lit(result.deleted).cast("long").alias("deleted"))


_WALK_SQL = f"(SELECT max(event_id) FROM (SELECT event_id FROM events WHERE event_id IN {_LEFT_SQL} ORDER BY 1 LIMIT 400))"


@query(f"SELECT event_id, 'partial' AS status, CAST({_WALK_SQL} AS VARCHAR) AS reconcile_cursor_pk FROM events WHERE event_id IN {_LEFT_SQL} OR event_id > {_WALK_SQL}")
def reconcile_walk_stopped(spark, d):
    """A walk of 200 keys a step that its budget stops after two steps: the replica, and where the walk stands."""
    store, result = _walked(spark, d, Budget(batches=2), mode="walk", keys_per_step=200)
    return store.replica(EVENTS).select("event_id", F.lit(result.status).alias("status"), F.lit(store.state(EVENTS.key).reconcile_cursor_pk).alias("reconcile_cursor_pk"))


@query(f"SELECT event_id, 'ok' AS status, true AS reconciled FROM events WHERE event_id IN {_LEFT_SQL}")
def reconcile_walk_resumed(spark, d):
    """The same walk taken up again until it ends."""
    events = _t(spark, d, "events")
    store, result = _walked(spark, d, Budget(batches=2), mode="walk", keys_per_step=200)
    left = _remaining(events)
    result = _fine(reconcile_table(store, EVENTS, lambda: left, "walk", keys_per_step=20_000))
    state = store.state(EVENTS.key)
    return store.replica(EVENTS).select("event_id", F.lit(result.status).alias("status"), F.lit(state.reconciled_at is not None and state.reconcile_cursor_pk is None).alias("reconciled"))


@query(f"SELECT CAST((SELECT count(*) FROM {_LEFT_SQL}) AS BIGINT) AS source_rows, (SELECT {ISO.format('max(ts)')} FROM events WHERE event_id IN {_LEFT_SQL}) AS source_hwm, CAST((SELECT count(*) FROM events) AS BIGINT) AS replica_rows, false AS in_parity")
def parity_check(spark, d):
    events = _t(spark, d, "events")
    out = status.parity(_remaining(events), events, "ts")
    return out.withColumn("source_hwm", F.date_format("source_hwm", E.ISO))


# -- control plane -----------------------------------------------------------------------------------------

_STATES = [("a", "2029-12-31T23:59:00.500000Z", "ok", "2029-12-31T23:59:30.000Z"), ("b", None, "running", "2029-12-31T23:00:00.000Z"), ("c", "2029-12-31T00:00:00.000000Z", "running", "2029-12-31T23:50:00.000Z")]


def _status(spark):
    """The status of four tables, of which three have states in a store's log."""
    specs = status.spec_table(spark, [replace(ORDERS, key=k) for k in "abcz"]).select("table_key")
    store = _store(spark)
    for key, cursor, state, started in _STATES:
        store.commit(store.head(key), SyncState(key, cursor_updated_at=cursor, last_run_status=state, last_run_started_at=started))
    return status.status_df(specs, store.states(), F.lit("2030-01-01 00:00:00+00:00"))


@query("SELECT * FROM (VALUES ('a', 'ok', false), ('b', 'running', true), ('c', 'running', false), ('z', NULL, true)) AS v(table_key, last_run_status, never_synced)")
def status_left_join(spark, d):
    return _status(spark).select("table_key", "last_run_status", "never_synced")


@query("SELECT * FROM (VALUES ('a', CAST(60 AS BIGINT)), ('b', NULL), ('c', 86400), ('z', NULL)) AS v(table_key, lag_seconds)")
def lag_seconds_of_tables(spark, d):
    return _status(spark).select("table_key", "lag_seconds")


@query("SELECT event_id, CAST(floor((epoch_us(TIMESTAMP '2030-01-01 00:00:00') // 1000 - epoch_us(ts) // 1000) / 1000.0 + 0.5) AS BIGINT) AS lag_s FROM events")
def lag_seconds_of_events(spark, d):
    at = F.to_timestamp_ltz(F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("+00:00")))
    return _t(spark, d, "events").select("event_id", lag_seconds(F.lit("2030-01-01 00:00:00+00:00"), at).alias("lag_s"))


@query("SELECT * FROM (VALUES ('a', false), ('b', true), ('c', false), ('z', false)) AS v(table_key, stuck)")
def stuck_flag(spark, d):
    return _status(spark).select("table_key", "stuck")


@query("SELECT 'orders' AS table_key, CAST(count(*) + (SELECT count(*) FROM orders WHERE o_orderkey % 5 = 0) AS BIGINT) AS rows_synced_total, CAST((SELECT count(*) FROM orders WHERE o_orderkey % 5 = 0) AS BIGINT) AS rows_synced_last_run, CAST(3 AS BIGINT) AS runs_total, CAST(1 AS BIGINT) AS full_sync_epoch FROM orders")
def state_counters(spark, d):
    """Counters of the log after a load, a run without changes, a reset and a run of every fifth order."""
    rows, spec = _small(spark, d)
    store = _synced(spark, rows, spec)
    _fine(run_table(store, spec, rows, Budget()))
    store.reset(spec.key)
    _fine(run_table(store, spec, rows.where("o_orderkey % 5 = 0"), Budget()))
    return store.states().select("table_key", "rows_synced_total", "rows_synced_last_run", "runs_total", "full_sync_epoch")


def _results(spark, d):
    """Results of one run: a has nothing to do, b is stopped after a page, c and d can't be opened."""
    orders = _t(spark, d, "orders")
    sources = {"a": orders.limit(0), "b": orders}
    out = run_sync(spark, _store(spark), lambda s: sources[s.key], [replace(ORDERS, key=k) for k in "abcd"], budget_s=float("inf"), max_pages=1, mode="paged")
    return spark.createDataFrame([(t.table_key, t.status) for t in out.tables], "table_key string, status string")


@query("SELECT bool_or(s = 'partial') AS budget_exhausted FROM (VALUES ('ok'), ('partial'), ('error')) AS v(s)")
def budget_exhausted(spark, d):
    return status.budget_exhausted(_results(spark, d))


@query("SELECT string_agg(t, ', ' ORDER BY t) FILTER (WHERE s = 'error') AS failed FROM (VALUES ('a', 'ok'), ('c', 'error'), ('d', 'error')) AS v(t, s)")
def failed_tables(spark, d):
    return status.failed_tables(_results(spark, d))


@query("SELECT k, coalesce(new, old) AS reconciled_at FROM (VALUES (1, NULL, '2024'), (2, '2025', '2024'), (3, NULL, NULL)) AS v(k, new, old)")
def reconciled_at_coalesce(spark, d):
    """When tables were last reconciled: one that a stopped walk leaves as it was, one done now, one never."""
    store, events = _store(spark), _t(spark, d, "events")
    for k, old in ((1, "2024"), (2, "2024"), (3, None)):
        spec = replace(EVENTS, key=str(k))
        _fine(run_table(store, spec, events, Budget()))
        head = store.head(spec.key)
        store.commit(head, replace(head.state, reconciled_at=old))
        _fine(reconcile_table(store, spec, lambda: events, "full" if k == 2 else "walk", budget=Budget(batches=1), keys_per_step=10, now=datetime(2025, 1, 1)))
    return store.states().select(F.col("table_key").cast("int").alias("k"), F.substring("reconciled_at", 1, 4).alias("reconciled_at"))


@query("SELECT event_id, event_id % 3 <> 0 AND event_id % 5 <> 0 AS has_cursor FROM events")
def cursor_of_parts(spark, d):
    k = F.col("event_id")
    return _t(spark, d, "events").select("event_id", cursor_of(F.when(k % 3 != 0, F.col("ts")), F.when(k % 5 != 0, k)).isNotNull().alias("has_cursor"))


@query("SELECT (value > 50 AND event_type = 'click') AS stuck, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1")
def stuck_counts(spark, d):
    """The staleness rule over many rows: clicks stand for runs, values above 50 for starts long ago."""
    started = F.when(F.col("value") > 50, F.lit("2029-12-31 00:00:00+00:00")).otherwise(F.lit("2029-12-31 23:59:00+00:00"))
    run = F.when(F.col("event_type") == "click", F.lit("running")).otherwise(F.lit("ok"))
    return _t(spark, d, "events").select(stuck(run, started, F.lit("2030-01-01 00:00:00+00:00")).alias("stuck")).groupBy("stuck").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT CAST(event_id AS DOUBLE) AS timestamp, event_type AS channel, props AS event FROM events WHERE event_id % 4 <> 0")
def flatten_events(spark, d):
    one = F.struct(F.col("event_type").alias("channel"), F.col("props").alias("message"), F.col("event_id").cast("double").alias("timestamp"))
    items = _t(spark, d, "events").select(F.when(F.col("event_id") % 4 != 0, F.array(one)).alias("events"))
    return flatten.flatten_events(items).select("timestamp", "channel", "event")


@query("SELECT CAST(event_id AS DOUBLE) AS timestamp, event_type AS channel, CASE WHEN event_id % 4 <> 0 THEN json_object('timestamp', CAST(event_id AS BIGINT), 'channel', event_type, 'event', user_id) END AS line FROM events WHERE event_id % 4 <> 0")
def flatten_lines(spark, d):
    """The JSON line of each nested event."""
    one = F.struct(F.col("event_type").alias("channel"), F.col("user_id").alias("message"), F.col("event_id").alias("timestamp"))
    items = _t(spark, d, "events").select(F.when(F.col("event_id") % 4 != 0, F.array(one)).alias("events"))
    return flatten.flatten_events(items).select(F.col("timestamp").cast("double").alias("timestamp"), "channel", "line")


@query(f"SELECT {_PAGE} FROM orders")
def replicate_end_to_end(spark, d):
    """A whole run through the commit log: pull, encode, write, commit, read every row of the replica back."""
    return _synced(spark, _t(spark, d, "orders"), ORDERS).replica(ORDERS)
