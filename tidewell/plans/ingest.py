"""Loads: landed API pages to typed, partitioned bronze datasets, one report row each.

A load writes its data first and its state after, and its folder, the first below the
dataset, is named by the load number the state holds. A load that dies in between is repeated
into the same folder, also on another day, and replaces it whole; the state never runs ahead
of the data. Only loads that the state counts are read. Load numbers are never used again: a
reset notes the next one, and tables are read from there on.
"""

from __future__ import annotations

import dataclasses
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import epoch, epoch_key, epoch_text, first_filled
from ..model.payloads import page_field
from ..model.specs import CHAT, DOUBLE, INT, LONG, SALES, TEXT, TableSpec, find_spec
from ..operators import state as st
from ..operators.buckets import MergeTable
from ..operators.coerce import coerce
from ..operators.files import delete, exists
from ..operators.flatten import flatten_channels, flatten_properties, flatten_users
from ..operators.infer import spec_from_schema
from ..operators.incremental import high_water_marks, latest_per_key, modified_since, newer_than
from ..operators.joins import join_on
from ..operators.landing import land_folder, replace
from ..operators.messages import normalize_messages, thread_replies
from ..operators.reports import run_summary
from ..sources.landed import load_bronze, read_landed
from ..sources.pages import REJECTED, infer_record, read_pages, rescue_pages
from ..streaming.events import read_events

#: Folders below that of the load.
PARTITIONS = {"sales": ["org_id", "ingest_date"], "marketing": ["year", "month"], "chat": ["kind", "ingest_date"]}
#: The record's modification time, landed beside the declared columns.
MODIFIED = "_modified"
BACKFILL = "backfill_"
SNAPSHOT, MERGED = "/snapshot", "/merged"
#: State kept under names of its own: where the loads after a reset begin, and declarations.
RESETS, DECLARED = "reset:", "declared:"


class Lake:
    """Folders and logs of one organisation's deployment, all below one shared root."""

    def __init__(self, spark: SparkSession, root: str, org_id: str = "default"):
        self.spark, self.root, self.org_id = spark, root, org_id
        self.state = st.IngestState(spark, f"{root}/_state/ingest")
        self.runs = st.RunLog(spark, f"{root}/_state/runs")
        self.reports = st.Reports(spark, f"{root}/_state/reports")

        self.declared: dict[tuple[str, str], TableSpec] = {}

    def declare(self, spec: TableSpec) -> None:
        """Add a table of this organisation to the declared ones, e.g. a custom object."""
        self.declared[(spec.family, spec.entity)] = spec

    def spec(self, family: str, entity: str) -> TableSpec:
        """The declaration of a table: of this session, of the library, or saved in the lake."""
        try:
            return self.declared.get((family, entity)) or find_spec(family, entity)
        except KeyError:
            saved = self.state.load(DECLARED + family, entity)
            if saved is None:
                raise
        columns = tuple((name, kind) for name, kind in saved["columns"])
        self.declare(TableSpec(family, entity, columns, saved["key"], tuple(saved["modified"]), as_text=True))
        return self.declared[(family, entity)]

    def saved_tables(self, family: str) -> list[str]:
        """Entities whose declarations the lake keeps."""
        rows = self.state.current(DECLARED + family).select("resource").collect()  # a row per declared table
        return [row["resource"] for row in rows]

    def span(self, family: str, resource: str, last: dict[str, Any] | None) -> tuple[int, int]:
        """Numbers of the first load since the last reset, and of the next one."""
        if last is None:
            first = (self.state.load(RESETS + family, resource) or {}).get("loads", 0)
            return first, first
        return last.get("since", 0), last["loads"]

    def dataset(self, spec: TableSpec) -> str:
        return f"{self.root}/{spec.family}/{spec.entity}"

    @property
    def live(self) -> str:
        """Sink of the event stream."""
        return self.dataset(CHAT["realtime_events"])

    def landed(self, spec: TableSpec) -> DataFrame:
        """All rows of all loads, with the columns of the load folders."""
        own = T.StructType([T.StructField(n, T.StringType()) for n in spec.names]) if spec.as_text else spec.struct()
        folders = [T.StructField(n, T.StringType()) for n in [MODIFIED, *PARTITIONS[spec.family]]]
        shape = T.StructType([*own.fields, *folders, T.StructField("load", T.IntegerType())])
        return read_landed(self.spark, self.dataset(spec), shape)

    def bronze(self, family: str, entity: str) -> DataFrame:
        """The newest row per key over all loads of a table; of equals, the later loaded.

        With a snapshot or merged loads, only the loads after them are compared with them; without
        later loads they are read as they are.
        """
        spec = self.spec(family, entity)
        if family == "chat" and entity in ("users", "channels"):
            return load_bronze(self.spark, self.dataset(spec), spec)
        if family == "chat" and entity == "realtime_events":
            return read_events(self.spark, self.live)
        resource = _resource(family, entity)
        states = self.state.load_some(family, resource, entity + SNAPSHOT, entity + MERGED)
        first, following = self.span(family, resource, states.get(resource))
        columns = [list(c) for c in spec.columns]
        bases = [b for b in (states.get(entity + MERGED), states.get(entity + SNAPSHOT)) if b is not None]
        # of tables as they are now: not from before a reset or a change of columns
        bases = [b for b in bases if b.get("columns", columns) == columns and b.get("since", first) == first]
        taken = max(bases, key=lambda b: b["through"], default=None)
        rows = self._loads(spec, first, following)
        if taken is not None:
            kept = self._merge_table(spec, taken).read() if "buckets" in taken else read_landed(self.spark, taken["path"], spec.struct())
            if taken["through"] >= following - 1:
                return kept
            through = F.lit(taken["through"])
            kept = kept.withColumns({MODIFIED: F.lit(None).cast("string"), "load": through})
            rows = rows.where(F.col("load") > through).unionByName(kept)
        # A load takes nothing older than the loads before it, so the later one is the newer.
        return latest_per_key(rows, spec.keys, ["load", MODIFIED]).drop("load", MODIFIED)

    def _loads(self, spec: TableSpec, first: int, following: int) -> DataFrame:
        """Typed rows of the loads from first up to following, with their modification time and load."""
        rows = self.landed(spec).where((F.col("load") >= first) & (F.col("load") < following))
        if spec.as_text:
            typed = dataclasses.replace(spec, columns=(*spec.columns, (MODIFIED, TEXT), ("load", INT)))
            rows = coerce(rows, typed)
        return rows.select(*spec.names, MODIFIED, "load")

    def _merge_table(self, spec: TableSpec, taken: dict[str, Any]) -> MergeTable:
        return MergeTable(self.spark, taken["path"], spec.struct(), spec.keys, taken["buckets"])

    def merge_loads(self, family: str, entity: str, buckets: int = 64) -> list[int]:
        """Merge the loads since the last merge into a bucketed table that later reads start from.

        Only the buckets that these loads touch are rewritten; returns them. A merge that died
        before its state was saved is known by its load number and not repeated. After a reset or a
        change of columns a new table is begun.
        """
        spec, resource = self.spec(family, entity), _resource(family, entity)
        states = self.state.load_some(family, resource, entity + MERGED)
        first, following = self.span(family, resource, states.get(resource))
        columns = [list(c) for c in spec.columns]
        taken = states.get(entity + MERGED)
        if taken is None or taken["columns"] != columns or taken["since"] != first:
            number = 0 if taken is None else taken["table"] + 1
            path = f"{self.dataset(spec)}_merged/since={first}/table={number}"  # a reset forgets the state, but not the folder
            taken = {"table": number, "path": path, "buckets": buckets, "columns": columns, "since": first, "through": first - 1}
        table = self._merge_table(spec, taken)
        rows = self._loads(spec, max(first, taken["through"] + 1), following)
        newest = latest_per_key(rows, spec.keys, ["load", MODIFIED]).select(spec.names)
        touched = table.upsert(newest, tag=following - 1)
        self.state.save(family, entity + MERGED, taken | {"through": following - 1})
        return touched

    def take_snapshot(self, family: str, entity: str) -> str:
        """Write :meth:`bronze` as a new folder that later reads start from."""
        spec = self.spec(family, entity)
        taken = self.state.load(family, entity + SNAPSHOT) or {"version": 0}
        resource = _resource(family, entity)
        through = self.span(family, resource, self.state.load(family, resource))[1] - 1
        version = taken["version"] + 1
        path = f"{self.dataset(spec)}_snapshot/version={version}"
        # Already spread by key, one row each: nothing to rebalance.
        replace(self.bronze(family, entity), path, sort_by=[spec.key], shuffle=False)
        self.state.save(family, entity + SNAPSHOT, {"version": version, "through": through, "path": path, "columns": list(spec.columns)})
        return path


def _resource(family: str, entity: str) -> str:
    """The name under which a table's loads are counted."""
    return "historical" if family == "chat" else entity


def ingest_entity(
    lake: Lake,
    family: str,
    entity: str,
    source: str,
    load_date: date,
    *,
    record_schema: T.StructType | None = None,
    max_records: int | None = None,
    rescue: bool = False,
) -> dict[str, Any]:
    """Load one sales object or marketing resource; returns ``records`` moved now and ``path``.

    Only records modified since the last load's highest modification time are taken. Those
    at that very time are taken again: some may have changed after the extract, and the key
    removes the rest. The time is the raw record's, whether or not the table declares it; a
    record without one is always taken, as it may have changed. A resource already completed
    for ``load_date`` is left alone.

    ``max_records`` bounds an extract, which is off by default: of the records due, those modified first
    are taken (undated ones before), so the next load goes on where this one ended. It must exceed the number of
    records that share a modification time, which are taken together with those after them.

    With ``rescue`` (off by default), a page or record that can't be read does not fail the load: it goes to the table's
    quarantine (:func:`quarantined`), is counted as ``rejected``, and can be repaired and replayed (:func:`replay`).
    """
    spec = lake.spec(family, entity)
    path = lake.dataset(spec)
    last = lake.state.load(family, entity)
    first, load = lake.span(family, entity, last)
    last = last or {}
    if last.get("completed") and last.get("load_date") == load_date.isoformat():
        return {"records": 0, "path": path}

    return _load_records(lake, spec, source, load_date, last, (first, load), record_schema, max_records, rescue)


def _load_records(
    lake: Lake, spec: TableSpec, source: str, load_date: date, last: dict[str, Any], span: tuple[int, int],
    record_schema: T.StructType | None, max_records: int | None = None, rescue: bool = False, replayed: int | None = None,
) -> dict[str, Any]:
    """Land the records of ``source`` as a load; of rejected records that are replayed, all that are not outdated."""
    (first, load), family, entity, path = span, spec.family, spec.entity, lake.dataset(spec)
    rejects = Observation()
    if rescue:
        read = rescue_pages(lake.spark, source, family, entity, record_schema=record_schema)
        observed = read.observe(rejects, F.count_if(F.col(REJECTED).isNotNull()).alias("n"))
        records = observed.where(F.col(REJECTED).isNull()).drop(REJECTED)
    else:
        records = read_pages(lake.spark, source, family, entity, record_schema=record_schema)
    if family == "marketing":
        records = flatten_properties(records)
    times = [F.col(f"`{m}`").cast("string") for m in spec.modified if m in records.columns]
    records = records.withColumn(MODIFIED, first_filled(*times) if times else F.lit(None).cast("string"))
    mark = last.get("last_modified")
    columns = tuple((name, TEXT if spec.as_text else kind) for name, kind in spec.columns)
    stored = dataclasses.replace(spec, columns=(*columns, (MODIFIED, TEXT)))
    due = records if replayed is not None else modified_since(records, (MODIFIED,), mark, inclusive=True)
    if max_records is not None:
        due = due.orderBy(F.col(MODIFIED).asc_nulls_first(), spec.key).limit(max_records)
    rows = coerce(due, stored)
    if replayed is not None:
        rows = _not_outdated(rows, lake._loads(spec, first, load), spec.keys)
    rows = rows.withColumns(_partition_values(lake, family, load_date))
    done = land_folder(rows, f"{path}/load={load}", PARTITIONS[family], [spec.key], {"newest": F.max(MODIFIED)})
    moved = {"records": done["rows"], "path": path}
    aside = f"{_quarantine(lake, spec)}/load={load}"
    if rescue:
        moved["rejected"] = rejects.get["n"]
    if moved.get("rejected"):  # the pages are read again, for these
        why = read.where(F.col(REJECTED).isNotNull()).select(f"{REJECTED}.*", F.lit(load_date.isoformat()).alias("load_date"))
        why.write.mode("overwrite").parquet(aside)
    elif exists(lake.spark, aside):
        delete(lake.spark, aside)  # of a load that died

    newest = done["newest"] if replayed is None else None  # a replay is no extract and moves no mark
    saved = {
        "completed": True if replayed is None else last.get("completed", False),
        "load_date": load_date.isoformat() if replayed is None else last.get("load_date"),
        "records": done["rows"],
        "path": path,
        "loads": load + 1,
        "since": first,
        "last_modified": max(filter(None, (mark, newest)), default=None),
    }
    if replayed is not None or "replayed" in last:
        saved["replayed"] = replayed if replayed is not None else last["replayed"]
    lake.state.save(family, entity, saved)
    return moved


def _not_outdated(rows: DataFrame, landed: DataFrame, keys: list[str]) -> DataFrame:
    """Rows at least as new as the landed ones of their key; without a time, those whose key has not landed."""
    held = latest_per_key(landed.select(*keys, MODIFIED, "load"), keys, ["load", MODIFIED])
    held = held.select(*keys, F.struct(MODIFIED).alias("_held"))
    newer = F.col("_held").isNull() | F.coalesce(F.col(MODIFIED) >= F.col("_held")[MODIFIED], F.lit(False))
    return join_on(rows, held, keys, "left").where(newer).select(rows.columns)


def _quarantine(lake: Lake, spec: TableSpec) -> str:
    return f"{lake.root}/_quarantine/{spec.family}/{spec.entity}"


def quarantined(lake: Lake, family: str, entity: str, *, all_loads: bool = False) -> DataFrame:
    """What loads rejected and no replay took up yet: ``file, place, reason, text, load_date, load``.

    ``place`` is the record's in its page, -1 for a whole page. ``all_loads`` shows those that were replayed too.
    """
    spec = lake.spec(family, entity)
    first, following = lake.span(family, entity, last := lake.state.load(family, entity))
    shape = "file string, place int, reason string, text string, load_date string, load int"
    if not exists(lake.spark, _quarantine(lake, spec)):
        return lake.spark.createDataFrame([], shape)
    since = first if all_loads else max(first, (last or {}).get("replayed", first))
    rows = lake.spark.read.schema(shape).parquet(_quarantine(lake, spec))
    return rows.where((F.col("load") >= since) & (F.col("load") < following))


def replay(lake: Lake, family: str, entity: str, repair: Callable[[Column], Column], load_date: date) -> dict[str, Any]:
    """Load the repaired texts of the quarantine, each once.

    ``repair`` turns a rejected text into that of a record or a page; null leaves it out for good. What can't be
    read after it is quarantined again, by the number of this load. Records older than what has landed of their key since are
    left out. The state says in one save that the load counts and what it replayed, so a replay that died is repeated.
    """
    spec = lake.spec(family, entity)
    last = lake.state.load(family, entity) or {}
    first, load = lake.span(family, entity, last or None)
    field = page_field(family, entity)
    mended = quarantined(lake, family, entity).select("place", repair(F.col("text")).alias("text")).where("text IS NOT NULL")
    flat = F.regexp_replace("text", "[\r\n]+", " ")  # a page is a line; within JSON texts line ends are escaped
    page = F.when(F.col("place") < 0, flat).otherwise(F.concat(F.lit(f'{{"{field}":['), flat, F.lit("]}")))
    source = f"{lake.root}/_quarantine/_replays/{family}/{entity}/load={load}"
    mended.select(page.alias("value")).write.mode("overwrite").text(source)
    texts = T.StructType([T.StructField(n, T.StringType()) for n in dict.fromkeys([*spec.names, *spec.modified])])
    shape = texts if spec.as_text else None
    return _load_records(lake, spec, source, load_date, last, (first, load), shape, rescue=True, replayed=load)


def ingest_custom(lake: Lake, entity: str, source: str, load_date: date, *, key: str = "Id") -> dict[str, Any]:
    """Load a sales object that has no declaration, typed by what its pages hold.

    The declaration is saved in the lake, so any session can read the table. Later loads add
    fields and widen whole numbers to fractional ones; other types stay as first declared, and
    values that don't fit are coerced. Values are landed as text and typed when read. Declare the
    table yourself to fix its types.
    """
    shape = infer_record(lake.spark, source, "sales", entity)
    try:
        old = lake.spec("sales", entity)
    except KeyError:
        old = None
    if old is None or old.as_text:
        found = spec_from_schema("sales", entity, shape, key)
        kinds = dict(old.columns) if old else {}
        for name, kind in found.columns:
            known = kinds.setdefault(name, kind)
            if known in (INT, LONG) and kind in (LONG, DOUBLE):
                kinds[name] = kind
        spec = dataclasses.replace(found, columns=tuple(kinds.items()), modified=SALES["Account"].modified, as_text=True)
        if spec != old:
            lake.declare(spec)
            saved = {"columns": list(spec.columns), "key": spec.key, "modified": list(spec.modified)}
            lake.state.save(DECLARED + "sales", entity, saved)
    return ingest_entity(lake, "sales", entity, source, load_date, record_schema=shape)


def _partition_values(lake: Lake, family: str, load_date: date, kind: str = "") -> dict[str, Column]:
    values = {
        "org_id": lake.org_id,
        "kind": kind,
        "ingest_date": load_date.isoformat(),
        "year": f"{load_date.year}",
        "month": f"{load_date.month:02d}",
    }
    return {name: F.lit(values[name]) for name in PARTITIONS[family]}


def backfill_chat(
    lake: Lake,
    load_date: date,
    *,
    messages: str,
    replies: str | None = None,
    channels: str | None = None,
    users: str | None = None,
) -> dict[str, Any]:
    """Load chat history of all channels in one job, from each channel's mark on.

    Replies are taken to all threads landed so far, also when no new message came; those that
    are landed already are left out. Messages without a readable time are always taken. Page folders of messages and replies are named ``channel_id=<id>``.
    """
    spark, spec = lake.spark, CHAT["messages"]
    last = lake.state.load("chat", "historical")
    first, load = lake.span("chat", "historical", last)
    last = last or {}
    dimensions = set(last.get("dimensions", []))
    if users is not None:
        rows = coerce(flatten_users(read_pages(spark, users, "chat", "users")), CHAT["users"])
        replace(rows, lake.dataset(CHAT["users"]), sort_by=["id"])
        dimensions.add("users")
    if channels is not None:
        rows = coerce(flatten_channels(read_pages(spark, channels, "chat", "channels")), CHAT["channels"])
        replace(rows, lake.dataset(CHAT["channels"]), sort_by=["id"])
        dimensions.add("channels")
    names = lake.bronze("chat", "channels") if "channels" in dimensions else None

    marks = channel_marks(lake)
    path = lake.dataset(spec)

    def put(rows: DataFrame, kind: str) -> int:
        rows = coerce(normalize_messages(rows, F.lit(load_date.isoformat()), names), spec)
        rows = rows.withColumns(_partition_values(lake, "chat", load_date, kind)).drop("kind")
        return land_folder(rows, f"{path}/load={load}/kind={kind}", ["ingest_date"], ["channel_id", "message_ts"])["rows"]

    def landed(kind: str, since: int, until: int) -> DataFrame:
        return lake.landed(spec).where((F.col("load") >= since) & (F.col("load") <= until) & (F.col("kind") == kind))

    # Threads are looked up in what has just landed, so the message pages are parsed once.
    found = read_pages(spark, messages, "chat", "messages")
    count = put(newer_than(found, marks, "channel_id", epoch(F.col("ts")), epoch(F.col("mark"))), "message")
    threads = 0
    if replies is not None:
        own = thread_replies(landed("message", first, load), read_pages(spark, replies, "chat", "messages"))
        known = landed("reply", first, load - 1).select("channel_id", F.col("message_ts").alias("ts"))
        threads = put(join_on(own, known, ["channel_id", "ts"], "left_anti").select(own.columns), "reply")

    # The load number moves on before the marks: dying in between repeats rows in the next
    # load, which the key removes, instead of losing them.
    lake.state.save(
        "chat",
        "historical",
        {
            "completed": True,
            "load_date": load_date.isoformat(),
            "records": count,
            "replies": threads,
            "dimensions": sorted(dimensions),
            "path": path,
            "loads": load + 1,
            "since": first,
        },
    )
    if count:
        _save_marks(lake, landed("message", load, load), marks)
    return {"records": count + threads, "path": path}


def channel_marks(lake: Lake) -> DataFrame:
    """``channel_id, mark`` of every channel loaded so far."""
    saved = lake.state.current("chat").where(F.col("resource").startswith(BACKFILL))
    return saved.select(
        F.expr(f"substring(resource, {len(BACKFILL) + 1})").alias("channel_id"),
        F.get_json_object("state", "$.last_message_ts").alias("mark"),
    )


def channel_report(lake: Lake, load_date: date | None = None) -> DataFrame:
    """Messages and thread replies loaded per channel, and the newest message of each."""
    first, following = lake.span("chat", "historical", lake.state.load("chat", "historical"))
    landed = lake.landed(CHAT["messages"]).where((F.col("load") >= first) & (F.col("load") < following))
    if load_date is not None:
        landed = landed.where(F.col("ingest_date") == load_date.isoformat())
    is_message = F.col("kind") == "message"
    newest = F.max(F.when(is_message, epoch_key(F.col("message_ts"))))
    return landed.groupBy("channel_id", "channel_name").agg(
        F.lit(st.COMPLETED).alias("status"),
        F.count_if(is_message).alias("messages_fetched"),
        F.count_if(~is_message).alias("threads_fetched"),
        epoch_text(newest).alias("last_message_ts"),
    )


def _save_marks(lake: Lake, messages: DataFrame, marks: DataFrame) -> None:
    # Of messages only: replies may be newer than messages not yet exported.
    stamps = messages.select("channel_id", F.col("message_ts").alias("ts"))
    merged = high_water_marks(stamps.unionByName(marks.withColumnRenamed("mark", "ts")), "channel_id", "ts")
    lake.state.save_all(
        merged.select(
            F.lit("chat").alias("pipeline"),
            F.concat(F.lit(BACKFILL), F.col("channel_id")).alias("resource"),
            F.to_json(F.struct(F.lit(True).alias("completed"), F.col("mark").alias("last_message_ts"))).alias("state"),
        )
    )


def run_all(
    lake: Lake, family: str, loads: dict[str, Callable[[], dict[str, Any]]], *, parallel: int = 4
) -> DataFrame:
    """Run named loads, a few at a time, and return one report row each.

    Each load is its own Spark job; a failed one does not stop the others. Loads not begun
    when the pipeline is paused are reported as paused. The pipeline's final state follows
    from the report.
    """
    lake.runs.set(family, st.RUNNING)

    def run(resource: str) -> tuple:
        begun = time.time()
        if lake.runs.get(family) == st.PAUSED:
            return (family, resource, st.PAUSED, 0, None, begun, 0.0, None)
        try:
            done = loads[resource]()
            status, records, path, error = st.COMPLETED, done["records"], done["path"], None
        except Exception as e:
            status, records, path, error = st.FAILED, 0, None, f"{type(e).__name__}: {e}"
        return (family, resource, status, records, path, begun, round(time.time() - begun, 2), error)

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        rows = list(pool.map(inheritable_thread_target(lake.spark)(run), loads))
    ended = {row[2] for row in rows}
    lake.runs.set(family, next((s for s in (st.FAILED, st.PAUSED) if s in ended), st.COMPLETED))
    report = lake.spark.createDataFrame(rows, st.REPORT_SCHEMA)
    lake.reports.add(report)
    return report


def status(lake: Lake, family: str) -> tuple[str, DataFrame, DataFrame]:
    """Run state of a family, the newest report row of each resource, and their summary."""
    newest = lake.reports.newest(family)
    return lake.runs.get(family), newest, run_summary(newest)


def run_family(
    lake: Lake, family: str, sources: dict[str, str], load_date: date, *, parallel: int = 4, **options
) -> DataFrame:
    """Load the given entities of a batch family from their page folders."""

    def load(entity: str, source: str) -> Callable[[], dict[str, Any]]:
        return lambda: ingest_entity(lake, family, entity, source, load_date, **options)

    return run_all(lake, family, {e: load(e, s) for e, s in sources.items()}, parallel=parallel)


def pause(lake: Lake, family: str, mode: str = "batch") -> None:
    lake.runs.set(family, st.PAUSED, mode)


def resume(lake: Lake, family: str, mode: str = "batch") -> None:
    lake.runs.set(family, st.RUNNING, mode)


def reset(lake: Lake, family: str) -> None:
    """Forget all state of a family, so that the next run loads everything again.

    Tables are empty until then: only loads after the reset are read, under new numbers. The
    number after the next is noted, as a load may have died in the next one's folder.
    """
    counted = lake.state.current(family).withColumn("_n", F.get_json_object("state", "$.loads").cast("long"))
    following = F.to_json(F.struct((F.col("_n") + 1).alias("loads")))
    lake.state.save_all(
        counted.where(F.col("_n").isNotNull()).select(
            F.concat(F.lit(RESETS), "pipeline").alias("pipeline"), "resource", following.alias("state")
        )
    )
    lake.state.clear(family)
