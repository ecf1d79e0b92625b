"""Snapshots, run logs, gates, ingest and the catalogue."""

from __future__ import annotations

import os
import threading
import time
import uuid
from dataclasses import replace
from graphlib import CycleError
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampType,
)

from lakestrata.functions.expressions import variant_kind
from lakestrata.functions.schemas import merged_schema, schema
from lakestrata.jobs import main
from lakestrata.plans.control import (
    LANDING_RUN,
    RAW_RUN,
    TABLE_RUN,
    Run,
    append_run,
    append_runs,
    control_or_empty,
    is_stale,
    last_run_time,
    plan_load,
    read_control,
    unread_dates,
)
from lakestrata.plans.ingest import land as land_pages
from lakestrata.plans.ingest import (
    apply_batches,
    batch_path,
    import_enums,
    land_full,
    land_incremental,
    read_rejected,
)
from lakestrata.plans.lake import LANDING, RAW, Lake, TableId
from lakestrata.plans.retention import expire_layer
from lakestrata.plans.runner import TableSpec, build_all, failures
from lakestrata.sources import folders, snapshot
from lakestrata.sources.catalog import ddl_type, discover_tables, sync_catalog
from lakestrata.sources.files import read_enum_dir, read_or_none, write_json_pages
from lakestrata.sources.log import append_rows, log_folder, read_log
from lakestrata.sources.scratch import clear_scratch, materialize, scratch_dropped, scratch_path, shared_dir
from lakestrata.sources.snapshot import (
    Layout,
    expire_versions,
    read_snapshot,
    snapshot_history,
    snapshot_layout,
    touched_rows,
    upsert_snapshot,
    write_snapshot,
)

SOURCE, TARGET = TableId(LANDING, "things", "shop"), TableId(RAW, "things", "shop")


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def landing_run(at: int, files: int = 1) -> dict:
    return {
        "Exec_date": "-",
        "Exec_time": at,
        "Load_type": "Incremental",
        "Loaded_files": files,
        "Total_duration": "00:00:00",
    }


# --- scratch -----------------------------------------------------------------


def test_scratch_uses_the_shared_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    unset = SimpleNamespace(conf={"spark.sql.warehouse.dir": "s3a://shared/warehouse/"})
    assert shared_dir(unset) == "s3a://shared/warehouse"
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


# --- snapshots ---------------------------------------------------------------


def test_versions_stay_readable(spark, frame, rows, tmp_path):
    path = str(tmp_path / "t")
    assert read_snapshot(spark, path, required=False) is None
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, path)
    first = write_snapshot(frame("a long", (1,), (2,)), path)
    second = write_snapshot(frame("a long, b string", (3, "x")), path)
    assert (first.version, first.rows, second.version, second.rows) == (0, 2, 1, 1)
    assert rows(read_snapshot(spark, path)) == [(3, "x")]
    assert rows(read_snapshot(spark, path, 0)) == [(1,), (2,)]
    assert [r["version"] for r in snapshot_history(spark, path).collect()] == [1, 0]
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, path, 7)


def test_fixed_schema_is_enforced(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    write_snapshot(frame("a long, b string", (1, "x")), path, evolve=False)
    write_snapshot(frame("b string, a long", ("x", 1)), path, evolve=False)
    with pytest.raises(ValueError, match="would change"):
        write_snapshot(frame("a string, b string", ("1", "x")), path, evolve=False)


def test_failed_write_is_not_seen(spark, frame, rows, tmp_path):
    path = str(tmp_path / "t")
    write_snapshot(frame("a long", (1,)), path)
    broken = frame("a long", (1,)).select(F.raise_error(F.lit("broken")).cast("long").alias("a"))
    with pytest.raises(Exception, match="broken"):
        write_snapshot(broken, path)
    assert rows(read_snapshot(spark, path)) == [(1,)]
    assert write_snapshot(frame("a long", (2,)), path).version == 1


def test_table_can_be_rebuilt_from_itself(spark, frame, rows, tmp_path):
    path = str(tmp_path / "t")
    write_snapshot(frame("a long", (1,)), path)
    write_snapshot(read_snapshot(spark, path).select((F.col("a") + 1).alias("a")), path)
    assert rows(read_snapshot(spark, path)) == [(2,)]


def test_empty_table_and_sorted_files(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    assert write_snapshot(frame("a long"), path).rows == 0
    assert read_snapshot(spark, path).count() == 0
    written = write_snapshot(spark.range(100).orderBy(F.desc("id")), path, sort_by=["id"])
    assert written.rows == 100


def test_a_sorted_write_reads_its_sources_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)
    source = spark.range(1000, numPartitions=4)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    counted = source.mapInArrow(count, "id long")
    write_snapshot(counted, str(tmp_path / "t"), sort_by=["id"])
    assert seen.value == 1000


def test_scratch_is_cleared(spark, tmp_path):
    written = materialize(spark.range(3), "gone").inputFiles()
    assert written
    clear_scratch(spark)
    assert not any(os.path.exists(f.removeprefix("file://")) for f in written)


def test_tables_at_any_depth_are_found(spark, tmp_path):
    deep = "raw/a/b/c/d/e"
    write_snapshot(spark.range(2), str(tmp_path / deep))
    (tmp_path / "raw/a/2024-01-01/history").mkdir(parents=True)  # a landing date, no table
    found = discover_tables(spark, str(tmp_path), "raw", "history").collect()
    assert [(f["name"], f["path"]) for f in found] == [("raw_a_b_c_d_e", str(tmp_path / deep))]
    assert discover_tables(spark, str(tmp_path), "nothing", "history").count() == 0


# --- gates -------------------------------------------------------------------


def log(frame, *times):
    return frame("Exec_time long", *((t,) for t in times))


def test_gate_is_strict(frame):
    assert is_stale(log(frame), [log(frame, 5)])
    assert not is_stale(log(frame, 5), [log(frame, 5)])
    assert is_stale(log(frame, 5), [log(frame, 1), log(frame, 6), log(frame, 2)])
    assert not is_stale(log(frame, 5), [log(frame), log(frame, 4)])


def test_plan_load(frame):
    assert plan_load(log(frame)) == ("Initial", None)
    assert plan_load(log(frame, 3, 9)) == ("Incremental", 9)


def test_unread_dates(frame):
    landed = frame(
        "Exec_time long, Loaded_files long",
        (1704070800, 1),  # 2024-01-01 01:00 UTC: still the day before
        (1704078000, 0),  # loaded nothing
        (1704164400, 2),  # 2024-01-02
        (1704168000, 1),  # 2024-01-02 again
    )
    dates = lambda df: [r[0] for r in df.collect()]
    assert dates(unread_dates(landed, None)) == ["2023-12-31", "2024-01-02"]
    read = frame("Loaded_date string, Exec_time long", ("2024-01-02", 1704166000))
    assert dates(unread_dates(landed, read)) == []
    assert dates(unread_dates(landed, read, same_day=True)) == ["2024-01-02"]
    nothing = frame("Loaded_date string, Exec_time long")
    assert len(dates(unread_dates(landed, nothing))) == 2


def test_run_log_roundtrip(spark, tmp_path):
    path = str(tmp_path / "control")
    assert control_or_empty(spark, path, TABLE_RUN).count() == 0
    run = Run(started=time.time() - 3725)
    append_run(spark, path, TABLE_RUN, run.record(Table_Rows=3))
    append_run(spark, path, TABLE_RUN, Run(started=10.0).record(Table_Rows=1))
    newest = read_control(spark, path).orderBy(F.desc("Exec_time")).first()
    assert newest["Total_duration"].startswith("01:02:0")
    assert last_run_time(read_control(spark, path)) == int(run.started)


def test_a_log_of_many_files_becomes_one_and_reads_the_same(spark, tmp_path, rows):
    path = str(tmp_path / "control")
    columns = schema(n=LongType(), note=StringType())
    files = lambda: len(list((tmp_path / "control").rglob("*.parquet")))
    for n in range(10):
        append_rows(spark, path, columns, [{"n": n, "note": None if n % 2 else "x"}], most_files=3)
        assert [r[0] for r in rows(read_log(spark, path, columns))] == list(range(n + 1))
        assert len(list(Path(log_folder(spark, path).removeprefix("file:")).glob("*.parquet"))) <= 3
    assert log_folder(spark, path).endswith("/g000003")
    assert not (tmp_path / "control" / "g000001").exists()  # the one before the last goes, the last one stays
    assert (tmp_path / "control" / "g000002").exists() and files() < 9


def test_a_compaction_that_fails_half_way_is_not_seen(spark, tmp_path, rows):
    path = str(tmp_path / "control")
    columns = schema(n=LongType())
    append_rows(spark, path, columns, [{"n": 1}])
    (tmp_path / "control" / "g000001").mkdir()
    (tmp_path / "control" / "g000001" / "part-0.parquet").write_text("torn")
    assert rows(read_log(spark, path, columns)) == [(1,)]
    append_rows(spark, path, columns, [{"n": 2}], most_files=1)
    assert rows(read_log(spark, path, columns)) == [(1,), (2,)]
    assert log_folder(spark, path).endswith("/g000001")


def test_scratch_made_inside_is_dropped(spark, tmp_path):
    kept = materialize(spark.range(3), "kept")
    with scratch_dropped(spark):
        inside = materialize(spark.range(4), "inside")
        assert inside.count() == 4
        path = Path(inside.inputFiles()[0].removeprefix("file://")).parent
    assert kept.count() == 3 and not path.exists()


def test_a_cluster_needs_a_shared_folder():
    def session(master, **conf):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d)), sparkContext=SimpleNamespace(master=master))

    warehouse = "spark.sql.warehouse.dir"
    assert shared_dir(session("local[4]", **{warehouse: "file:/home/x/"})) == "file:/home/x"
    assert shared_dir(session("yarn", **{warehouse: "hdfs://a/b"})) == "hdfs://a/b"
    assert shared_dir(session("yarn", **{warehouse: "file:/x", "spark.checkpoint.dir": "s3a://c/"})) == "s3a://c"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session("spark://host:7077", **{warehouse: "file:/home/x"}))


# --- tables in parts, retention ----------------------------------------------


def test_an_update_of_few_clustered_keys_leaves_most_files_alone(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    base = spark.range(10_000).select("id", (F.col("id") * 2).alias("v"))
    assert upsert_snapshot(base, path, "id", layout=Layout("id", "range", 500)).parts_written == 20
    before = {f: f.stat().st_mtime_ns for f in tmp_path.rglob("data/**/*.parquet")}
    update = spark.range(7100, 7200).select("id", F.lit(-1).cast("long").alias("v"))
    done = upsert_snapshot(update, path, "id")
    assert (done.version, done.rows, done.parts_written) == (1, 10_000, 1)
    after = {f: f.stat().st_mtime_ns for f in tmp_path.rglob("data/**/*.parquet")}
    assert before.items() <= after.items() and len(after) == len(before) + 1
    got = read_snapshot(spark, path)
    assert got.columns == ["id", "v"] and got.count() == 10_000
    assert got.where("v = -1").agg(F.min("id"), F.max("id")).first()[:] == (7100, 7199)
    assert read_snapshot(spark, path, 0).where("v = -1").isEmpty()
    # Only the folder of the part with the key is read for the next update.
    assert {Path(f).parent.name for f in touched_rows(update, path).inputFiles()} == {"__part=14"}


@pytest.mark.parametrize("layout", [Layout("id", "range", 10), Layout("id", "hash", 4)])
def test_upserts_in_parts_equal_upserts_of_the_whole(spark, frame, rows, tmp_path, layout):
    parted, plain = str(tmp_path / "parted"), str(tmp_path / "plain")
    batches = [
        frame("id long, a string, n long", *((i, f"a{i}", i) for i in range(-15, 40, 3)), (None, "no key", 0)),
        frame("id long, n long, b double", (3, -3, 0.5), (100, 1, None), (-7, 2, 2.5)),  # lacks a, brings b
        frame("id long, a string, n long, b double"),
        frame("id long, a string, n long, b double", (0, None, None, None), (55, "x", 5, 5.5)),
    ]
    for batch in batches:
        for path, how in ((parted, layout), (plain, None)):
            upsert_snapshot(batch, path, "id", layout=how)
        one, other = read_snapshot(spark, parted), read_snapshot(spark, plain)
        assert one.columns == other.columns
        assert rows(one) == rows(other)
    assert snapshot_layout(spark, parted) == layout and snapshot_layout(spark, plain) is None
    upsert_snapshot(batches[3].withColumn("n", F.lit(1.5)), parted, "id")  # another type: all is rewritten
    assert dict(read_snapshot(spark, parted).dtypes)["n"] == "double"
    newest = snapshot_history(spark, parted).first()
    assert {p["run"] for p in newest["parts"]} == {newest["run"]}
    with pytest.raises(ValueError):
        upsert_snapshot(batches[0], parted, "n")
    with pytest.raises(ValueError):
        Layout("id", "list", 3)


def test_many_parts_share_folders(lake, spark, frame, rows):
    layer = f"l{uuid.uuid4().hex[:8]}"
    table = TableId(layer, "things")
    path, plain = lake.path(table), f"{lake.root}/plain"
    ddl = "id long, v string, n long"
    batches = [
        spark.range(-5, 6000).select("id", F.concat(F.lit("a"), "id").alias("v"), F.lit(0).cast("long").alias("n")),
        frame(ddl, (3, "b3", 1), (17, None, 1), (9000, "new", 1)),
        spark.range(0, 6000, 20).select("id", F.lit(2).cast("long").alias("n")),  # lacks v; packs again
        frame(ddl, (3, "c3", 3), (40, "c40", 3)),
    ]
    written = []
    for batch in batches:
        written.append(upsert_snapshot(batch, path, "id", layout=Layout("id", "range", 10)).parts_written)
        upsert_snapshot(batch, plain, "id")
        assert rows(read_snapshot(spark, path)) == rows(read_snapshot(spark, plain))
    assert written == [600, 3, 300, 2]
    folders_of = [len(list(f.glob("__pa*"))) for f in sorted(Path(path, "data").iterdir())]
    assert 100 < folders_of[0] <= 256 and 100 < folders_of[2] <= 256 and folders_of[1::2] == [3, 2]
    newest = snapshot_history(spark, path).first()
    assert len(newest["parts"]) == 601 and sum(p["rows"] for p in newest["parts"]) == newest["rows"] == 6006
    assert rows(read_snapshot(spark, path, 1)) == rows(read_snapshot(spark, plain, 1))
    # Of the folders, an update reads those with a key of its own, and of them only its parts.
    touched = touched_rows(frame(ddl, (41, "x", 0)), path)
    assert rows(touched, "id") == [(i,) for i in range(40, 50)] and len(touched.inputFiles()) == 1

    def sync():
        return [(r["table"], r["action"], r["columns"]) for r in sync_catalog(spark, lake.root, (layer,), ()).collect()]

    name = f"{layer}_things"
    assert sync() == [(name, "created", "id bigint, v varchar, n bigint")]
    assert sync()[0][1] == "unchanged"
    registered = rows(spark.table(f"{layer}.{name}"), "id", "v", "n", "__part")
    expected = read_snapshot(spark, plain).withColumn("__part", F.expr("id div 10"))
    assert registered == rows(expected, "id", "v", "n", "__part")
    upsert_snapshot(frame(ddl, (0, "d", 4)), path, "id")
    assert expire_versions(spark, path, older_than=int(time.time()) + 9) == [0, 1, 2, 3]
    upsert_snapshot(frame(ddl, (0, "d", 4)), plain, "id")
    assert rows(read_snapshot(spark, path)) == rows(read_snapshot(spark, plain))
    assert not list(Path(path, "data").glob("*/whole")) and sync()[0][1] == "recreated"


def test_packs_hold_neighbouring_parts_and_few_rows():
    def packs(sizes):
        found = snapshot._packed([{"part": n, "rows": r} for n, r in reversed(list(enumerate(sizes)))])
        return [(p["part"], p.get("pack"), p.get("packed")) for p in found]

    assert {p[1] for p in packs([10**9] * 256)} == {None}
    assert [p[1] for p in packs([1] * 257)][:5] == [0, 0, 1, 1, 2] and packs([1] * 257)[-1] == (256, 128, 1)
    assert [p[1] for p in packs([600_000] * 300)] == list(range(300))


def test_batches_applied_in_parts(lake, frame, rows):
    ddl = "id long, name string, updated_at long"
    first = frame(ddl, *((i, f"n{i}", 1) for i in range(100)))
    land(lake, frame, "2024-01-01", DAY1, first)
    apply_batches(lake, "shop", "things", layout=Layout("id", "range", 10))
    land(lake, frame, "2024-01-02", DAY2, frame(ddl.replace("name string, ", ""), (5, 2), (101, 2)))
    assert apply_batches(lake, "shop", "things") == 101
    newest = snapshot_history(lake.spark, lake.path(TARGET)).first()
    assert sum(p["run"] == newest["run"] for p in newest["parts"]) == 2
    got = dict(rows(lake.read(TARGET), "id", "name"))
    assert (got[5], got[101], got[99]) == ("n5", None, "n99")
    land(lake, frame, "2024-01-03", DAY3, frame("id string, name string, updated_at long", ("x7", "seven", 3)))
    assert apply_batches(lake, "shop", "things") == 102  # the key became text: rewritten
    assert dict(rows(lake.read(TARGET), "id", "name"))["5"] == "n5"


def test_old_versions_go_and_what_is_read_stays(spark, frame, rows, tmp_path):
    path = str(tmp_path / "t")
    for n in range(4):
        write_snapshot(frame("n long", (n,)), path)
    times = {r["version"]: r["timestamp"] for r in snapshot_history(spark, path).collect()}
    assert expire_versions(spark, path, older_than=times[0] - 1) == []
    assert expire_versions(spark, path, older_than=times[3] + 9, read_at=[times[0] - 1, None]) == []
    assert expire_versions(spark, path, older_than=times[3] + 9, keep=2) == [0, 1]
    with pytest.raises(FileNotFoundError, match="version 1 of .* was removed on"):
        read_snapshot(spark, path, 1)
    with pytest.raises(FileNotFoundError, match="no version 9"):
        read_snapshot(spark, path, 9)
    assert rows(read_snapshot(spark, path, 2)) == [(2,)] and rows(read_snapshot(spark, path)) == [(3,)]
    assert len(list((tmp_path / "t" / "data").iterdir())) == 2
    assert expire_versions(spark, path, older_than=times[3] + 9, keep=2) == []
    assert write_snapshot(frame("n long", (4,)), path).version == 4
    with pytest.raises(ValueError):
        expire_versions(spark, path, older_than=0, keep=0)


def test_shared_parts_outlive_the_version_that_wrote_them(spark, frame, rows, tmp_path):
    path = str(tmp_path / "t")
    upsert_snapshot(frame("id long, v long", (1, 1), (11, 1), (21, 1)), path, "id", layout=Layout("id", "range", 10))
    upsert_snapshot(frame("id long, v long", (1, 2)), path, "id")
    upsert_snapshot(frame("id long, v long", (1, 3), (11, 3)), path, "id")
    assert expire_versions(spark, path, older_than=int(time.time()) + 9) == [0, 1]
    assert rows(read_snapshot(spark, path)) == [(1, 3), (11, 3), (21, 1)]
    left = sorted(f"{p.parent.name[:6]}/{p.name}" for p in (tmp_path / "t" / "data").glob("*/__part=*"))
    assert left == ["000000/__part=2", "000002/__part=0", "000002/__part=1"]


def test_a_layer_keeps_what_its_readers_have_not_seen(lake, frame):
    specs = _specs(lake, ("mart", ["a"], lambda l: l.read(TableId(RAW, "a", "shop"))))
    path = lake.path(TableId(RAW, "a", "shop"))
    write_snapshot(frame("id long", (9,)), path)
    assert build_all(lake, specs)[0].state == "built"
    time.sleep(1.1)
    write_snapshot(frame("id long", (10,)), path)
    write_snapshot(frame("id long", (11,)), path)
    later = int(time.time()) + 9
    assert expire_layer(lake, RAW, older_than=later, readers=specs) == [("raw/shop/a", 0)]
    assert main(["expire", "--root", lake.root, "--layer", "raw", "--older-than", "1"], lake.spark) == []
    assert expire_layer(lake, RAW, older_than=later, readers=()) == [("raw/shop/a", 1), ("raw/shop/a", 2)]


# --- ingest ------------------------------------------------------------------


def land(lake, frame, date: str, at: int, df, name: str = "1") -> None:
    write_json_pages(df, f"{batch_path(lake, SOURCE, date)}/{name}", 2)
    append_runs(lake.spark, lake.control_path(SOURCE), LANDING_RUN, [landing_run(at)])


DAY1, DAY2, DAY3 = 1704121200, 1704207600, 1704294000  # noon of 2024-01-01, -02, -03 in GMT-3


def test_batches_apply_in_date_order(lake, frame, rows):
    ddl = "id long, name string, updated_at long"
    land(lake, frame, "2024-01-01", DAY1, frame(ddl, (1, "a", 5), (2, "b", 5), (2, "b0", 1)))
    # A later date wins even with an older modification time.
    land(lake, frame, "2024-01-02", DAY2, frame(ddl, (1, "a2", 3), (3, "c", 9)))
    assert apply_batches(lake, "shop", "things") == 3
    assert rows(lake.read(TARGET), "id", "name") == [(1, "a2"), (2, "b"), (3, "c")]
    log = read_control(lake.spark, lake.control_path(TARGET))
    assert rows(log, "Loaded_date", "Read_Rows") == [("2024-01-01", 2), ("2024-01-02", 2)]
    assert apply_batches(lake, "shop", "things") is None  # nothing new


def test_batch_without_a_column_keeps_stored_values(lake, frame, rows):
    land(lake, frame, "2024-01-01", DAY1, frame("id long, name string, n long", (1, "a", 1), (2, "b", 2)))
    apply_batches(lake, "shop", "things", order=None)
    land(lake, frame, "2024-01-02", DAY2, frame("id long, name string, extra string", (2, "z", "e")))
    land(lake, frame, "2024-01-03", DAY3, frame("id long, name string, n long", (3, "c", 3)))
    with pytest.raises(ValueError, match="'misspelt' is missing"):
        apply_batches(lake, "shop", "things", order="misspelt")
    assert apply_batches(lake, "shop", "things", order=None) == 3
    assert rows(lake.read(TARGET), "id", "name", "n", "extra") == [
        (1, "a", 1, None),
        (2, "z", 2, "e"),
        (3, "c", 3, None),
    ]


def test_dates_without_files_are_skipped(lake, frame):
    append_runs(lake.spark, lake.control_path(SOURCE), LANDING_RUN, [landing_run(DAY1)])
    assert apply_batches(lake, "shop", "things") is None


def test_combined_batches_equal_one_by_one(lake, spark, frame, rows, tmp_path):
    ddl = "id long, v long, updated_at long"
    days = [("2024-01-01", DAY1), ("2024-01-02", DAY2), ("2024-01-03", DAY3)]
    batches = [frame(ddl, *(((i * 7 + d) % 11, i, i % 5) for i in range(9))) for d in range(3)]
    other = Lake(spark, str(tmp_path / "other"))
    for (date, at), batch in zip(days, batches):
        land(lake, frame, date, at, batch)
        land(other, frame, date, at, batch)
        apply_batches(other, "shop", "things")
    apply_batches(lake, "shop", "things")
    assert rows(lake.read(TARGET)) == rows(other.read(TARGET))


def test_land_incremental_takes_only_newer_records(lake, frame):
    records = frame("id long, updated_at long", (1, 10), (2, 20))
    assert land_incremental(lake, SOURCE, records, "updated_at") > 0
    assert land_incremental(lake, SOURCE, records, "updated_at") == 0
    newer = frame("id long, updated_at long", (3, int(time.time()) + 1000))
    assert land_incremental(lake, SOURCE, newer, "updated_at") == 1
    kinds = [r["Load_type"] for r in read_control(lake.spark, lake.control_path(SOURCE)).collect()]
    assert sorted(kinds) == ["Incremental", "Incremental", "Initial"]


def test_land_full_only_when_changed(lake, frame):
    records = frame("id long, name string", (1, "a"), (2, None))
    assert land_full(lake, SOURCE, records) > 0
    assert land_full(lake, SOURCE, records) == 0
    more = records.union(frame("id long, name string", (3, "c")))
    assert land_full(lake, SOURCE, more, symmetric=False) == 0  # additions alone do not count
    assert land_full(lake, SOURCE, more) > 0
    assert land_full(lake, SOURCE, more) == 0
    assert land_full(lake, SOURCE, more.drop("name")) > 0
    log = read_control(lake.spark, lake.control_path(SOURCE))
    assert log.count() == 6


def test_an_unchanged_full_load_does_not_read_what_was_landed(lake, frame):
    things = frame("id long, name string, at timestamp", (1, "x", None), (2, None, None), (2, None, None))
    assert land_full(lake, SOURCE, things) > 0
    folder = f"{batch_path(lake, SOURCE, Run().date)}"
    os.rename(folder, f"{folder}-away")
    assert land_full(lake, SOURCE, things.repartition(2)) == 0  # its pages are gone
    for run in os.listdir(f"{folder}-away"):
        os.rename(f"{folder}-away/{run}", f"{folder}/{run}")
    assert land_full(lake, SOURCE, things.dropDuplicates()) == 0  # told apart by the digest, equal by rows
    assert land_full(lake, SOURCE, things.where("id = 2")) > 0


def test_pages_landed_without_a_digest_are_compared_by_rows(lake, frame):
    things = frame("id long, name string", (1, "x"), (2, None))
    run = Run(started=time.time() - 60)
    land_pages(lake, SOURCE, things, "Full", run)
    assert land_full(lake, SOURCE, things) == 0
    assert land_full(lake, SOURCE, things.withColumn("name", F.lit("y"))) > 0


def test_enum_import_follows_modification_times(lake, spark, rows, tmp_path):
    folder = tmp_path / "enums"
    folder.mkdir()
    (folder / "aux_enum_iso_country_code_countryname.csv").write_text("name;value\nÅland Islands;248\n")
    (folder / "igdb_enum_age_rating_content_description_category.csv").write_text("name;value\nX;1\nY;2\n")
    (folder / "readme.csv").write_text("something;else;altogether\nno;0;1\n")
    for file in folder.iterdir():
        os.utime(file, (1704121200, 1704121200))
    listed = read_enum_dir(spark, str(folder))
    assert rows(listed, "entity", "enum", "name", "value") == [
        ("age_rating_content_description", "category", "X", "1"),
        ("age_rating_content_description", "category", "Y", "2"),
        ("iso_country_code", "countryname", "Åland Islands", "248"),
    ]
    assert len(import_enums(lake, str(folder), "enums")) == 2
    assert import_enums(lake, str(folder), "enums") == []
    assert rows(lake.enum("enums", "iso_country_code", "countryname")) == [("Åland Islands", "248")]
    assert lake.enum("enums", "iso_country_code", "nope") is None


def test_a_changed_part_imports_the_whole_list(lake, spark, frame, rows, tmp_path):
    folder = tmp_path / "enums" / "shop_enum_things_kind.csv"
    folder.mkdir(parents=True)
    for name, text in (("a.csv", "name;value\nA;1\n"), ("b.csv", "name;value\nB;2\n")):
        (folder / name).write_text(text)
        os.utime(folder / name, (1704121200, 1704121200))
    assert import_enums(lake, str(tmp_path / "enums"), "enums") == ["things/kind"]
    (folder / "b.csv").write_text("name;value\nBB;2\n")
    os.utime(folder / "b.csv", (time.time() + 10, time.time() + 10))
    assert import_enums(lake, str(tmp_path / "enums"), "enums") == ["things/kind"]
    assert rows(lake.enum("enums", "things", "kind")) == [("A", "1"), ("BB", "2")]


def test_null_updates_do_not_depend_on_other_records(lake, frame, rows):
    ddl = "id long, x string, updated_at long"
    land(lake, frame, "2024-01-01", DAY1, frame(ddl, (1, "a", 1), (2, "b", 1)))
    apply_batches(lake, "shop", "things")
    land(lake, frame, "2024-01-02", DAY2, frame(ddl, (1, None, 2)))  # alone: x holds nothing but null
    apply_batches(lake, "shop", "things")
    land(lake, frame, "2024-01-03", DAY3, frame(ddl, (2, None, 2), (3, "c", 2)))
    apply_batches(lake, "shop", "things")
    assert rows(lake.read(TARGET), "id", "x") == [(1, None), (2, None), (3, "c")]
    assert dict(lake.read(TARGET).dtypes)["x"] == "string"


def test_bad_records_are_kept_apart(lake, frame, rows):
    for date, at in (("2024-01-01", DAY1), ("2024-01-02", DAY2)):
        lines = frame("value string", ('{"id": 1, "n": 5}',), ("{broken",), ('{"id": null, "n": 7}',), ('{"id": 2, "n": "text"}',))
        lines.write.text(f"{batch_path(lake, SOURCE, date)}/1")
        append_runs(lake.spark, lake.control_path(SOURCE), LANDING_RUN, [landing_run(at)])
        columns = schema(id=LongType(), n=LongType())
        assert apply_batches(lake, "shop", "things", order=None, schema=columns) == 1
    assert rows(lake.read(TARGET)) == [(1, 5)]
    kept = read_rejected(lake, "shop", "things").where("Loaded_date = '2024-01-02'")
    assert rows(kept, "record") == [('{"id": 2, "n": "text"}',), ('{"id":null,"n":7}',), ("{broken",)]
    log = read_control(lake.spark, lake.control_path(TARGET))
    assert rows(log, "Loaded_date", "Read_Rows", "Bad_Rows") == [("2024-01-01", 1, 3), ("2024-01-02", 1, 3)]


def test_types_widen_and_the_log_says_so(lake, frame, rows):
    land_incremental(lake, SOURCE, frame("id long, v long, updated_at long", (1, 5, 1)), "updated_at")
    apply_batches(lake, "shop", "things", same_day=True)
    assert dict(lake.read(TARGET).dtypes)["v"] == "bigint"
    for kind, value in (("double", 2.5), ("string", "x")):
        newer = frame(f"id long, v {kind}, updated_at long", (2, value, int(time.time()) + 1000))
        assert land_incremental(lake, SOURCE, newer, "updated_at") > 0
        time.sleep(1.1)  # the run log counts seconds
        assert apply_batches(lake, "shop", "things", same_day=True) == 2
    assert rows(lake.read(TARGET), "id", "v") == [(1, "5"), (2, "x")] or rows(lake.read(TARGET), "id", "v") == [(1, "5.0"), (2, "x")]
    changes = {r["Retyped"] for r in read_control(lake.spark, lake.control_path(TARGET)).collect()}
    assert "v: bigint -> double" in changes and any(c and c.endswith("-> string") for c in changes)


def test_variants_keep_what_a_field_holds(lake, frame, rows):
    land(lake, frame, "2024-01-01", DAY1, frame("id long, v struct<a:long,b:string>, n long, updated_at long", (1, (5, "x"), 7, 1), (2, None, 8, 1)))
    apply_batches(lake, "shop", "things", variants=True)
    land(lake, frame, "2024-01-02", DAY2, frame("id string, v struct<a:string,b:string>, n array<long>, updated_at long", ("1", ("five", "y"), [1, 2], 2), ("3", ("1", None), None, 2)))
    apply_batches(lake, "shop", "things", variants=True)
    held = lake.read(TARGET)
    assert dict(held.dtypes) == {"id": "string", "v": "struct<a:variant,b:string>", "n": "variant", "updated_at": "bigint"}
    got = held.select("id", variant_kind("v.a").alias("a"), F.col("v.b").alias("b"), F.to_json("n").alias("n"))
    assert rows(got) == [("1", "text", "y", "[1,2]"), ("2", None, None, "8"), ("3", "text", None, None)]
    # Text is the common type where variants were not asked for; a variant stays one.
    land(lake, frame, "2024-01-03", DAY3, frame("id string, n boolean, updated_at long", ("2", True, 3)))
    apply_batches(lake, "shop", "things")
    assert rows(lake.read(TARGET).select("id", variant_kind("n").alias("k"))) == [("1", "array"), ("2", "flag"), ("3", None)]


def test_merged_schema():
    a = schema(n=IntegerType(), f=LongType(), t=LongType(), s=StructType([]), l=ArrayType(LongType()))
    b = schema(n=LongType(), f=DoubleType(), t=BooleanType(), s=LongType(), l=ArrayType(DoubleType()), more=StringType())
    found = {f.name: f.dataType.simpleString() for f in merged_schema([a, b]).fields}
    assert found == {"n": "bigint", "f": "double", "t": "string", "s": "string", "l": "array<double>", "more": "string"}


def jobs_of(spark, work) -> int:
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    work()
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_the_number_of_jobs_does_not_grow_with_the_dates(spark, frame, rows, tmp_path):
    counts = []
    for n in (5, 40):
        many = Lake(spark, str(tmp_path / f"lake{n}"))
        runs = []
        for d in range(n):
            date = f"2024-{1 + d // 28:02d}-{1 + d % 28:02d}"
            write_json_pages(frame("id long, v long", (d, d), (0, d)), f"{batch_path(many, SOURCE, date)}/1")
            runs.append(landing_run(DAY1 + 86400 * (d + 3 * (d // 28))))
        append_runs(spark, many.control_path(SOURCE), LANDING_RUN, runs)
        counts.append(jobs_of(spark, lambda: apply_batches(many, "shop", "things", order=None)))
        assert many.read(TARGET).count() == n
    assert counts[1] <= counts[0] + 5  # no job per date; Spark lists over 32 folders in jobs of their own


def test_enum_with_another_header_is_refused(spark, tmp_path):
    (tmp_path / "a_enum_b_c.csv").write_text("value;name\n1;x\n")
    with pytest.raises(Exception, match="header"):
        read_enum_dir(spark, str(tmp_path)).collect()


# --- building and cataloguing ------------------------------------------------


def test_build_order_and_gate(lake, frame, rows):
    raw = TableId(RAW, "a", "shop")
    one, two = TableId("context", "a", "shop"), TableId("trust", "b")
    write_snapshot(frame("id long", (1,), (2,)), lake.path(raw))
    record = Run(started=time.time() - 100).record(Loaded_date="-", Read_Rows=2, Table_Rows=2)
    append_run(lake.spark, lake.control_path(raw), RAW_RUN, record)
    specs = [
        TableSpec(one, (raw,), lambda l: l.read(raw)),
        TableSpec(two, (one,), lambda l: l.read(one).agg(F.count("id").alias("n"))),
    ]
    assert [(r.built, r.rows) for r in build_all(lake, specs)] == [(True, 2), (True, 1)]
    assert [r.built for r in build_all(lake, specs)] == [False, False]
    newer = Run(started=time.time() + 100).record(Loaded_date="-", Read_Rows=0, Table_Rows=2)
    append_run(lake.spark, lake.control_path(raw), RAW_RUN, newer)
    assert build_all(lake, specs[:1])[0].version == 1


def _specs(lake, *tables):
    """(name, sources, transform) over raw table `a` with a run."""
    raw = TableId(RAW, "a", "shop")
    write_snapshot(lake.spark.range(3), lake.path(raw))
    append_run(lake.spark, lake.control_path(raw), RAW_RUN, Run(started=time.time() - 100).record(Table_Rows=3))
    named = {"a": raw} | {name: TableId("trust", name) for name, *_ in tables}
    return [TableSpec(named[n], tuple(named[s] for s in sources), f) for n, sources, f in tables]


def test_independent_tables_are_built_at_the_same_time(lake):
    met = threading.Barrier(2, timeout=60)  # breaks unless both transforms are inside at once
    groups = []

    def meet(l):
        met.wait()
        groups.append(l.spark.sparkContext.getLocalProperty("spark.jobGroup.id"))
        return l.spark.range(2)

    specs = _specs(lake, ("one", ["a"], meet), ("two", ["a"], meet), ("last", ["two", "one"], lambda l: l.spark.range(1)))
    last, two, one = specs[2], specs[1], specs[0]
    results = build_all(lake, [last, two, one])  # the order given does not matter
    assert [(r.table, r.state, r.rows) for r in results] == [("trust/last", "built", 1), ("trust/two", "built", 2), ("trust/one", "built", 2)]
    assert sorted(groups) == ["trust/one", "trust/two"]
    assert build_all(lake, specs, parallel=1)[2].state == "fresh"


def test_a_failure_stops_only_what_reads_it(lake):
    def fail(l):
        raise RuntimeError("no such thing")

    ok = lambda l: l.spark.range(1)
    specs = _specs(lake, ("bad", ["a"], fail), ("good", ["a"], ok), ("child", ["bad", "good"], ok), ("grandchild", ["child"], ok))
    results = build_all(lake, specs)
    assert [r.state for r in results] == ["failed", "built", "waiting", "waiting"]
    assert results[0].error == "RuntimeError: no such thing" and results[3].waits_for == "trust/bad"
    assert failures(results)[1:] == ["trust/child: waits for trust/bad", "trust/grandchild: waits for trust/bad"]
    log = read_control(lake.spark, lake.control_path(specs[0].target))
    assert [r["Error"] for r in log.collect()] == ["RuntimeError: no such thing"]
    assert last_run_time(log) is None
    mended = [replace(specs[0], transform=ok), *specs[1:]]
    assert [r.state for r in build_all(lake, mended)] == ["built", "fresh", "built", "built"]


def test_tables_in_a_circle_are_refused(lake):
    ok = lambda l: l.spark.range(1)
    specs = _specs(lake, ("one", ["two"], ok), ("two", ["one"], ok))
    with pytest.raises(CycleError):
        build_all(lake, specs)
    with pytest.raises(ValueError, match="twice"):
        build_all(lake, [specs[0], specs[0]])


def test_a_failed_table_fails_its_job_at_the_end(spark, frame, tmp_path):
    root, given = str(tmp_path / "lake"), str(tmp_path / "given")
    frame("id long, name string", (1, "x")).write.parquet(given)
    for table in ("one", "two"):
        main(["land", "--root", root, "--table", table, "--records", given, "--full"], spark)
    with pytest.raises(SystemExit, match="raw/igdb/two.*updated_at|raw/igdb/one.*updated_at"):
        main(["raw", "--root", root, "--tables", "one", "two"], spark)
    assert main(["raw", "--root", root, "--tables", "one", "two", "--no-order"], spark) == [1, 1]


def test_sql_type_names():
    names = {
        StringType(): "varchar",
        IntegerType(): "integer",
        BooleanType(): "boolean",
        LongType(): "bigint",
        DoubleType(): "double",
        TimestampType(): "timestamp",
        ArrayType(StringType()): "array(varchar)",
        ArrayType(IntegerType()): "array(integer)",
        ArrayType(LongType()): "array(bigint)",
    }
    assert {t: ddl_type(t) for t in names} == names


def test_catalog_follows_versions_and_columns(lake, spark, frame, rows):
    layer = f"l{uuid.uuid4().hex[:8]}"
    table = TableId(layer, "things", "shop")
    write_snapshot(frame("a long", (1,)), lake.path(table))
    append_run(spark, lake.control_path(table), TABLE_RUN, Run().record(Table_Rows=1))

    def sync():
        done = sync_catalog(spark, lake.root, (layer, "no-such-layer"), (layer,), f"{layer}_control")
        return {r["table"]: r["action"] for r in done.collect()}

    name, control = f"{layer}_shop_things", f"ctrl_{layer}_shop_things"
    assert sync() == {name: "created", control: "created"}
    assert sync() == {name: "unchanged", control: "unchanged"}
    write_snapshot(frame("a long, b string", (2, "x")), lake.path(table))
    assert sync()[name] == "recreated"
    assert rows(spark.table(f"{layer}.{name}")) == [(2, "x")]
    assert spark.table(f"{layer}_control.{control}").count() == 1
    found = discover_tables(spark, lake.root, layer, "history").collect()
    assert [(f["name"], f["path"]) for f in found] == [(name, lake.path(table))]


def test_a_table_in_parts_is_registered_with_their_folders(lake, spark, frame, rows):
    layer = f"l{uuid.uuid4().hex[:8]}"
    table = TableId(layer, "things")
    upsert_snapshot(frame("id long, v string", (1, "a"), (11, "it's")), lake.path(table), "id", layout=Layout("id", "range", 10))

    def sync():
        return [(r["table"], r["action"], r["columns"]) for r in sync_catalog(spark, lake.root, (layer,), ()).collect()]

    name = f"{layer}_things"
    assert sync() == [(name, "created", "id bigint, v varchar")]
    assert sync()[0][1] == "unchanged"
    upsert_snapshot(frame("id long, v string", (11, "b"), (21, "c")), lake.path(table), "id")
    assert sync()[0][1] == "recreated"
    assert rows(spark.table(f"{layer}.{name}"), "id", "v", "__part") == [(1, "a", 0), (11, "b", 1), (21, "c", 2)]


def test_hundreds_of_folders_are_listed_at_the_same_time(spark, tmp_path, monkeypatch):
    for i in range(500):
        (tmp_path / "raw" / f"api{i % 20}" / f"t{i}" / ("history" if i % 2 else "control")).mkdir(parents=True)
    at_once, inside, lock = [0], [0], threading.Lock()
    listed = folders.entries

    def slow(*args):
        with lock:
            inside[0] += 1
            at_once[0] = max(at_once[0], inside[0])
        time.sleep(0.01)
        try:
            return listed(*args)
        finally:
            with lock:
                inside[0] -= 1

    monkeypatch.setattr(folders, "entries", slow)
    found = discover_tables(spark, str(tmp_path), "raw", "history").collect()
    assert sorted(r["name"] for r in found) == sorted(f"raw_api{i % 20}_t{i}" for i in range(1, 500, 2))
    assert at_once[0] > 4


def test_one_failing_table_does_not_stop_the_rest(lake, spark, frame):
    layer = f"l{uuid.uuid4().hex[:8]}"
    good, bad = TableId(layer, "good"), TableId(layer, "bad")
    write_snapshot(frame("a long", (1,)), lake.path(good))
    frame("nonsense long", (1,)).write.parquet(f"{lake.path(bad)}/history")
    done = sync_catalog(spark, lake.root, (layer,), ()).collect()
    assert {r["table"]: r["action"] for r in done} == {f"{layer}_good": "created", f"{layer}_bad": "failed"}


def test_jobs_alone_fill_a_lake(spark, frame, rows, tmp_path):
    root, given = str(tmp_path / "lake"), str(tmp_path / "given")
    frame("id long, name string, first_release_date long, updated_at long", (1, "Halo", 978307200, 5), (2, "Doom", 0, 6)).coalesce(1).write.parquet(f"{given}/games")
    frame("id long, name string", (7, "Genre")).coalesce(1).write.parquet(f"{given}/genres")
    frame("game_id long, game_name string, release_world int", (501, "Halo", 2001)).coalesce(1).write.parquet(f"{given}/times")
    run = lambda *words: main([words[0], "--root", root, *words[1:]], spark)
    assert run("land", "--table", "games", "--records", f"{given}/games", "--updated-at", "updated_at") == [1]
    assert run("land", "--table", "genres", "--records", f"{given}/genres", "--full") == [1]
    assert run("land", "--table", "genres", "--records", f"{given}/genres", "--full") == [0]
    assert run("raw", "--tables", "games") == [2]
    assert run("raw", "--tables", "genres", "--no-order", "--ties", "name", "--schema", "id long, name string") == [1]
    assert run("match", "--candidates", f"{given}/times") == [1]
    assert run("raw", "--api", "hltb", "--tables", "games", "--order", "extracted_datetime") == [1]
    assert rows(Lake(spark, root).read(TableId(RAW, "games", "hltb")), "id", "game_id") == [(1, 501)]


def test_a_failed_table_fails_the_catalogue_job_at_its_end(spark, frame, tmp_path):
    root = tmp_path / "lake"
    write_snapshot(frame("a long", (1,)), str(root / "raw" / "good"))
    frame("nonsense long", (1,)).write.parquet(str(root / "raw" / "bad" / "history"))
    with pytest.raises(SystemExit, match="raw_bad"):
        main(["catalog", "--root", str(root)], spark)
    assert spark.table("raw.raw_good").count() == 1


def test_read_or_none_does_not_hide_other_errors(spark, frame, tmp_path):
    assert read_or_none(spark, str(tmp_path / "nothing")) is None
    (tmp_path / "junk").mkdir()
    (tmp_path / "junk" / "a.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        read_or_none(spark, str(tmp_path / "junk")).count()
