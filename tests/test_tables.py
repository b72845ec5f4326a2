import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ledgerline.operators.dedup import require_unique
from ledgerline.operators.lookups import fallback_team_ids, lookup
from ledgerline.session import cut_lineage
from ledgerline.sources import tables
from ledgerline.sources.raw import new_files

SCHEMA = "k int, part int, v string"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def content(spark, path):
    return sorted(tuple(r) for r in tables.read_table(spark, path).select("k", "part", "v").collect())


def test_upsert_keeps_the_last(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.upsert(spark, path, frame(spark, []), ["k"]) == 0 and not tables.table_exists(spark, path)
    assert tables.upsert(spark, path, frame(spark, [(1, 0, "a"), (2, 0, "b"), (None, 0, "n")]), ["k"]) == 3
    batch = frame(spark, [(2, 0, "x", 1), (2, 0, "y", 2), (3, 0, "c", 1), (None, 0, "m", 1)], SCHEMA + ", o int")
    for _ in range(2):
        assert tables.upsert(spark, path, batch, ["k"], ["o"]) == 4
        assert set(content_with_null(spark, path)) == {(1, "a"), (2, "y"), (3, "c"), (None, "m")}


def content_with_null(spark, path):
    return [(r.k, r.v) for r in tables.read_table(spark, path).collect()]


def test_partitioned_upsert_leaves_other_partitions_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.upsert(spark, path, frame(spark, [(1, 1, "a"), (2, 2, "b"), (3, 2, "c")]), ["k"], partition_by="part")
    untouched = {str(f): f.stat().st_mtime_ns for f in (tmp_path / "t").glob("*/part=1/*.parquet")}
    assert tables.upsert(spark, path, frame(spark, [(3, 2, "z"), (4, 3, "d")]), ["k"], partition_by="part") == 4
    assert content(spark, path) == [(1, 1, "a"), (2, 2, "b"), (3, 2, "z"), (4, 3, "d")]
    assert untouched and untouched == {str(f): f.stat().st_mtime_ns for f in (tmp_path / "t").glob("*/part=1/*.parquet")}
    touched = frame(spark, [(2,), (3,)], "part int")
    assert tables.replace_partitions(spark, path, frame(spark, [(9, 2, "q")]), "part", touched) == 2
    assert content(spark, path) == [(1, 1, "a"), (9, 2, "q")]


def test_new_columns_appear(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.upsert(spark, path, frame(spark, [(1, 0, "a")]), ["k"])
    tables.upsert(spark, path, frame(spark, [(2, 0, "b", 5)], SCHEMA + ", extra int"), ["k"])
    assert {r.k: r.extra for r in tables.read_table(spark, path).collect()} == {1: None, 2: 5}


def test_overwrite_may_empty_a_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite(spark, path, frame(spark, [(1, 0, "a"), (1, 0, "a")]), ["k"])
    assert content(spark, path) == [(1, 0, "a")]
    assert tables.overwrite(spark, path, frame(spark, [])) == 0 and content(spark, path) == []


class Killed(Exception):
    """Stands for the loss of the driver."""


STEPS = {"_stage": False, "_commit": False, "_rename": False, "_remove": True}  # whether the commit was made


@pytest.mark.parametrize("partition_by", [None, "part"])
@pytest.mark.parametrize("step", STEPS)
def test_a_driver_lost_in_a_write_loses_no_row(spark, tmp_path, monkeypatch, step, partition_by):
    path = str(tmp_path / "t")
    before = [(1, 1, "a"), (2, 2, "b"), (3, 2, "c")]
    after = [(1, 1, "a"), (2, 2, "b"), (3, 2, "z"), (4, 3, "d")]
    batch = frame(spark, [(3, 2, "z"), (4, 3, "d")])
    tables.overwrite(spark, path, frame(spark, [(9, 9, "first")]), partition_by=[partition_by] if partition_by else [])
    tables.overwrite(spark, path, frame(spark, before), partition_by=[partition_by] if partition_by else [])
    reading = tables.read_table(spark, path)
    with monkeypatch.context() as patch:
        kept = getattr(tables, step)

        def kill(*args):
            if step == "_stage":
                kept(*args)  # the files are there, the manifest is not
            raise Killed

        patch.setattr(tables, step, kill)
        with pytest.raises(Killed):
            tables.upsert(spark, path, batch, ["k"], partition_by=partition_by)
    # A reader sees all of the change or nothing, and one that had begun goes on.
    assert content(spark, path) == (after if STEPS[step] else before)
    assert sorted(tuple(r) for r in reading.select("k", "part", "v").collect()) == before
    assert tables.upsert(spark, path, batch, ["k"], partition_by=partition_by) == 4
    assert content(spark, path) == after
    tables.upsert(spark, path, batch, ["k"], partition_by=partition_by)
    held = tables._manifest(spark, path).commits() | tables._manifest(spark, path, tables._versions(spark, path)[0]).commits()
    assert {n for n in tables._names(spark, path) if n.startswith("_commit=")} == {f"_commit={c}" for c in held}


def test_a_check_that_objects_keeps_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite(spark, path, frame(spark, [(1, 0, "old")]))

    def refuse():
        raise ValueError("no")

    for write in (tables.overwrite, lambda *a, **k: tables.upsert(*a, ["k"], **k)):
        with pytest.raises(ValueError):
            write(spark, path, frame(spark, [(1, 0, "new")]), check=refuse)
        assert content(spark, path) == [(1, 0, "old")]


def test_two_writers_do_not_overwrite_each_other(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite(spark, path, frame(spark, [(1, 0, "a")]))
    seen = tables._manifest(spark, path)
    tables.overwrite(spark, path, frame(spark, [(1, 0, "b")]))
    with pytest.raises(OSError):
        tables._commit(spark, path, tables.Manifest(seen.version + 1, seen.schema, {}), seen)
    assert content(spark, path) == [(1, 0, "b")]


def test_a_plain_folder_becomes_a_table(spark, tmp_path):
    path = str(tmp_path / "t")
    frame(spark, [(1, 1, "a"), (2, 2, "b")]).write.partitionBy("part").parquet(path)
    assert tables.table_exists(spark, path) and content(spark, path) == [(1, 1, "a"), (2, 2, "b")]
    assert tables.upsert(spark, path, frame(spark, [(2, 2, "z")]), ["k"], partition_by="part") == 2
    tables.upsert(spark, path, frame(spark, [(3, 2, "c")]), ["k"], partition_by="part")
    assert content(spark, path) == [(1, 1, "a"), (2, 2, "z"), (3, 2, "c")]
    assert not [n for n in tables._names(spark, path) if n.startswith("part=")]


def test_odd_partition_values(spark, tmp_path):
    path = str(tmp_path / "t")
    odd = [(1, "a/b c", "x"), (2, None, "y"), (3, "ü=%41", "z"), (4, "2024-01-05", "w")]
    schema = "k int, part string, v string"
    tables.overwrite(spark, path, frame(spark, odd, schema), partition_by=["part"])
    for k, part, _ in odd:
        assert tables.upsert(spark, path, frame(spark, [(k, part, "new")], schema), ["k"], partition_by="part") == 4
    got = {(r.k, r.part, r.v) for r in tables.read_table(spark, path).collect()}
    assert got == {(k, part, "new") for k, part, _ in odd}
    assert tables.replace_partitions(spark, path, frame(spark, [], schema), "part", frame(spark, odd, schema).select("part")) == 0
    assert tables.read_table(spark, path).columns == ["k", "part", "v"]


def test_appends_are_read_together(spark, tmp_path):
    path = str(tmp_path / "t")
    assert [tables.append(spark, path, frame(spark, [(i, 0, "x")])) for i in range(3)] == [1, 2, 3]
    assert [r[0] for r in content(spark, path)] == [0, 1, 2]


def test_scratch_of_another_thread_is_left_alone(spark):
    from threading import Thread

    from ledgerline.session import own_scratch, write_out

    other = []
    with own_scratch(spark):
        mine = write_out(spark.range(3))
        thread = Thread(target=lambda: other.append(write_out(spark.range(5))))
        thread.start()
        thread.join()
        assert mine.count() == 3
    assert other[0].count() == 5
    with pytest.raises(Exception):
        mine.count()


def test_missing_table_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException):
        tables.read_table(spark, str(tmp_path / "none"))


def test_lookup(spark):
    rows = frame(spark, [("a", 1), (None, 2), ("z", 3)], "key string, n int")
    names = frame(spark, [("a", "A"), ("b", "B")], "id string, name string")
    got = {r.n: r.name for r in lookup(rows, names, "key", "id", {"name": "name"}, check=True).collect()}
    assert got == {1: "A", 2: None, 3: None}
    with pytest.raises(ValueError):
        require_unique(names.unionByName(names), ["id"])


def test_fallback_ids(spark):
    rows = [
        (1, "10", "A", "20", "B"), (2, None, " A ", None, "New"), (3, None, "New", "21", "B"), (4, "30", "C", None, "B"),
        (5, None, None, "10", "Other name"),
    ]
    matches = frame(spark, rows, "o int, home_raw string, home_name string, away_raw string, away_name string")
    resolved, teams = fallback_team_ids(matches, ["o"])
    got = {r.o: (r.home_raw, r.away_raw) for r in resolved.collect()}
    fake = got[2][1]
    assert fake.startswith("UNKNOWN_AWAY_") and len(fake) == len("UNKNOWN_AWAY_") + 8
    assert got[2][0] == "10" and got[3] == (fake, "21") and got[4] == ("30", "21") and got[1] == ("10", "20")
    assert got[5][0].startswith("UNKNOWN_LOCAL_")
    names = {r.raw_id: r.team_name for r in teams.collect()}
    assert names == {"10": "A", "20": "B", "21": "B", "30": "C", fake: "New", got[5][0]: "None"}


def test_checkpoints_follow_the_session(spark):
    cut = cut_lineage(spark.range(5).withColumn("x", F.col("id") * 2))
    assert cut.count() == 5 and spark.sparkContext.getCheckpointDir()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_keep_their_shape(spark):
    import __spark_entry__ as contract

    spark.catalog.clearCache()
    queries, folder = contract.queries(), "/root/testdata/sf0.001"
    stints = plan(queries["q_stints"](spark, folder))
    # One exchange on the match feeds every window and the aggregation on top.
    assert stints.count("Exchange hashpartitioning") == 1 and stints.count("Window [") == 3
    assert "ReadSchema: struct<event_id:bigint,event_type:string,props:string>" in stints
    # Copies are dropped before the exchange.
    assert "WindowGroupLimit" in plan(queries["q_dedup_first"](spark, folder)).split("Exchange")[-1]
    for name in ("q_resolve_event_refs", "q_boxscore", "q_fallback_key", "q_upsert_last_wins"):
        text = plan(queries[name](spark, folder))
        assert "CartesianProduct" not in text and "NestedLoop" not in text and "Python" not in text


def test_routing_reads_its_rows_once(spark):
    import __spark_entry__ as contract

    for name, scans in (("q_partition_status", 1), ("q_split_played", 1), ("q_union_branches", 2)):
        assert plan(contract.queries()[name](spark, "/root/testdata/sf0.001")).count("FileScan") == scans


def test_new_files_meet_a_registry_by_hash(spark):
    files = spark.createDataFrame([("/raw/a/1.json", 1), ("/raw/a/1.json", 2), ("/raw/a/2.json", None), (None, 1), ("/raw/a/3.json", 1)], "path string, modification_time int")
    known = spark.createDataFrame([("/raw/a/1.json", 1), ("/raw/a/2.json", None), (None, 1), ("/raw/a/3.json", 1), ("/raw/a/3.json", 1)], "path string, modification_time int")
    found = new_files(files, known)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "Sort [_mark" in plan
    assert found.columns == files.columns
    assert sorted(map(tuple, found.collect()), key=str) == sorted([("/raw/a/1.json", 2), ("/raw/a/2.json", None), (None, 1)], key=str)
