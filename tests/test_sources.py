import json

import pytest

from shelfmark.errors import ArchiveError, RecordError, SceneError
from shelfmark.sources import inventory, records, scenes, tables
from tests.conftest import MODEL


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return f"file://{path}"


def test_scan_tree_lists_without_reading(spark, spec, tmp_path):
    root = tmp_path / "store" / "arc" / "pub"
    write(root / "media" / "x" / "a b+c%.jpg", "12345")
    write(root / "README.md", "1")
    found = inventory.scan_tree(spark, spec)
    rows = {r["key"]: (r["size"], r["etag"]) for r in found.collect()}
    assert rows == {"arc/pub/media/x/a b+c%.jpg": (5, None), "arc/pub/README.md": (1, None)}
    assert "content" not in found._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]


def test_inventory_sizes_become_bigint_and_etags_bare(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    rows = {"key": ["a"], "size": pa.array([7], pa.uint64()), "last_modified": pa.array([0], pa.timestamp("us", "UTC")), "etag": ['"abc"']}
    pq.write_table(pa.table(rows), tmp_path / "i.parquet")
    found = inventory.read_inventory(spark, f"{tmp_path}/i.parquet")
    assert found.dtypes == [("key", "string"), ("size", "bigint"), ("last_modified", "timestamp"), ("etag", "string")]
    assert tuple(found.select("key", "size", "etag").first()) == ("a", 7, "abc")


def test_records_keep_declared_columns_and_their_file(spark, tmp_path):
    line = {"id": "1", "unitCode": "U", "content": '{"a": 1}', "timestamp": 5, "other": "x"}
    path = write(tmp_path / "in" / "0 +f.txt", json.dumps(line) + "\n")
    row = records.read_records(spark, [path]).first()
    assert row["filename"] == path
    assert (row["id"], row["content"], row["timestamp"], row["lastTimeUpdated"]) == ("1", '{"a": 1}', 5, None)
    assert "other" not in row


def test_ingest_replaces_what_was_there(spark, tmp_path):
    first = write(tmp_path / "in" / "00.txt", '{"id": "1"}\n{"id": "2"}\n')
    second = write(tmp_path / "in" / "01.txt", '{"id": "3"}\n')
    out = f"{tmp_path}/out"
    assert records.ingest_records(spark, [first, second], out) == 3
    assert records.ingest_records(spark, [second], out) == 1
    assert [r["id"] for r in spark.read.parquet(out).collect()] == ["3"]


def test_ingest_reports_files_without_records(spark, tmp_path, caplog):
    full = write(tmp_path / "in" / "00.txt", '{"id": "1"}\n')
    empty = write(tmp_path / "in" / "01.txt", "")
    assert records.ingest_records(spark, [full, empty], f"{tmp_path}/out") == 1
    assert "1 of 2 record files held no records" in caplog.text
    with pytest.raises(RecordError, match="no records"):
        records.ingest_records(spark, [empty], f"{tmp_path}/out")
    with pytest.raises(RecordError, match="no record files"):
        records.ingest_records(spark, [], f"{tmp_path}/out")


def scene_paths(tmp_path, good, bad):
    metas = json.dumps({"metas": [{"collection": {"edanRecordId": "edanmdm:a_1"}}], "models": []}, indent=1)
    paths = [write(tmp_path / f"g{i}" / "3d" / MODEL / "scene.svx.json", metas) for i in range(good)]
    return paths + [write(tmp_path / f"bad{i}.json", "{not json") for i in range(bad)]


def load(spark, spec, paths, root):
    good, bad = scenes.load_scenes(spark, paths, f"{root}/scenes", spec, f"{root}/bad-scenes")
    assert spark.read.parquet(f"{root}/bad-scenes").count() == bad.count()
    return good, sorted(r["filename"] for r in bad.collect())


def test_a_bad_scene_spoils_no_other(spark, spec, tmp_path):
    paths = scene_paths(tmp_path, 2, 1) + [write(tmp_path / "empty.json", ""), write(tmp_path / "none.json", '{"models": []}')]
    paths += [write(tmp_path / f"behind{n}.json", '{"metas": []}' + rest) for n, rest in enumerate([" junk", "{}", ","])]
    good, bad = load(spark, spec, paths, tmp_path)
    assert bad == [f"file://{tmp_path}/bad0.json", *(f"file://{tmp_path}/behind{n}.json" for n in range(3))]
    assert sorted(r["filename"] for r in good.collect()) == sorted(paths[:2])
    assert json.loads(good.first()["metas"]) == [{"collection": {"edanRecordId": "edanmdm:a_1"}}]


def test_some_bad_scenes_pass_and_more_abort(spark, spec, tmp_path):
    allowed = spec.bad_scenes_floor
    assert len(load(spark, spec, scene_paths(tmp_path / "few", 2, allowed), tmp_path / "a")[1]) == allowed
    with pytest.raises(SceneError, match=f"{allowed + 1} of {allowed + 1} scene files failed"):
        load(spark, spec, scene_paths(tmp_path / "many", 0, allowed + 1), tmp_path / "b")


@pytest.mark.parametrize("rest", [" junk", '{"id": "3"}', ',{"id": "3"}', "]", "}", '"', "]{}"])
def test_text_behind_a_record_is_not_lost_silently(spark, tmp_path, rest):
    path = write(tmp_path / "in" / "00.txt", '{"id": "1"}\n{"id": "2"}' + rest + "\n")
    with pytest.raises(Exception, match="not one JSON record"):
        records.ingest_records(spark, [path], f"{tmp_path}/strict")
    assert records.ingest_records(spark, [path], f"{tmp_path}/out", f"{tmp_path}/bad") == 1
    [bad] = spark.read.parquet(f"{tmp_path}/bad").collect()
    assert (bad["filename"], bad["_corrupt_record"]) == (path, '{"id": "2"}' + rest)


def test_a_strict_read_parses_each_line_once(spark, tmp_path):
    path = write(tmp_path / "r.txt", '{"id":"1"}\n{"id":"2"}\n')
    read = records.read_records(spark, [path])
    plan = read._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter " in line]
    assert filters and not any("from_json" in line for line in filters)
    assert read.count() == 2
    write(tmp_path / "r.txt", '{"id":"1"}\n{"id":"2"} {}\n')
    with pytest.raises(Exception, match="not one JSON record"):  # also where no column is asked for
        records.read_records(spark, [path]).count()


def test_many_paths_are_looked_up_in_few_tasks(spark, tmp_path):
    paths = [write(tmp_path / f"s{n}/scene.txt", f"text {n}") for n in range(400)]
    setting = spark.conf.get(tables._LOOKUP_TASKS)
    spark.sparkContext.setJobGroup("look-up", "look up paths")
    try:
        found = tables.read_text(spark, paths, wholetext=True)
        status = spark.sparkContext.statusTracker()
        jobs = [status.getJobInfo(job) for job in status.getJobIdsForGroup("look-up")]
        tasks = [status.getStageInfo(stage).numTasks for job in jobs for stage in job.stageIds]
    finally:
        spark.sparkContext.setJobGroup("tests", "")
    assert 1 <= max(tasks) <= tables.LOOKUP_TASKS_PER_CORE * spark.sparkContext.defaultParallelism < 400
    assert spark.conf.get(tables._LOOKUP_TASKS) == setting
    assert found.select("value").distinct().count() == 400


def test_of_names_that_repeat_the_last_counts(spark, tmp_path):
    path = write(tmp_path / "in" / "00.txt", '{"id": "1", "id": "2"}\n')
    assert records.read_records(spark, [path]).first()["id"] == "2"


def test_paths_are_taken_literally(spark, tmp_path):
    paths = [write(tmp_path / "in" / name / "00.txt", f'{{"id": "{n}"}}\n') for n, name in enumerate(["n[1]", "n{a,b}", "n*", "n?", "n1", "na"])]
    for n, path in enumerate(paths):
        assert [r["id"] for r in records.read_records(spark, [path]).collect()] == [str(n)]


def test_a_missing_table_is_none(spark, tmp_path):
    assert tables.read_if_exists(spark, f"{tmp_path}/nothing") is None
    spark.range(3).write.parquet(f"{tmp_path}/t")
    assert tables.read_if_exists(spark, f"{tmp_path}/t").count() == 3


def test_a_table_that_lost_its_files_is_an_error(spark, tmp_path):
    (tmp_path / "t").mkdir()
    with pytest.raises(Exception, match="UNABLE_TO_INFER_SCHEMA"):
        tables.read_if_exists(spark, f"{tmp_path}/t")


def test_scratch_tables_can_be_deleted(spark):
    kept = list(tables._scratch)
    tables._scratch.clear()
    path = tables.scratch_path(spark, "x")
    tables.stage(spark.range(3), path)
    assert tables.path_exists(spark, path)
    tables.clear_scratch(spark)
    assert not tables.path_exists(spark, path)
    tables._scratch.extend(kept)


def test_scratch_paths_lie_in_the_checkpoint_folder(spark, monkeypatch):
    root = spark.conf.get("spark.checkpoint.dir")
    one, two = (tables.scratch_path(spark, "x") for _ in range(2))
    assert one.startswith(f"{root}/shelfmark/x-")
    assert one != two


def test_a_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def get(self, name, default):
            return default

    class Cluster:
        conf = Conf()
        sparkContext = type("C", (), {"master": "yarn", "getConf": lambda self: type("D", (), {"get": lambda self, name: None})()})()

    with pytest.raises(ArchiveError, match="spark.checkpoint.dir"):
        tables.scratch_path(Cluster(), "x")
