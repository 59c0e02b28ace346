import pytest
from pyspark.sql import functions as F

from shelfmark import schemas
from shelfmark.errors import GateError
from shelfmark.operators import gates, table_audit
from shelfmark.sinks.tables import read_catalog, write_catalog


def frames(spark, spec, files=None, metadata=None, links=None):
    base = spec.base_url
    files = files if files is not None else [(f"{base}media/w/p{i}.tif", 7 * i) for i in range(6)]
    metadata = metadata if metadata is not None else [("W", f"w_{i}", f"Map {i}", None, f"{spec.records_url}w/a{i}.txt") for i in range(6)]
    links = links if links is not None else [(f"{base}media/w/p{i}.tif", f"w_{i * 5 % 6}") for i in range(6)]
    files = spark.createDataFrame(files, "url string, size long")
    return {
        "files": files.withColumn("last_modified", F.lit("2026-01-01").cast("timestamp_ntz")),
        "metadata": spark.createDataFrame(metadata, schemas.METADATA.schema),
        "linkages": spark.createDataFrame(links, schemas.LINKAGES.schema),
    }


def extra(spark, spec, name, *rows):
    tables = frames(spark, spec)
    more = frames(spark, spec, **{{"linkages": "links"}.get(name, name): list(rows)})
    tables[name] = tables[name].union(more[name])
    return tables


def failed(report):
    return {g["name"]: g["detail"] for g in report.collect() if not g["ok"]}


def test_a_clean_stored_catalog_passes_every_gate(spark, spec, tmp_path):
    write_catalog(frames(spark, spec), f"{tmp_path}/c")
    report = gates.gate_report(read_catalog(spark, f"{tmp_path}/c"), spec)
    passed = gates.enforce(report)
    assert len({g["name"] for g in passed}) == 18


def stored_anyhow(spark, tables, root, files):
    """Tables written with faults and all, in part files of random rows."""
    for output in schemas.OUTPUTS:
        tables[output.name].repartition(files).write.parquet(f"{root}/{output.file}")
    return read_catalog(spark, root)


@pytest.mark.parametrize("bucket", [1, 2, 1000])
def test_one_scan_gives_the_same_verdicts(spark, spec, tmp_path, monkeypatch, bucket):
    monkeypatch.setattr(table_audit, "FILES_PER_BUCKET", bucket)
    tables = extra(spark, spec, "linkages", ("https://else.example/a", "w_nobody"), (None, None), (None, "w_1"))
    tables["files"] = tables["files"].union(tables["files"].limit(2)).union(
        spark.createDataFrame([(None, -1), (None, 2), ("", 3)], "url string, size long").withColumn("t", F.lit("2026-01-01").cast("timestamp_ntz"))
    )
    tables["metadata"] = tables["metadata"].union(tables["metadata"].limit(1)).union(
        spark.createDataFrame([(None, None, "t", None, "else"), ("", "", None, None, None)], schemas.METADATA.schema)
    )
    stored = stored_anyhow(spark, tables, f"{tmp_path}/c", 5)
    before = {"files": spark.range(3), "linkages": None, "metadata": spark.range(400)}
    report = gates.gate_report(stored, spec, before)
    plain = gates.table_gates(stored, spec, before)
    for output in schemas.OUTPUTS:
        plain = plain.union(gates.sorted_gate(stored[output.name], output))
    found = sorted(map(tuple, report.collect()))
    assert found == sorted(map(tuple, plain.collect()))
    assert sum(not ok and name.endswith("sorted") for name, ok, _ in found) >= 2


def test_each_stored_table_is_scanned_once(spark, spec, tmp_path):
    write_catalog(frames(spark, spec), f"{tmp_path}/c")
    report = gates.gate_report(read_catalog(spark, f"{tmp_path}/c"), spec)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == len(schemas.OUTPUTS)
    assert gates.enforce(report)


def test_empty_stored_tables_fail(spark, spec, tmp_path):
    write_catalog(frames(spark, spec, [], [], []), f"{tmp_path}/c")
    found = failed(gates.gate_report(read_catalog(spark, f"{tmp_path}/c"), spec))
    assert set(found) == {"files rows", "metadata rows", "linkages rows", "linkages filled"}


@pytest.mark.parametrize(
    ("name", "row", "gate", "detail"),
    [
        ("linkages", ("{base}media/w/p0.tif", "w_77"), "linkages record_id found", "1 rows"),
        ("linkages", ("{base}media/w/p0.tif", None), "linkages record_id found", "1 rows"),
        ("linkages", ("{base}media/w/lost.tif", "w_0"), "linkages url found", "1 rows"),
        ("metadata", ("W", "", "No id", None, None), "metadata record_id unique", "repeated 0, null 0, empty 1"),
        ("metadata", ("W", None, "No id", None, None), "metadata record_id unique", "repeated 1, null 1, empty 0"),
        ("metadata", ("W", "w_4", "Again", None, None), "metadata record_id unique", "repeated 1, null 0, empty 0"),
        ("metadata", ("W", "w_50", "T", None, "https://else.example/a1.txt"), "metadata url prefix", "1 not under"),
        ("files", ("https://else.example/p.tif", 1), "files url prefix", "1 not under"),
        ("files", ("{base}media/w/p3.tif", 1), "files url unique", "repeated 1, null 0, empty 0"),
        ("files", ("{base}media/w/p9.tif", -4), "files size", "1 sizes below zero"),
        ("files", (None, 1), "files url unique", "repeated 1, null 1, empty 0"),
    ],
)
def test_each_fault_fails_its_gate_only(spark, spec, name, row, gate, detail):
    row = tuple(v.format(base=spec.base_url) if isinstance(v, str) else v for v in row)
    found = failed(gates.table_gates(extra(spark, spec, name, row), spec))
    assert list(found) == [gate]
    assert found[gate].startswith(detail)


def test_a_foreign_link_fails_two_gates(spark, spec):
    found = failed(gates.table_gates(extra(spark, spec, "linkages", ("https://else.example/a", "w_1")), spec))
    assert set(found) == {"linkages url prefix", "linkages url found"}


def test_empty_tables_fail(spark, spec):
    found = failed(gates.table_gates(frames(spark, spec, [], [], []), spec))
    assert set(found) == {"files rows", "metadata rows", "linkages rows", "linkages filled"}


def test_single_gates_agree_with_the_joint_ones(spark, spec):
    tables = extra(spark, spec, "linkages", ("https://else.example/a", "w_nobody"), (None, None))
    tables["files"] = tables["files"].union(tables["files"].limit(2))
    joint = {g["name"]: tuple(g) for g in gates.table_gates(tables, spec).collect()}
    single = [
        gates.unique_gate(tables["files"], "url", "files url unique", empty_allowed=True),
        gates.unique_gate(tables["metadata"], "record_id", "metadata record_id unique"),
        gates.present_gate(tables["linkages"], "linkages filled"),
        gates.reference_gate(tables["linkages"], tables["files"], "url", "linkages url found"),
        gates.reference_gate(tables["linkages"], tables["metadata"], "record_id", "linkages record_id found"),
        gates.prefix_gate(tables["files"], "url", spec.base_url, "files url prefix"),
        gates.prefix_gate(tables["linkages"], "url", spec.base_url, "linkages url prefix"),
        gates.prefix_gate(tables["metadata"], "metadata_url", spec.records_url, "metadata url prefix"),
    ]
    for gate in single:
        row = tuple(gate.first())
        assert joint[row[0]] == row


def test_schema_gate_checks_names_types_and_order(spark, spec):
    files = frames(spark, spec)["files"]
    assert gates.schema_gate(files, schemas.FILES).first()["ok"]
    for other in (
        files.withColumn("size", F.col("size").cast("int")),
        files.withColumnRenamed("size", "bytes"),
        files.select("size", "url", "last_modified"),
        files.withColumn("last_modified", F.col("last_modified").cast("timestamp")),
    ):
        assert not gates.schema_gate(other, schemas.FILES).first()["ok"]


@pytest.mark.parametrize(("before", "ok"), [(None, True), (10, True), (0, True), (100, False), (106, False), (11, False)])
def test_drift(spark, before, ok):
    previous = None if before is None else spark.range(before)
    assert gates.drift_gate(spark.range(10), previous, "t", 5.0).first()["ok"] is ok


def test_drift_floor_is_inclusive(spark):
    assert gates.drift_gate(spark.range(95), spark.range(100), "t", 5.0).first()["ok"]
    assert not gates.drift_gate(spark.range(94), spark.range(100), "t", 5.0).first()["ok"]


def test_unsorted_files_fail(spark, spec, tmp_path):
    files = frames(spark, spec)["files"].coalesce(1)
    files.orderBy(F.desc("url")).write.parquet(f"{tmp_path}/f")
    gate = gates.sorted_gate(spark.read.parquet(f"{tmp_path}/f"), schemas.FILES).first()
    assert (gate["ok"], gate["detail"]) == (False, "5 falls in the order of url")


def test_enforce_names_every_failed_gate(spark, spec):
    report = gates.table_gates(extra(spark, spec, "linkages", ("https://else.example/a", "w_nobody")), spec)
    with pytest.raises(GateError, match="linkages url found.*linkages record_id found") as error:
        gates.enforce(report.orderBy(F.desc("name")))
    assert "unique" not in str(error.value)
