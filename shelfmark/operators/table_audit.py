"""Everything the gates ask of the three stored tables, from one scan of each.

A task turns what it scans into counted keys (equal keys of a batch are one row) and one row for each
stretch of a file, which tells its ends and its falls in order. Both go through the same grouping: keys by
their value, where the tables that share a key meet, stretches each for themselves. What is left are sums, and the
ends of files, which are chained by part number in buckets of ``FILES_PER_BUCKET`` files and then bucket by bucket.
"""

from __future__ import annotations

import sys
from collections.abc import Mapping
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.order_audit import PART, RunTracker
from shelfmark.schemas import OUTPUTS, Output
from shelfmark.spec import CatalogSpec

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FILES_PER_BUCKET = 1_000
KINDS = ("url", "record_id")
# Keys that a table owns (each must be there once) or refers to.
OWNED = {"files": ("url",), "metadata": ("record_id",), "linkages": ()}
REFERRED = {"files": (), "metadata": (), "linkages": ("url", "record_id")}
FAULTS = ("file_bad", "negative", "record_bad", "link_bad")
_ROW = (
    f"kind string, key string, owned long, referred long, {', '.join(f'{f} long' for f in FAULTS)}, "
    "run struct<name: string, file: string, `from`: long, `to`: long, falls: long, first: array<string>, last: array<string>>"
)


def _faults(output: Output, spec: CatalogSpec) -> dict[str, Column]:
    foreign = ~F.col("url").startswith(spec.base_url)
    return {
        "files": {"file_bad": foreign, "negative": F.col("size") < 0},
        "metadata": {"record_bad": ~F.col("metadata_url").startswith(spec.records_url)},
        "linkages": {"link_bad": foreign},
    }[output.name]


def _scanned(stored: DataFrame, output: Output, spec: CatalogSpec) -> DataFrame:
    """Counted keys and stretches of one table, as rows of ``_ROW``."""
    faults = _faults(output, spec)
    name, sort = output.name, list(output.sort)
    kinds = [k for k in KINDS if k in OWNED[name] + REFERRED[name]]
    needed = list(dict.fromkeys([*sort, *kinds]))
    owned = {k: k in OWNED[name] for k in kinds}
    bad = list(faults)
    scan = stored.select(
        *(F.col(c).cast("string").alias(c) for c in needed), *(F.coalesce(fault.cast("long"), F.lit(0)).alias(f) for f, fault in faults.items()),
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"),
    )
    schema = pa.schema([
        ("kind", pa.string()), ("key", pa.string()), ("owned", pa.int64()), ("referred", pa.int64()), *((f, pa.int64()) for f in FAULTS),
        ("run", pa.struct([("name", pa.string()), ("file", pa.string()), ("from", pa.int64()), ("to", pa.int64()), ("falls", pa.int64()),
                           ("first", pa.list_(pa.string())), ("last", pa.list_(pa.string()))])),
    ])

    def rows(columns: dict, n: int) -> pa.RecordBatch:
        absent = {f.name: pa.array([0] * n, f.type) if f.type == pa.int64() else pa.nulls(n, f.type) for f in schema}
        return pa.RecordBatch.from_pydict(absent | columns, schema=schema)

    def keys_of(batch):
        for k in kinds:
            found = pc.value_counts(batch.column(k))
            values, counts = found.field("values"), found.field("counts").cast(pa.int64())
            n = len(values)
            columns = {"kind": pa.array([k] * n), "key": values, "owned" if owned[k] else "referred": counts}
            if k == kinds[0]:  # the batch's faults go with its first key
                columns |= {f: pa.array([pc.sum(batch.column(f)).as_py() or 0, *[0] * (n - 1)], pa.int64()) for f in bad}
            yield rows(columns, n)

    def run_of(closed):
        r = closed.to_pylist()[0]
        run = {"name": name, **{c: r[c] for c in ("file", "from", "to", "falls")}}
        run |= {end: [r[f"{end}_{i}"] for i in range(len(sort))] for end in ("first", "last")}
        return rows({"kind": pa.array(["run"]), "run": pa.array([run], schema.field("run").type)}, 1)

    def scanned(batches):
        tracker = RunTracker(sort)
        for batch in batches:
            if batch.num_rows:
                yield from keys_of(batch)
                yield from map(run_of, tracker.add(batch.select([*sort, "file", "at"])))
        yield from map(run_of, tracker.finish())

    return scan.mapInArrow(scanned, _ROW)


def table_numbers(stored: Mapping[str, DataFrame], spec: CatalogSpec) -> DataFrame:
    """One row of counts about the stored tables, each scanned once.

    For each key: ``{key}_rows``, ``_values``, ``_nulls``, ``_blanks`` of the table that owns it, ``_referring`` rows and
    ``_orphans`` among them that refer to nothing. For each table ``{name}_fallen``. And the ``FAULTS``.
    """
    scans = [_scanned(stored[o.name], o, spec) for o in OUTPUTS]
    counts = ["owned", "referred", *FAULTS]
    # equal keys of all tables meet here, and each stretch is its own group
    met = reduce(DataFrame.union, scans).groupBy("kind", "key", "run").agg(*(F.sum(c).alias(c) for c in counts))
    there, key = F.col("owned") > 0, F.col("key")

    def of(kind: str, value: Column) -> Column:
        return F.when(F.col("kind") == kind, value)

    numbers: dict[str, Column] = {}
    for kind in KINDS:
        numbers |= {
            f"{kind}_rows": of(kind, F.col("owned")),
            f"{kind}_values": of(kind, F.when(there & key.isNotNull(), 1)),
            f"{kind}_nulls": of(kind, F.when(key.isNull(), F.col("owned"))),
            f"{kind}_blanks": of(kind, F.when(key == "", F.col("owned"))),
            f"{kind}_referring": of(kind, F.col("referred")),
            f"{kind}_orphans": of(kind, F.when(~there | key.isNull(), F.col("referred"))),
        }
    numbers |= {f: F.col(f) for f in FAULTS}
    run = F.col("run")
    file = F.substring_index(run["file"], "/", -1)
    placed = met.select(
        *(F.coalesce(c.cast("long"), F.lit(0)).alias(n) for n, c in numbers.items()),
        run["name"].alias("table"), run["falls"].alias("falls"), file.alias("name"), run["from"].alias("from"),
        *(F.transform(run[end], lambda v: F.struct(v.isNull().alias("none"), v.alias("value"))).alias(end) for end in ("first", "last")),
    ).withColumn("part", F.when(F.col("table").isNotNull(), F.expr(PART)))
    place = F.when(F.col("table").isNotNull(), F.struct("part", "name", "from", "first", "last"))
    total = [F.sum(n).alias(n) for n in numbers]
    buckets = placed.groupBy("table", F.floor(F.col("part") / FILES_PER_BUCKET).alias("bucket")).agg(
        *total, F.sum("falls").alias("falls"), F.sort_array(F.collect_list(place)).alias("places")
    )
    buckets = buckets.select(
        *numbers, "table", (F.col("falls") + F.expr(_between("places"))).alias("falls"),
        F.when(F.size("places") > 0, F.struct("bucket", F.expr("places[0].first").alias("first"), F.expr("element_at(places, -1).last").alias("last"))).alias("ends"),
    )
    chains = [F.sort_array(F.collect_list(F.when(F.col("table") == o.name, F.col("ends")))).alias(f"_{o.name}") for o in OUTPUTS]
    inside = [F.sum(F.when(F.col("table") == o.name, F.col("falls"))).alias(f"{o.name}_inside") for o in OUTPUTS]
    whole = buckets.agg(*total, *chains, *inside)
    fallen = [(F.coalesce(f"{o.name}_inside", F.lit(0)) + F.expr(_between(f"_{o.name}"))).cast("long").alias(f"{o.name}_fallen") for o in OUTPUTS]
    return whole.select(*(F.coalesce(n, F.lit(0)).alias(n) for n in numbers), *fallen)


def _between(chain: str) -> str:
    """How many neighbours of a sorted list of stretches meet in the wrong order."""
    return f"size(filter(sequence(1, greatest(size({chain}), 1)), n -> n < size({chain}) AND {chain}[n - 1].last > {chain}[n].first))"
