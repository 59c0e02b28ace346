"""Gates a catalog must pass before it is published.

Every gate is a row ``(name, ok, detail)``. Gate frames are lazy and can be united; only verdicts,
a few rows, reach the driver.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.errors import GateError
from shelfmark.operators.order_audit import order_audit
from shelfmark.operators.table_audit import table_numbers
from shelfmark.schemas import OUTPUTS, Output
from shelfmark.spec import CatalogSpec

logger = logging.getLogger(__name__)


def _gate(name: str, ok: Column, *detail: Column | str) -> Column:
    texts = [F.lit(d) if isinstance(d, str) else d.cast("string") for d in detail]
    return F.struct(F.lit(name).alias("name"), ok.alias("ok"), F.concat(*texts).alias("detail"))


def _rows(numbers: DataFrame, *gates: Column) -> DataFrame:
    """Gates computed from a one-row frame."""
    return numbers.select(F.inline(F.array(*gates)))


def schema_gate(df: DataFrame, output: Output) -> DataFrame:
    """Column names, types and order equal the contract; no job is run."""

    def shape(schema) -> list[tuple[str, str]]:
        return [(f.name, f.dataType.simpleString()) for f in schema.fields]

    found = shape(df.schema)
    gate = _gate(f"{output.name} schema", F.lit(found == shape(output.schema)), str(found))
    return _rows(df.sparkSession.range(1), gate)


def drift_gate(df: DataFrame, previous: DataFrame | None, name: str, max_drop_percent: float) -> DataFrame:
    """At most ``max_drop_percent`` fewer rows than before; without a predecessor, not empty."""
    now = df.agg(F.count(F.lit(1)).alias("n"), F.lit(0).cast("long").alias("before"))
    if previous is None:
        n = F.col("n")
        return _rows(now, _gate(f"{name} rows", n > 0, n, " rows, the first release"))
    before = previous.agg(F.lit(0).cast("long").alias("n"), F.count(F.lit(1)).alias("before"))
    both = now.union(before).agg(F.sum("n").alias("n"), F.sum("before").alias("before"))
    enough = F.col("n") >= F.lit(1 - max_drop_percent / 100) * F.col("before")
    return _rows(both, _gate(f"{name} rows", enough, F.col("n"), " rows, before ", F.col("before")))


def _unique(name: str, empty_allowed: bool, *numbers: Column) -> Column:
    """Uniqueness verdict from the ``rows``, ``values``, ``nulls`` and ``blanks`` of a key."""
    rows, values, nulls, blanks = numbers or map(F.col, ("rows", "values", "nulls", "blanks"))
    duplicates = rows - values
    ok = (duplicates == 0) & (nulls == 0) & (F.lit(empty_allowed) | (blanks == 0))
    return _gate(name, ok, "repeated ", duplicates, ", null ", nulls, ", empty ", blanks)


def unique_gate(df: DataFrame, key: str, name: str, empty_allowed: bool = False) -> DataFrame:
    """No duplicate, null or (unless allowed) empty key. A null counts as a duplicate as well."""
    numbers = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(key).alias("values"),
        F.count_if(F.col(key).isNull()).alias("nulls"),
        F.count_if(F.col(key).cast("string") == "").alias("blanks"),
    )
    return _rows(numbers, _unique(name, empty_allowed))


def present_gate(df: DataFrame, name: str) -> DataFrame:
    n = F.col("n")
    return _rows(df.agg(F.count(F.lit(1)).alias("n")), _gate(name, n > 0, n, " rows"))


def reference_gate(child: DataFrame, parent: DataFrame, key: str, name: str) -> DataFrame:
    """Every key of the child exists in the parent.

    Child rows are counted by key before the join, so a key with very many rows weighs one row.
    """
    orphans = (
        child.groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .join(parent.select(key).distinct(), key, "left_anti")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    )
    return _rows(orphans, _gate(name, F.col("n") == 0, F.col("n"), f" rows refer to no {key}"))


def prefix_gate(df: DataFrame, column: str, prefix: str, name: str) -> DataFrame:
    """Every non-null value starts with ``prefix``."""
    outside = df.agg(F.count_if(~F.col(column).startswith(prefix)).alias("n"))
    return _rows(outside, _gate(name, F.col("n") == 0, F.col("n"), f" not under {prefix}"))


def sorted_gate(stored: DataFrame, output: Output) -> DataFrame:
    """Stored row order equals the sort order; needs a frame straight from ``read.parquet``."""
    fallen = F.col("out_of_order")
    gate = _gate(f"{output.name} sorted", fallen == 0, fallen, f" falls in the order of {', '.join(output.sort)}")
    return _rows(order_audit(stored, output.sort), gate)


def _key_pair(
    child: DataFrame, parent: DataFrame, key: str, child_bad: Mapping[str, Column], parent_bad: Mapping[str, Column]
) -> DataFrame:
    """All numbers about one key shared by two tables, in one row.

    Each table is grouped by the key once and the groups are joined where they lie; uniqueness,
    references and counts of bad rows then need no shuffles of their own. Grouping counts equal keys
    before they are shuffled, so a frequent key weighs one row a task.
    """

    def grouped(df: DataFrame, rows: str, bad: Mapping[str, Column]) -> DataFrame:
        counts = [F.count_if(condition).alias(name) for name, condition in bad.items()]
        return df.groupBy(key).agg(F.count(F.lit(1)).alias(rows), *counts)

    pairs = grouped(child, "child_n", child_bad).join(grouped(parent, "parent_n", parent_bad), key, "full_outer")
    is_parent, value = F.col("parent_n").isNotNull(), F.col(key)

    def total(column: str, condition: Column | None = None) -> Column:
        counted = F.col(column) if condition is None else F.when(condition, F.col(column))
        return F.coalesce(F.sum(counted), F.lit(0))

    return pairs.agg(
        total("child_n").alias("child_rows"),
        total("child_n", ~is_parent).alias("orphans"),
        total("parent_n").alias("rows"),
        F.count_if(is_parent & value.isNotNull()).alias("values"),
        total("parent_n", value.isNull()).alias("nulls"),
        total("parent_n", value == "").alias("blanks"),
        *[total(name).alias(name) for name in (*child_bad, *parent_bad)],
    )


def content_gates(tables: Mapping[str, DataFrame], spec: CatalogSpec) -> list[DataFrame]:
    """Uniqueness, presence, reference, prefix and size gates over the three tables."""
    files, metadata, links = tables["files"], tables["metadata"], tables["linkages"]
    foreign = ~F.col("url").startswith(spec.base_url)
    foreign_record = ~F.col("metadata_url").startswith(spec.records_url)
    urls = _key_pair(links, files, "url", {"link_bad": foreign}, {"file_bad": foreign, "negative": F.col("size") < 0})
    ids = _key_pair(links, metadata, "record_id", {}, {"record_bad": foreign_record})

    def none_of(column: str, name: str, what: str) -> Column:
        return _gate(name, F.col(column) == 0, F.col(column), what)

    return [
        _rows(
            urls,
            _unique("files url unique", empty_allowed=True),
            none_of("file_bad", "files url prefix", f" not under {spec.base_url}"),
            none_of("negative", "files size", " sizes below zero"),
            _gate("linkages filled", F.col("child_rows") > 0, F.col("child_rows"), " rows"),
            none_of("orphans", "linkages url found", " rows refer to no url"),
            none_of("link_bad", "linkages url prefix", f" not under {spec.base_url}"),
        ),
        _rows(
            ids,
            _unique("metadata record_id unique", empty_allowed=False),
            none_of("record_bad", "metadata url prefix", f" not under {spec.records_url}"),
            none_of("orphans", "linkages record_id found", " rows refer to no record_id"),
        ),
    ]


def table_gates(
    tables: Mapping[str, DataFrame],
    spec: CatalogSpec,
    previous: Mapping[str, DataFrame | None] | None = None,
) -> DataFrame:
    """All gates that do not need stored files: schema, row counts, keys, references, prefixes."""
    previous = previous or {}
    frames = [schema_gate(tables[o.name], o) for o in OUTPUTS]
    frames += [
        drift_gate(tables[o.name], previous.get(o.name), o.name, spec.max_drop_percent) for o in OUTPUTS
    ]
    return reduce(DataFrame.union, frames + content_gates(tables, spec))


def gate_report(
    stored: Mapping[str, DataFrame],
    spec: CatalogSpec,
    previous: Mapping[str, DataFrame | None] | None = None,
) -> DataFrame:
    """The full report on stored tables, as rows ``(name, ok, detail)``; each stored table is scanned once."""
    previous = previous or {}
    known = {name: table for name, table in previous.items() if table is not None}
    numbers = table_numbers(stored, spec)
    before = [table.agg(F.count(F.lit(1)).alias(f"{name}_before")) for name, table in known.items()]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [numbers, *before])
    numbers = both.agg(*(F.sum(c).alias(c) for c in both.columns)) if before else numbers
    n = {c: F.col(c) for c in numbers.columns}

    def none_of(column: str, name: str, what: str) -> Column:
        return _gate(name, n[column] == 0, n[column], what)

    def drift(output: Output, rows: Column) -> Column:
        if output.name not in known:
            return _gate(f"{output.name} rows", rows > 0, rows, " rows, the first release")
        earlier = n[f"{output.name}_before"]
        enough = rows >= F.lit(1 - spec.max_drop_percent / 100) * earlier
        return _gate(f"{output.name} rows", enough, rows, " rows, before ", earlier)

    def unique(key: str, name: str, empty_allowed: bool) -> Column:
        return _unique(name, empty_allowed, *(n[f"{key}_{c}"] for c in ("rows", "values", "nulls", "blanks")))

    rows = {"files": n["url_rows"], "metadata": n["record_id_rows"], "linkages": n["url_referring"]}
    gates = [drift(o, rows[o.name]) for o in OUTPUTS]
    gates += [
        unique("url", "files url unique", empty_allowed=True),
        none_of("file_bad", "files url prefix", f" not under {spec.base_url}"),
        none_of("negative", "files size", " sizes below zero"),
        _gate("linkages filled", n["url_referring"] > 0, n["url_referring"], " rows"),
        none_of("url_orphans", "linkages url found", " rows refer to no url"),
        none_of("link_bad", "linkages url prefix", f" not under {spec.base_url}"),
        unique("record_id", "metadata record_id unique", empty_allowed=False),
        none_of("record_bad", "metadata url prefix", f" not under {spec.records_url}"),
        none_of("record_id_orphans", "linkages record_id found", " rows refer to no record_id"),
    ]
    gates += [
        none_of(f"{o.name}_fallen", f"{o.name} sorted", f" falls in the order of {', '.join(o.sort)}") for o in OUTPUTS
    ]
    schemas = [schema_gate(stored[o.name], o) for o in OUTPUTS]
    return reduce(DataFrame.union, [*schemas, _rows(numbers, *gates)])


def enforce(report: DataFrame) -> list:
    """Log every gate; raise with all failed ones, else return the gates."""
    gates = report.collect()
    for gate in gates:
        logger.log(logging.INFO if gate["ok"] else logging.ERROR, "%s: %s", gate["name"], gate["detail"])
    failed = [g for g in gates if not g["ok"]]
    if failed:
        raise GateError("; ".join(f"{g['name']}: {g['detail']}" for g in failed))
    return gates
