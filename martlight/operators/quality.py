"""Declarative data tests: ``unique``, ``not_null`` and ``relationships``.

Each test has two forms:

* ``failures(...)`` — the failing rows as a DataFrame (what a data-test runner
  stores for inspection);
* a :class:`Check` — used by :func:`run_checks`, which reduces all checks to one
  small DataFrame ``(check, model, column_name, failures)``.

``run_checks`` reads each model once, whatever is tested on it.  Columns that relationships
connect form a key space; every row emits one entry ``(space, key, which column)`` per tested
column, and one aggregate over all models' entries counts each column's rows per key.  Those
counts answer every test: a key that a column holds twice, the NULL key of a column, a key that
the child holds and the parent doesn't.  The aggregate has a map-side part, so a hot key costs
one row per task before the only shuffle; a column tested for NULL alone emits its NULL rows only.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, DataType, FractionalType, DecimalType,
                               IntegralType, MapType, StructType)


def _cols(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


# --- failing rows ------------------------------------------------------------
def unique_failures(df: DataFrame, cols) -> DataFrame:
    """Key values occurring more than once (rows with a NULL key are skipped)."""
    cs = _cols(cols)
    nn = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cs])
    return (df.filter(nn).groupBy(*cs).agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1))


def not_null_failures(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def relationship_failures(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent row."""
    p = parent.select(F.col(pk).alias("__pk")).filter(F.col("__pk").isNotNull())
    return (child.filter(F.col(fk).isNotNull())
            .join(p, F.col(fk) == F.col("__pk"), "left_anti"))


# --- checks ------------------------------------------------------------------
@dataclass(frozen=True)
class Check:
    """One declared data test on a model column (or column tuple)."""
    kind: str                 # unique | not_null | relationships
    model: str
    column: str | tuple[str, ...]
    to_model: str | None = None
    to_column: str | None = None

    @property
    def column_name(self) -> str:
        return self.column if isinstance(self.column, str) else ",".join(self.column)

    @property
    def name(self) -> str:
        base = f"{self.kind}_{self.model}_{self.column_name.replace(',', '_')}"
        return base + (f"__{self.to_model}_{self.to_column}" if self.to_model else "")


# a model's tested columns
Node = tuple[str, tuple[str, ...]]


def _nodes(check: Check) -> list[Node]:
    """The tested columns and, of a relationship, the parent's."""
    own = (check.model, tuple(_cols(check.column)))
    if check.kind == "relationships":
        return [own, (check.to_model, (check.to_column,))]
    if check.kind not in ("unique", "not_null"):
        raise ValueError(f"unknown check kind {check.kind!r}")
    return [own]


def _key_spaces(checks: list[Check]) -> list[list[Node]]:
    """Columns that relationships connect, directly or over others, share a space."""
    space: dict[Node, list[Node]] = {}
    for ch in checks:
        nodes = _nodes(ch)
        for n in nodes:
            space.setdefault(n, [n])
        if space[nodes[0]] is not space[nodes[-1]]:
            joined = space[nodes[0]] + space[nodes[-1]]
            space.update(dict.fromkeys(joined, joined))
    return list({id(nodes): nodes for nodes in space.values()}.values())


def _key(cols: tuple[str, ...], kinds: list[DataType]) -> dict[str, Column]:
    """The key's columns by name, each an integer or a text; equal keys have equal columns."""
    key: dict[str, Column] = {}
    for i, (name, kind) in enumerate(zip(cols, kinds)):
        c = F.col(name).cast(kind)
        if isinstance(kind, IntegralType):
            key[f"number{i}"] = c.cast("bigint")
            continue
        if isinstance(kind, (StructType, ArrayType, MapType)):
            c = F.to_json(F.struct(c))
        elif isinstance(kind, BinaryType):
            c = F.hex(c)
        elif isinstance(kind, FractionalType) and not isinstance(kind, DecimalType):
            c = c + F.lit(0).cast(kind)          # -0.0 equals 0.0
        key[f"text{i}"] = c.cast("string")
    return key


def _kinds(models: dict[str, DataFrame], nodes: list[Node]) -> list[DataType]:
    """The types Spark compares a space's columns in."""
    schemas = [models[m].select(*cols).schema for m, cols in nodes]
    if any([f.dataType for f in x] != [f.dataType for f in schemas[0]] for x in schemas):
        schemas = [reduce(DataFrame.union, [models[m].select(*cols) for m, cols in nodes]).schema]
    return [f.dataType for f in schemas[0]]


def _known(cols: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def run_checks(models: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """Evaluate checks → ``(check_name, kind, model, column_name, failures)``.

    ``failures`` is the number of failing rows (``unique``: duplicated key
    values).  Passing checks report 0; an empty model fails nothing.
    """
    if not checks:
        raise ValueError("no checks")
    spaces = _key_spaces(checks)
    place = {n: (s, i) for s, nodes in enumerate(spaces) for i, n in enumerate(nodes)}
    keyed = {n for ch in checks if ch.kind != "not_null" for n in _nodes(ch)}
    nulls = {n for ch in checks if ch.kind == "not_null" for n in _nodes(ch)}

    keys = {n: {} for n in place}
    for nodes in spaces:
        if keyed & set(nodes):
            kinds = _kinds(models, nodes)
            keys.update((n, _key(n[1], kinds)) for n in nodes)
    names = sorted({c: None for key in keys.values() for c in key})
    typed = {c: F.lit(None).cast("bigint" if c.startswith("number") else "string") for c in names}

    def entry(n: Node, count: Column) -> Column:
        s, i = place[n]
        key = [{**typed, **keys[n]}[c].alias(c) for c in names]
        return F.struct(F.lit(s).alias("space"), F.lit(i).alias("slot"), *key, count.alias("n"))

    rows = []
    for m in dict.fromkeys(m for m, _ in place):
        own = [n for n in place if n[0] == m]
        if not keyed & set(own):                 # tested for NULL alone: one row per model
            one = models[m].agg(*[F.count_if(~_known(n[1])).alias(f"n{i}") for i, n in enumerate(own)])
            entries = [entry(n, F.col(f"n{i}")) for i, n in enumerate(own)]
        else:
            one, entries = models[m], []
            for n in own:
                e = entry(n, F.lit(1).cast("bigint"))
                if n not in nulls:
                    e = F.when(_known(n[1]), e)
                elif n not in keyed:
                    e = F.when(~_known(n[1]), e)
                entries.append(e)
        e = F.explode(F.array_compact(F.array(*entries))) if len(entries) > 1 else entries[0]
        rows.append(one.select(e.alias("e")).filter(F.col("e").isNotNull()).select("e.*"))
    width = max(len(nodes) for nodes in spaces)
    counts = reduce(DataFrame.unionAll, rows).groupBy("space", *names).agg(
        *[F.sum(F.when(F.col("slot") == i, F.col("n")).otherwise(0)).alias(f"n{i}") for i in range(width)])

    known = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in names], F.lit(False))

    def failures(ch: Check) -> Column:
        (s, i), (_, to) = place[_nodes(ch)[0]], place[_nodes(ch)[-1]]
        here = F.col("space") == s
        if ch.kind == "unique":
            return F.count_if(here & known & (F.col(f"n{i}") > 1))
        orphan = known & (F.col(f"n{to}") == 0) if ch.kind == "relationships" else ~known
        return F.coalesce(F.sum(F.when(here & orphan, F.col(f"n{i}"))), F.lit(0))

    one = counts.agg(*[failures(ch).cast("bigint").alias(f"f{k}") for k, ch in enumerate(checks)])
    lines = [F.struct(F.lit(ch.name).alias("check_name"), F.lit(ch.kind).alias("kind"),
                      F.lit(ch.model).alias("model"), F.lit(ch.column_name).alias("column_name"),
                      F.col(f"f{k}").alias("failures")) for k, ch in enumerate(checks)]
    return one.select(F.explode(F.array(*lines)).alias("r")).select("r.*")


def summarize(results: DataFrame) -> DataFrame:
    """One row: checks run, passed, failed, failing rows in total."""
    return results.agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(F.col("failures") == 0).cast("bigint").alias("passed"),
        F.count_if(F.col("failures") > 0).cast("bigint").alias("failed"),
        F.sum("failures").cast("bigint").alias("failing_rows"),
    )
