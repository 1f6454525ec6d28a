"""A small metric layer: entities, relationships, facts, dimensions and
metrics declared once, queried by logical name.

Query compilation (all DataFrame operations, no SQL text generation):

1. Every metric belongs to one entity.  A requested dimension must live on
   that entity or on an ancestor reached through many-to-one relationships;
   otherwise the query is rejected (a fact cannot be cut by a sibling's
   dimension without fanning out).
2. Per metric entity, metrics are computed as decomposable aggregates
   (count, count_if, sum, avg = sum / count, min, max).  When a dimension or
   filter needs a parent, the entity is first aggregated to
   (foreign key, own dimensions) — map-side partial aggregation, so a hot
   parent key becomes one row per task — then left-joined to the parent's
   projection and re-aggregated.
3. Metrics of several entities are each aggregated at their own grain and
   combined by dimension values (union, then one group-by with ``max``, which
   groups NULL dimension values together like a null-safe join would).  No
   fact row is ever multiplied by another fact's rows (no chasm trap).
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType, StringType, StructField, StructType


class SemanticError(ValueError):
    """A query the model cannot answer without changing its meaning."""


@dataclass(frozen=True)
class Entity:
    """A table with a primary key.  ``table`` may be a function that returns the table: it is
    called when a query first reads the entity."""
    name: str
    table: DataFrame | Callable[[], DataFrame]
    primary_key: str


@dataclass(frozen=True)
class Relationship:
    """Many-to-one: ``child.foreign_key`` references ``parent``'s primary key."""
    child: str
    foreign_key: str
    parent: str


@dataclass(frozen=True)
class Field:
    """A named row-level expression of one entity (a fact or a dimension)."""
    entity: str
    name: str
    expr: str
    kind: str = "dimension"      # or "fact"


def fact(entity: str, name: str, expr: str) -> Field:
    return Field(entity, name, expr, "fact")


def dim(entity: str, name: str, expr: str) -> Field:
    return Field(entity, name, expr, "dimension")


_AGGS = {"count", "count_if", "sum", "avg", "min", "max"}
_METRIC_RE = re.compile(r"^\s*([A-Za-z_]+)\s*\((.*)\)\s*$", re.S)


@dataclass(frozen=True)
class Metric:
    """A named aggregate of one entity: ``AGG(expression)``."""
    entity: str
    name: str
    agg: str
    arg: str

    @classmethod
    def of(cls, entity: str, name: str, text: str) -> "Metric":
        """``Metric.of("deals", "won_deals", "COUNT_IF(deal_stage = 'Closed Won')")``"""
        m = _METRIC_RE.match(text)
        if not m or m.group(1).lower() not in _AGGS:
            raise SemanticError(f"metric {name}: expected AGG(expr) with AGG in {sorted(_AGGS)}")
        return cls(entity, name, m.group(1).lower(), m.group(2).strip())


_TOKEN = re.compile(r"'(?:[^']|'')*'|[A-Za-z_]\w*(?:\.[A-Za-z_]\w*)?(?!\w*\s*\()")


def _words(text: str) -> list[str]:
    """Names (``field`` or ``entity.field``) of a predicate, outside quoted literals."""
    return [w for w in _TOKEN.findall(text) if not w.startswith("'")]


def _replace_words(text: str, by: dict[str, str]) -> str:
    return _TOKEN.sub(lambda m: by.get(m.group(), m.group()), text)


_SORT_RE = re.compile(r"^\s*(.+?)(?:\s+(ASC|DESC))?(?:\s+NULLS\s+(FIRST|LAST))?\s*$", re.I)


def sort_spec(spec: Column | str) -> Column:
    """``"total_tickets DESC"`` → sort Column (default ASC; NULLs first for
    ASC and last for DESC, as Spark orders them)."""
    if not isinstance(spec, str):
        return spec
    m = _SORT_RE.match(spec)
    c = F.expr(m.group(1))
    desc = (m.group(2) or "ASC").upper() == "DESC"
    nulls = (m.group(3) or ("LAST" if desc else "FIRST")).upper()
    if desc:
        return c.desc_nulls_first() if nulls == "FIRST" else c.desc_nulls_last()
    return c.asc_nulls_first() if nulls == "FIRST" else c.asc_nulls_last()


class SemanticModel:
    """Entities, relationships, fields and metrics, queried by logical name."""
    def __init__(self, entities: list[Entity], relationships: list[Relationship],
                 fields: list[Field], metrics: list[Metric]):
        self.entities = {e.name: e for e in entities}
        self._frames: dict[str, DataFrame] = {}
        self.relationships = list(relationships)
        self.fields = self._by_name(fields, "field")
        self.metrics = self._by_name(metrics, "metric")
        for r in relationships:
            self._entity(r.child), self._entity(r.parent)

    # -- lookup -------------------------------------------------------------
    def _by_name(self, items: list, what: str) -> dict:
        """(entity, name in lower case) -> item; two entities may share a name."""
        out = {}
        for x in items:
            key = (self._entity(x.entity).name, x.name.lower())
            if key in out:
                raise SemanticError(f"{what} {x.entity}.{x.name} is declared twice")
            out[key] = x
        return out

    def _entity(self, name: str) -> Entity:
        if name not in self.entities:
            raise SemanticError(f"unknown entity {name!r}")
        return self.entities[name]

    def _name(self, name: str, table: dict, what: str):
        """The item called ``name`` or ``entity.name``; a bare name must be unique."""
        entity, _, bare = name.rpartition(".")
        found = [x for (e, n), x in table.items() if n == bare.lower() and entity in ("", e)]
        if not found:
            raise SemanticError(f"unknown {what} {name!r}")
        if len(found) > 1:
            raise SemanticError(f"{what} {name!r} is ambiguous: qualify it with one of "
                                f"{sorted(x.entity for x in found)}")
        return found[0]

    def field(self, name: str) -> Field:
        return self._name(name, self.fields, "field")

    def metric(self, name: str) -> Metric:
        return self._name(name, self.metrics, "metric")

    def path(self, child: str, ancestor: str) -> list[Relationship] | None:
        """Relationships leading from ``child`` up to ``ancestor`` (BFS)."""
        if child == ancestor:
            return []
        frontier = [(child, [])]
        seen = {child}
        while frontier:
            nxt = []
            for ent, p in frontier:
                for r in self.relationships:
                    if r.child == ent and r.parent not in seen:
                        if r.parent == ancestor:
                            return p + [r]
                        seen.add(r.parent)
                        nxt.append((r.parent, p + [r]))
            frontier = nxt
        return None

    def frame(self, entity: str) -> DataFrame:
        """The entity's table with every declared field under its logical name
        (physical columns stay available; unused ones are pruned by Catalyst)."""
        e = self._entity(entity)
        if entity not in self._frames:
            table = e.table if isinstance(e.table, DataFrame) else e.table()
            exprs = {f.name: F.expr(f.expr) for f in self.fields.values() if f.entity == entity}
            self._frames[entity] = table.withColumns(exprs)
        return self._frames[entity]

    # -- predicates ---------------------------------------------------------
    def _predicate(self, text: str) -> tuple[list[Field], dict[str, str]]:
        """The declared fields a predicate names, and what it calls each of them.

        Quoted literals and function names are skipped; a predicate must name a field,
        so it is never applied to a table by a chance physical column."""
        fields: list[Field] = []
        names: dict[str, str] = {}
        for word in _words(text):
            entity, _, bare = word.rpartition(".")
            if any(n == bare.lower() and entity in ("", e) for e, n in self.fields):
                f = self.field(word)
                fields.append(f)
                names[word] = f
        if not fields:
            raise SemanticError(f"predicate {text!r} names no declared field")
        return fields, names

    @staticmethod
    def _column(f: Field, entity: str) -> str:
        """The column that holds ``f`` in a frame of ``entity`` with parents joined."""
        return f.name if f.entity == entity else f"__{f.entity}__{f.name}"

    def _rewritten(self, text: str, names: dict, entity: str) -> Column:
        return F.expr(_replace_words(text, {w: f"`{self._column(f, entity)}`" for w, f in names.items()}))

    def _join_parents(self, df: DataFrame, entity: str, fields: list[Field]) -> DataFrame:
        """``df`` (a frame of ``entity``, or an aggregate of it by the first foreign keys)
        with the parents of ``fields`` joined; a parent's columns are prefixed with its
        name, so no key or field of two entities can meet."""
        joined = {entity}
        for f in sorted(fields, key=lambda f: len(self.path(entity, f.entity) or [])):
            child = entity
            for r in self.path(entity, f.entity) or []:
                if r.parent not in joined:
                    pe = self._entity(r.parent)
                    own = sorted({x.name for x in fields if x.entity == r.parent})
                    up = sorted({x.foreign_key for x in self.relationships if x.child == r.parent})
                    frame = self.frame(r.parent)
                    pf = frame.select(F.col(pe.primary_key).alias(f"__{r.parent}__pk"),
                                      *[F.col(x).alias(f"__{r.parent}__{x}") for x in own],
                                      *[F.col(x).alias(f"__{r.parent}__fk_{x}") for x in up])
                    key = r.foreign_key if child == entity else f"__{child}__fk_{r.foreign_key}"
                    df = df.join(pf, F.col(key) == F.col(f"__{r.parent}__pk"), "left")
                    joined.add(r.parent)
                child = r.parent
        return df

    def _output_names(self, fields: list[Field]) -> list[str]:
        """The fields' own names; those that two entities share, with the entity's in front."""
        bare = [f.name for f in fields]
        return [f.name if bare.count(f.name) == 1 else f"{f.entity}_{f.name}" for f in fields]

    # -- query --------------------------------------------------------------
    def query(self, metrics: list[str], dimensions: list[str] = (),
              where: list[str] | str | None = None, order_by: list[Column | str] | None = None,
              limit: int | None = None) -> DataFrame:
        """Metrics cut by dimensions, filtered by predicates over logical names."""
        if not metrics:
            raise SemanticError("no metrics")
        ms = [self.metric(m) for m in metrics]
        ds = [self.field(d) for d in dimensions]
        preds = [where] if isinstance(where, str) else list(where or [])
        dim_names = self._output_names(ds)
        m_names = self._output_names(ms)
        by_entity: dict[str, list[tuple[Metric, str]]] = {}
        for m, name in zip(ms, m_names):
            by_entity.setdefault(m.entity, []).append((replace(m, name=name), m))
        parts = [self._entity_query(ent, [m for m, _ in mets], ds, dim_names, preds)
                 for ent, mets in by_entity.items()]
        out = parts[0] if len(parts) == 1 else self._combine(parts, dim_names, m_names)
        out = out.select(*dim_names, *m_names)
        if order_by:
            out = out.orderBy(*[sort_spec(o) for o in order_by])
        if limit is not None:
            out = out.limit(limit)
        return out

    def _entity_query(self, entity: str, mets: list[Metric], ds: list[Field], dim_names: list[str],
                      preds: list[str]) -> DataFrame:
        parsed = [(p, *self._predicate(p)) for p in preds]
        used = [*ds, *[f for _, fields, _ in parsed for f in fields]]
        for f in used:
            if self.path(entity, f.entity) is None:
                raise SemanticError(
                    f"{f.name!r} cannot cut metrics of {entity!r}: {f.entity!r} is not reachable "
                    f"from {entity!r} through many-to-one relationships")
        base = self.frame(entity)
        remote = []
        for p, fields, names in parsed:
            if all(f.entity == entity for f in fields):
                base = base.filter(self._rewritten(p, names, entity))
            else:
                remote.append((p, fields, names))
        dims = [F.col(f"`{self._column(f, entity)}`").alias(n) for f, n in zip(ds, dim_names)]
        if all(f.entity == entity for f in used):
            aggs = [self._full(m, base) for m in mets]
            return base.groupBy(*dims).agg(*aggs) if dims else base.agg(*aggs)
        # pre-aggregate at (foreign keys to the first hop, own fields) grain
        fks = {self.path(entity, f.entity)[0].foreign_key for f in used if f.entity != entity}
        own = {f.name for f in ds if f.entity == entity}
        own |= {f.name for _, fields, _ in remote for f in fields if f.entity == entity}
        split = [self._split(m, base) for m in mets]
        pre = base.groupBy(*sorted(fks | own)).agg(*[c for partial, _ in split for c in partial])
        joined = self._join_parents(pre, entity, [*ds, *[f for _, fields, _ in remote for f in fields]])
        for p, _, names in remote:
            joined = joined.filter(self._rewritten(p, names, entity))
        finals = [fin for _, fin in split]
        return joined.groupBy(*dims).agg(*finals) if dims else joined.agg(*finals)

    # -- aggregate forms ------------------------------------------------------
    def _arg(self, m: Metric) -> Column:
        return F.expr(m.arg)

    def _sum_type(self, m: Metric, frame: DataFrame):
        dtype = frame.select(self._arg(m)).schema[0].dataType
        if isinstance(dtype, DecimalType):
            return f"decimal(38,{dtype.scale})"
        if isinstance(dtype, (DoubleType, FloatType)):
            return "double"
        return "bigint"

    def _full(self, m: Metric, frame: DataFrame) -> Column:
        x = self._arg(m)
        if m.agg == "count":
            return F.count(x).alias(m.name)
        if m.agg == "count_if":
            return F.count_if(x).cast("bigint").alias(m.name)
        if m.agg == "sum":
            return F.sum(x).cast(self._sum_type(m, frame)).alias(m.name)
        if m.agg == "avg":
            return F.avg(x).alias(m.name)
        if m.agg == "min":
            return F.min(x).alias(m.name)
        return F.max(x).alias(m.name)

    def _split(self, m: Metric, frame: DataFrame) -> tuple[list[Column], Column]:
        """(partial aggregates, final aggregate over the partials)."""
        x = self._arg(m)
        p = f"__p_{m.name}"
        if m.agg in ("count", "count_if"):
            part = F.count(x) if m.agg == "count" else F.count_if(x)
            return [part.cast("bigint").alias(p)], \
                F.coalesce(F.sum(p), F.lit(0)).cast("bigint").alias(m.name)
        if m.agg == "sum":
            t = self._sum_type(m, frame)
            return [F.sum(x).cast(t).alias(p)], F.sum(p).cast(t).alias(m.name)
        if m.agg == "avg":
            # the sum keeps the argument's own scale; one division, as Spark's own avg
            total, count = p + "_s", p + "_c"
            dtype = frame.select(x).schema[0].dataType
            s_, c_ = F.sum(total), F.sum(count)
            if isinstance(dtype, DecimalType):
                kind = frame.select(F.avg(x)).schema[0].dataType
                mean = (s_.cast(DecimalType(34, dtype.scale)) / c_.cast("decimal(20,0)")).cast(kind)
                part = F.sum(x).cast(DecimalType(38, dtype.scale))
            else:
                mean, part = s_ / c_, F.sum(x.cast("double"))
            return [part.alias(total), F.count(x).alias(count)], F.when(c_ > 0, mean).alias(m.name)
        agg = F.min if m.agg == "min" else F.max
        return [agg(x).alias(p)], agg(p).alias(m.name)

    def _combine(self, parts: list[DataFrame], dims: list[str], metrics: list[str]) -> DataFrame:
        typed = {}
        for part in parts:
            for f in part.schema.fields:
                typed[f.name] = f.dataType
        aligned = [part.select(*dims, *[F.col(m) if m in part.columns
                                         else F.lit(None).cast(typed[m]).alias(m)
                                         for m in metrics]) for part in parts]
        u = reduce(DataFrame.unionByName, aligned)
        aggs = [F.max(m).alias(m) for m in metrics]
        return u.groupBy(*dims).agg(*aggs) if dims else u.agg(*aggs)

    # -- row-level access -----------------------------------------------------
    def rows(self, entity: str, fields: list[str], where: list[str] | str | None = None,
             order_by: list[Column | str] | None = None, limit: int | None = None) -> DataFrame:
        """Row-level facts and dimensions of one entity (parents joined as
        needed), e.g. the customers with the lowest health score."""
        fs = [self.field(f) for f in fields]
        preds = [where] if isinstance(where, str) else list(where or [])
        parsed = [(p, *self._predicate(p)) for p in preds]
        used = fs + [f for _, more, _ in parsed for f in more]
        for f in used:
            if self.path(entity, f.entity) is None:
                raise SemanticError(f"{f.name!r} is not reachable from {entity!r}")
        df = self._join_parents(self.frame(entity), entity, used)
        for p, _, names in parsed:
            df = df.filter(self._rewritten(p, names, entity))
        out = df.select(*[F.col(f"`{self._column(f, entity)}`").alias(n)
                          for f, n in zip(fs, self._output_names(fs))])
        if order_by:
            out = out.orderBy(*[sort_spec(o) for o in order_by])
        if limit is not None:
            out = out.limit(limit)
        return out

    # -- introspection ----------------------------------------------------------
    def describe(self, spark: SparkSession) -> DataFrame:
        """(kind, entity, name, definition) for every declared element."""
        rows = [("entity", e.name, e.name, f"PRIMARY KEY ({e.primary_key})")
                for e in self.entities.values()]
        rows += [("relationship", r.child, f"{r.child}->{r.parent}",
                  f"({r.foreign_key}) REFERENCES {r.parent}") for r in self.relationships]
        rows += [(f.kind, f.entity, f.name, f.expr) for f in self.fields.values()]
        rows += [("metric", m.entity, m.name, f"{m.agg.upper()}({m.arg})")
                 for m in self.metrics.values()]
        schema = StructType([StructField(n, StringType()) for n in
                             ("kind", "entity", "name", "definition")])
        return spark.createDataFrame(rows, schema)
