"""The order fact, refreshed from what has changed.

The fact is kept in parts of ``span`` order keys.  A version's manifest holds, for each
part, a signature of the source rows it was made from: row counts and sums of row hashes
of the orders and of the lines.  A refresh takes the signatures of the sources anew (one pass
of the columns the fact uses, summed in the map tasks: one row per part leaves them),
and only parts whose signature differs are joined and written again.  So inserts, updates and
deletes are found without a log of changes, orders that move between dates included; a
source that keeps such a log gives the touched keys itself and the pass is saved.

The filter on the touched parts is a set of key ranges, which the parquet scans of both
sources get as pushed filters.  Publishing is the one step of
:mod:`martlight.operators.versions`: a refresh that fails changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlight.operators.versions import VersionedTable, Version
from martlight.plans.marts import fct_orders

SPAN = 1_000_000          # order keys of a part
MAX_RANGES = 200          # beyond, the touched parts are joined instead of listed
_ORDER_COLUMNS = ["order_key", "customer_key", "order_status", "order_date", "order_priority"]
_LINE_COLUMNS = ["order_key", "extended_price", "discount", "tax"]


def part_of(span: int) -> Column:
    """The part of an order key; keys below zero have parts below zero."""
    return F.floor(F.col("order_key") / F.lit(span)).cast("bigint")


def signatures(stg_ord: DataFrame, stg_line: DataFrame, span: int = SPAN) -> DataFrame:
    """part, signature of the source rows of every part."""
    def hashed(df: DataFrame, cols: list[str], side: int) -> DataFrame:
        h = F.xxhash64(*cols, F.lit(side)).cast("decimal(38,0)")
        return df.where("order_key is not null").select(part_of(span).alias("part"), F.lit(side).alias("side"), h.alias("h"))

    rows = hashed(stg_ord, _ORDER_COLUMNS, 0).unionByName(hashed(stg_line, _LINE_COLUMNS, 1))
    each = [F.concat_ws(":", F.count(F.when(F.col("side") == s, 1)).cast("string"),
                        F.coalesce(F.sum(F.when(F.col("side") == s, F.col("h"))), F.lit(0)).cast("string"))
            for s in (0, 1)]
    return rows.groupBy("part").agg(F.concat_ws("|", *each).alias("signature"))


def ranges(parts: Iterable[int]) -> list[tuple[int, int]]:
    """Neighbouring parts as (first, last)."""
    out: list[list[int]] = []
    for p in sorted(parts):
        if out and p == out[-1][1] + 1:
            out[-1][1] = p
        else:
            out.append([p, p])
    return [(a, b) for a, b in out]


def only_parts(df: DataFrame, parts: set[int], span: int) -> DataFrame:
    """The rows of these parts."""
    found = ranges(parts)
    if len(found) > MAX_RANGES:
        spark = df.sparkSession
        keys = spark.createDataFrame([(p,) for p in sorted(parts)], "part bigint")
        return df.withColumn("part", part_of(span)).join(keys, "part", "left_semi").drop("part")
    ok = F.lit(False)
    for a, b in found:
        ok = ok | F.col("order_key").between(F.lit(a * span), F.lit((b + 1) * span - 1))
    return df.where(ok)


class IncrementalFact:
    """``fct_orders`` below ``path``, refreshed part by part."""

    def __init__(self, spark: SparkSession, path: str, span: int = SPAN):
        self.table = VersionedTable(spark, path)
        self.span = span

    def read(self, number: int | None = None) -> DataFrame:
        return self.table.read(number)

    def refresh(self, stg_ord: DataFrame, stg_line: DataFrame) -> set[int]:
        """Bring the table up to the sources; returns the parts that were written."""
        base = self._base()
        now = {r["part"]: r["signature"] for r in signatures(stg_ord, stg_line, self.span).collect()}  # one row per part
        known = {int(k): v for k, v in base.facts.get("signatures", {}).items()}
        touched = {p for p in now.keys() | known.keys() if now.get(p) != known.get(p)}
        if touched or not base.number:
            self._write(base, stg_ord, stg_line, touched, now)
        return touched

    def apply(self, stg_ord: DataFrame, stg_line: DataFrame, changed: DataFrame) -> set[int]:
        """As :meth:`refresh`, for the parts of the keys in ``changed`` (``order_key``, from a log of
        changed orders and lines) alone."""
        base = self._base()
        if not base.number:
            return self.refresh(stg_ord, stg_line)
        touched = {r["part"] for r in changed.where("order_key is not null").select(part_of(self.span).alias("part"))
                   .distinct().collect()}
        if touched:
            now = {r["part"]: r["signature"] for r in
                   signatures(only_parts(stg_ord, touched, self.span), only_parts(stg_line, touched, self.span),
                              self.span).collect()}
            known = {int(k): v for k, v in base.facts["signatures"].items() if int(k) not in touched}
            self._write(base, stg_ord, stg_line, touched, known | now)
        return touched

    def _base(self) -> Version:
        base = self.table.version()
        if base.number and base.facts.get("span") != self.span:
            raise ValueError(f"the table has parts of {base.facts.get('span')} keys, not {self.span}")
        return base

    def _write(self, base: Version, stg_ord: DataFrame, stg_line: DataFrame, touched: set[int], now: dict) -> None:
        fact = fct_orders(only_parts(stg_ord, touched, self.span), only_parts(stg_line, touched, self.span))
        self.table.replace_parts(fact.withColumn("part", part_of(self.span)), "part", map(str, touched),
                                 {"span": self.span, "signatures": {str(k): v for k, v in now.items()}}, base)
