"""Top-N rows plus one "Others" row folding the rest.

Semantics: groups are ranked by value descending (NULLs first), ties broken by
the label columns ascending, so the ranking is total and repeatable.  Groups
ranked 1..N are kept with ``sort_rn`` = rank; when more than N groups exist,
one extra row with ``sort_rn`` = sentinel and fixed labels carries the sum of
all the others.  With N or fewer groups there is no Others row.

Plan: a global ``ROW_NUMBER() OVER (ORDER BY value)`` would sort every group in
one task.  Instead

* ``top``  = ``orderBy(...).limit(N)`` → TakeOrderedAndProject: each task keeps
  its own N best, the driver-side merge sees at most N × tasks rows;
* Others = (sum over all groups) − (sum over the top N) for exact types
  (decimal, integral): one aggregate over the N rows and a one-row total.  For floating values, where
  subtraction is not exact, the groups are left-anti-joined with the N top
  labels (a build side of at most N rows, so broadcasting it is bounded by N,
  never by the data) and summed.

The input is an aggregate (one row per label), so its size is the number of
distinct labels; the output has at most N + 1 rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType

SENTINEL_RANK = 999999


def top_n_with_others(
    groups: DataFrame,
    labels: list[str],
    value: str,
    n: int,
    others: dict[str, str],
    rank_col: str = "sort_rn",
    sentinel: int = SENTINEL_RANK,
) -> DataFrame:
    """``groups`` has one row per distinct ``labels`` tuple and a ``value``.

    ``others`` gives the label values of the folded row, e.g.
    ``{"type_label": "Others", "subtype": "(remaining subtypes)"}``.
    Output columns: ``rank_col, *labels, value``.
    """
    if n < 0:
        raise ValueError("n must be >= 0")
    order = [F.col(value).desc_nulls_first()] + [F.col(c).asc_nulls_first() for c in labels]
    g = groups.select(*labels, value)

    top = g.orderBy(*order).limit(n)
    ranked = top.select(
        F.row_number().over(Window.orderBy(*order)).cast("bigint").alias(rank_col),
        *labels, value,
    )

    vtype = groups.schema[value].dataType
    label_cols = [F.lit(others[c]).cast(groups.schema[c].dataType).alias(c) for c in labels]
    if isinstance(vtype, (DecimalType, IntegralType)):
        # exact arithmetic: Others = all groups − the top N.  The N ranked rows and the
        # one-row total meet in one aggregate, so the groups are ranked once.
        wide = (DecimalType(min(vtype.precision, 37), vtype.scale)
                if isinstance(vtype, DecimalType) else vtype)
        v = F.col(value).cast(wide)
        total = g.agg(F.sum(v).cast(wide).alias("__s"), F.count(v).alias("__c"),
                      F.count(F.lit(1)).alias("__n"))
        row = F.struct(rank_col, *labels, value)
        one = (ranked.select(row.alias("__r")).unionByName(total, allowMissingColumns=True)
               .agg(F.collect_list("__r").alias("__top"),            # at most N rows
                    F.max("__s").alias("__s"), F.max("__c").alias("__c"), F.max("__n").alias("__n")))
        zero = F.lit(0).cast(wide)
        listed = F.aggregate("__top", zero, lambda acc, x: (
            acc + F.coalesce(x[value].cast(wide), zero)).cast(wide))
        some = F.size(F.filter("__top", lambda x: x[value].isNotNull()))
        rest = F.when(F.col("__c") > some, F.coalesce(F.col("__s"), zero) - listed).cast(vtype)
        fold = F.struct(F.lit(sentinel).cast("bigint").alias(rank_col), *label_cols, rest.alias(value))
        both = F.when(F.col("__n") > F.size("__top"), F.concat("__top", F.array(fold))).otherwise(F.col("__top"))
        return one.select(F.explode(both).alias("__r")).select("__r.*")
    else:
        # floating values: sum the remaining groups themselves
        keys = top.select(*[F.col(c).alias(f"__k_{c}") for c in labels])
        cond = reduce(lambda a, b: a & b,
                      [F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in labels])
        rest = g.join(F.broadcast(keys), cond, "left_anti")
        folded = (rest.agg(F.sum(value).cast(vtype).alias(value),
                           F.count(F.lit(1)).alias("__n"))
                  .filter(F.col("__n") > 0)
                  .select(F.lit(sentinel).cast("bigint").alias(rank_col), *label_cols, value))
    return ranked.unionByName(folded)


def top_n_within(groups: DataFrame, by: list[str], labels: list[str], value: str, n: int,
                 others: dict[str, str], rank_col: str = "sort_rn",
                 sentinel: int = SENTINEL_RANK) -> DataFrame:
    """Top ``n`` + Others inside every group of ``by``; ``groups`` has one row per ``by`` and
    ``labels``, with an exact (decimal or integral) ``value``.

    The rank filter is pushed below the shuffle (``WindowGroupLimit``), so a task sends at
    most ``n`` rows of a group however many labels it has; Others is the group's total, a
    partially aggregated sum, less the rows listed."""
    if n < 1:
        raise ValueError("n must be >= 1")
    vtype = groups.schema[value].dataType
    if not isinstance(vtype, (DecimalType, IntegralType)):
        raise TypeError(f"{value} must be exact, not {vtype.simpleString()}")
    wide = (DecimalType(min(vtype.precision, 37), vtype.scale) if isinstance(vtype, DecimalType) else vtype)
    g = groups.select(*by, *labels, value)
    order = [F.col(value).desc_nulls_first()] + [F.col(c).asc_nulls_first() for c in labels]
    top = (g.withColumn(rank_col, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
           .where(F.col(rank_col) <= n).select(*by, F.col(rank_col).cast("bigint").alias(rank_col), *labels, value))
    v = F.col(value).cast(wide)
    total = g.groupBy(*by).agg(F.sum(v).cast(wide).alias("__s"), F.count(v).alias("__c"), F.count(F.lit(1)).alias("__n"))
    listed = top.groupBy(*by).agg(F.sum(v).cast(wide).alias("__ls"), F.count(v).alias("__lc"), F.count(F.lit(1)).alias("__ln"))
    zero = F.lit(0).cast(wide)
    rest = F.when(F.col("__c") > F.col("__lc"), F.coalesce("__s", zero) - F.coalesce("__ls", zero)).cast(vtype)
    same = reduce(lambda a, b: a & b, [total[c].eqNullSafe(listed[c]) for c in by])
    folded = (total.join(listed, same).where("__n > __ln")
              .select(*[total[c] for c in by], F.lit(sentinel).cast("bigint").alias(rank_col),
                      *[F.lit(others[c]).cast(groups.schema[c].dataType).alias(c) for c in labels], rest.alias(value)))
    return top.unionByName(folded)
