"""Service-type helpers for metered usage.

A *service family* is the set of metered service types a report covers.  It
is declared by three kinds of rule, mirroring how such families are usually
written in SQL:

* case-insensitive prefixes (``ILIKE 'PREFIX%'``),
* case-sensitive prefixes (``STARTSWITH``),
* exact names.

NULL in gives NULL out, like the SQL predicate (a NULL row is then dropped by
``filter``).  Everything here is a plain Column expression: it stays inside
whole-stage codegen; the case-sensitive prefix arm alone would be pushed to
the parquet scan, the OR with the ILIKE arm runs right after the scan.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ServiceFamily:
    """The service types a report covers, by prefix and exact-name rules."""
    ci_prefixes: tuple[str, ...] = ()
    prefixes: tuple[str, ...] = ()
    exact: tuple[str, ...] = ()

    def contains(self, col: Column | str) -> Column:
        c = F.col(col) if isinstance(col, str) else col
        arms: list[Column] = []
        # case-insensitive prefix == ILIKE 'prefix%' without LIKE escaping rules
        arms += [F.lower(c).startswith(p.lower()) for p in self.ci_prefixes]
        arms += [c.startswith(p) for p in self.prefixes]
        if self.exact:
            arms += [c == e for e in self.exact]
        if not arms:
            return F.lit(False)
        out = arms[0]
        for a in arms[1:]:
            out = out | a
        return out

    def sql(self, col: str) -> str:
        """The same predicate as ANSI SQL text (used by the DuckDB oracle)."""
        arms = [f"starts_with(lower({col}), '{_q(p.lower())}')" for p in self.ci_prefixes]
        arms += [f"starts_with({col}, '{_q(p)}')" for p in self.prefixes]
        arms += [f"{col} = '{_q(e)}'" for e in self.exact]
        return "(" + " OR ".join(arms or ["FALSE"]) + ")"


@dataclass(frozen=True)
class ServiceLabels:
    """Display label per service type; unknown types pass through unchanged."""

    mapping: tuple[tuple[str, str], ...] = field(default_factory=tuple)

    def label(self, col: Column | str) -> Column:
        c = F.col(col) if isinstance(col, str) else col
        if not self.mapping:
            return c
        expr = None
        for key, text in self.mapping:
            expr = (F.when(c == key, F.lit(text)) if expr is None
                    else expr.when(c == key, F.lit(text)))
        return expr.otherwise(c)

    def sql(self, col: str) -> str:
        if not self.mapping:
            return col
        whens = " ".join(f"WHEN '{_q(k)}' THEN '{_q(v)}'" for k, v in self.mapping)
        return f"(CASE {col} {whens} ELSE {col} END)"


def _q(s: str) -> str:
    return s.replace("'", "''")


# --- the vocabulary of the bound events (sources/bindings.py) ---------------
# A service type is the part of the site an event meters, a dot and the event.
# A deployment passes its own family, labels and known list in its settings.
DEMO_FAMILY = ServiceFamily(ci_prefixes=("web.",), prefixes=("shop.",), exact=("account",))

DEMO_LABELS = ServiceLabels((
    ("account", "Accounts"),
    ("shop.purchase", "Purchases"),
    ("web.click", "Page clicks"),
    ("web.error", "Failed requests"),
    ("web.view", "Page views"),
))

DEMO_KNOWN_TYPES = ", ".join(key for key, _ in DEMO_LABELS.mapping)
