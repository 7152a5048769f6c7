"""A load gate: the checks CHK-1 ... CHK-6 in the pass that writes a table.

The reference's constraints abort a load.  Here a row that breaks a rule is
written beside the others with its reason, in the same pass, and only the
catalog's entries differ: the table shows the accepted rows,
``<table>_quarantine`` the others.  Counts come from ``observe`` metrics of
that write, so no scan is added for them; what needs a grouping, whether a
key is repeated, is one partial aggregate over the key column.  A load with
more violations than allowed fails before the switch, and the table stays as
it was.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from starmart.operators.lookup import lookup_join
from starmart.session import write_table
from starmart.sources.catalog import replace_table

REASON, BAD = "violation", "quarantined"


@dataclass
class Rules:
    """``key``: unique and not null.  ``required``: not null.  ``foreign``:
    columns whose value here (the unknown member) or NULL resolves to no
    dimension row.  ``conditions``: reasons and the conditions that break them."""

    key: str | None = None
    required: Sequence[str] = ()
    foreign: Mapping[str, object] = field(default_factory=dict)
    conditions: Mapping[str, Column] = field(default_factory=dict)

    def reasons(self) -> dict[str, Column]:
        out = {f"null key {self.key}": F.col(self.key).isNull()} if self.key else {}
        out |= {f"null {c}": F.col(c).isNull() for c in self.required}
        out |= {f"orphan {c}": F.col(c).isNull() | (F.col(c) == F.lit(v)) for c, v in self.foreign.items()}
        return out | {r: F.coalesce(c, F.lit(False)) for r, c in self.conditions.items()}


class Violations(Exception):
    """More rows break the rules than the load allows."""


def gated_load(df: DataFrame, name: str, rules: Rules, partition_by: Sequence[str] = (),
               allowed: int | None = None) -> dict[str, int]:
    """Replace-load ``name`` with the rows of ``df`` that keep the rules, and
    ``<name>_quarantine`` with the others and their first reason.  Returns
    the counts of the write: rows, accepted, quarantined, nulls per column
    (``nulls <column>``) and rows per rule (a row may break several).  Every
    row of a repeated key is quarantined: none of them can be told right."""
    columns = df.columns
    reasons = rules.reasons()
    if rules.key:
        counts = df.where(F.col(rules.key).isNotNull()).groupBy(rules.key).agg(F.count(F.lit(1)).alias("__copies"))
        repeated = write_table(counts.where("__copies > 1"), "repeated_keys")
        if not repeated.isEmpty():
            df = lookup_join(df, repeated, rules.key, ["__copies"], rules.key)
            reasons[f"repeated key {rules.key}"] = F.coalesce(F.col("__copies") > 1, F.lit(False))
    first = F.coalesce(*[F.when(c, F.lit(r)) for r, c in reasons.items()], F.lit(None).cast("string"))
    flags = {f"__rule{i}": c for i, c in enumerate(reasons.values())}
    df = df.withColumns({REASON: first, **flags}).withColumn(BAD, F.col(REASON).isNotNull())
    seen = Observation("gate")
    observed = df.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(BAD).alias("quarantined"),
        *[F.count_if(F.col(c).isNull()).alias(f"nulls {c}") for c in columns],
        *[F.count_if(f).alias(r) for r, f in zip(reasons, flags)])

    def check() -> None:
        if allowed is not None and seen.get["quarantined"] > allowed:
            raise Violations(f"{name}: {seen.get['quarantined']} rows break the rules, {allowed} may")

    replace_table(observed.select(*columns, REASON, BAD), name, [*partition_by, BAD],
                  # folder names hold the flag as text
                  {name: f"{BAD} = 'false'", f"{name}_quarantine": f"{BAD} = 'true'"}, check)
    out = dict(seen.get)
    return {**out, "accepted": out["rows"] - out["quarantined"]}
