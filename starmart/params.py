"""Business parameters of the pipeline.

The reference pins several of these as literals inside its SQL (the current
year, the monthly target, status and tier cuts, the known-bad row, the junk
ship mode, the postal-code fill) and uses the wall clock for "today".  Here
they are one frozen dataclass so every query is reproducible.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Params:
    # "today": recency, last_updated and audit columns are computed against it.
    as_of: dt.date = field(default_factory=dt.date.today)
    # year flagged as is_current_year in the time marts
    current_year: int = 2021
    # fixed values of the reference's marts
    monthly_target: int = 125000
    active_days: int = 90
    # customer status cuts, in days since the last purchase:
    # Very Active <= 30, Active <= 90, At Risk <= 180, Dormant <= 365, else Lost
    status_cuts: tuple[int, int, int, int] = (30, 90, 180, 365)
    # value tiers on total sales: VIP >= 10000, High Value >= 5000, Medium Value >= 1000
    tier_cuts: tuple[float, float, float] = (10000.0, 5000.0, 1000.0)
    rfm_buckets: int = 5
    # cleaning
    bad_row_ids: tuple[int, ...] = (1,)
    excluded_ship_modes: tuple[str, ...] = ("sas",)
    postal_fill: str = "05401"
    # "keep": join the fact to dim_product on product_id like the reference
    # (an id with two names doubles its lines); "dedupe": one row per id.
    fanout: str = "keep"
    # partitions used by the distributed ordering operators; None = session default
    order_partitions: int | None = None

    @property
    def audit_ts(self) -> dt.datetime:
        return dt.datetime.combine(self.as_of, dt.time())

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)


# Values for the driver's testdata (FIXTURES.md section 2): order dates run to
# 2001-08-01, customers spend far above the reference's tiers, and the
# reference's bad row id belongs to its own CSV, so nothing is dropped.
FIXTURE_PARAMS = Params(
    as_of=dt.date(2001, 8, 2),
    current_year=2001,
    tier_cuts=(3_000_000.0, 2_000_000.0, 1_000_000.0),
    bad_row_ids=(),
)
