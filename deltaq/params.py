"""Parameters of the flagship query (segment and the two date thresholds)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class Q3Params:
    # The defaults of the three query parameters.
    segment: str = "AUTOMOBILE"
    order_date: dt.date = dt.date(1995, 3, 13)
    ship_date: dt.date = dt.date(1995, 3, 13)

    @property
    def order_date_sql(self) -> str:
        return f"DATE '{self.order_date.isoformat()}'"

    @property
    def ship_date_sql(self) -> str:
        return f"DATE '{self.ship_date.isoformat()}'"


DEFAULT = Q3Params()
