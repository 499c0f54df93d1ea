"""Ordering ledger for stock that lives three days: an ordered fold over the days of each key.

Each day depends on the shelf left the day before and on orders placed three days earlier, which
no window frame can express. Keys run in parallel; one key is one row per calendar day, so a
group's size is bounded by the calendar and not by the units behind it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.operators.partitioning import spread
from shelfcast.settings import Params

Keys = Sequence[str]

LEDGER_COLUMNS = ("r1", "r2", "w", "x", "s", "t_adj", "r1_adj", "r2_adj", "w_adj", "x_adj", "s_adj")
LEAD_DAYS = 3


def _pos(v: float) -> float:
    """Positive part; a missing number stays missing."""
    return v if v != v else max(v, 0.0)


@dataclass
class _Shelf:
    """Stock expiring in one and two days, and what is still to arrive by day."""

    one_day: float
    two_days: float
    arrivals: dict[int, float]
    waste: float = 0.0
    shortage: float = 0.0

    def use(self, day: int, used: float) -> None:
        held = self.one_day + self.two_days
        fresh = self.arrivals.get(day, 0.0)
        self.waste = _pos(self.one_day - used)
        self.shortage = _pos(used - held - fresh)
        self.one_day = _pos(held - used - self.waste)
        self.two_days = _pos(fresh - _pos(used - held))

    def reorder(self, day: int, target: float) -> None:
        under_way = self.arrivals.get(day + 1, 0.0) + self.arrivals.get(day + 2, 0.0)
        need = _pos(target - under_way - self.one_day - self.two_days + 1)
        self.arrivals[day + LEAD_DAYS] = need if need != need else math.floor(need)

    def cells(self, day: int) -> tuple[float, ...]:
        return (
            self.one_day, self.two_days, self.waste, self.arrivals.get(day, 0.0), self.shortage
        )


@dataclass(frozen=True)
class _Fold:
    """The ledger of one key, in day order."""

    offset: int
    min_inventory: float
    collection: tuple[float, ...]
    expiry: tuple[float, float]
    consistent_first_row: bool
    keys: tuple[str, ...] = field(default=())

    def __call__(self, days: pd.DataFrame) -> pd.DataFrame:
        days = days.sort_values("date", kind="stable").reset_index(drop=True)
        if self.offset >= len(days):
            raise ValueError(f"the ledger starts after {self.offset} days, but there are only {len(days)}")
        rows = self._rows(days["plt_used"].astype(float), days["t_pred"].astype(float))
        cells = pd.DataFrame(rows, columns=list(LEDGER_COLUMNS), dtype=float)
        return pd.concat([days[[*self.keys, "date", "plt_used", "t_pred"]], cells], axis=1)

    def _rows(self, used: pd.Series, target: pd.Series) -> list[tuple[float, ...]]:
        used, target = used.tolist(), target.tolist()
        idle = (0.0,) * 5
        out = [(*idle, t, *idle) for t in target[: self.offset]]
        first = {self.offset + i: float(c) for i, c in enumerate(self.collection)}
        plain = _Shelf(*map(float, self.expiry), dict(first))
        adjusted = _Shelf(0.0, 0.0, dict(first))

        day = self.offset
        one, two = plain.one_day, plain.two_days
        plain.use(day, used[day])
        if not self.consistent_first_row:
            plain.shortage = _pos(used[day] - one + two - plain.arrivals[day])
        plain.reorder(day, target[day])
        adjusted.arrivals[day + LEAD_DAYS] = plain.arrivals[day + LEAD_DAYS]
        out.append(self._row(plain, adjusted, day, target[day]))

        for day in range(self.offset + 1, len(used)):
            plain.use(day, used[day])
            plain.reorder(day, target[day])
            gap = _pos(self.min_inventory - plain.one_day - plain.two_days)
            adjusted.use(day, used[day])
            adjusted.reorder(day, target[day] + gap)
            out.append(self._row(plain, adjusted, day, target[day] + gap))
        return out

    @staticmethod
    def _row(plain: _Shelf, adjusted: _Shelf, day: int, target: float) -> tuple[float, ...]:
        return (*plain.cells(day), target, *adjusted.cells(day))


def order_ledger(
    days: DataFrame,
    params: Params = Params(),
    keys: Keys = (),
    offset: int | None = None,
    min_inventory: float | None = None,
    consistent_first_row: bool = False,
    partitioned: bool = False,
) -> DataFrame:
    """Stock, waste, orders and shortage per day, as predicted and with a minimum held.

    ``days`` has one row per key and calendar day with ``plt_used`` and ``t_pred``. The first
    ``offset`` rows (default ``start - 1``) are zero. A NULL usage or prediction makes the rest of
    that key's ledger NULL. ``alert`` marks stock at or under the minimum.

    The first row's shortage *adds* the stock expiring in two days; ``consistent_first_row``
    subtracts it as all later rows do. ``partitioned`` says the days are hash-partitioned by the
    keys already and need no further shuffle.
    """
    fold = _Fold(
        offset=params.start - 1 if offset is None else offset,
        min_inventory=params.min_inventory if min_inventory is None else min_inventory,
        collection=tuple(params.initial_collection),
        expiry=tuple(params.initial_expiry),
        consistent_first_row=consistent_first_row,
        keys=tuple(keys),
    )
    days = days.select(
        *keys, "date", F.col("plt_used").cast("double"), F.col("t_pred").cast("double")
    )
    schema = T.StructType(
        [*days.schema.fields, *[T.StructField(c, T.DoubleType()) for c in LEDGER_COLUMNS]]
    )
    days = days if partitioned else spread(days, keys)
    ledger = days.groupBy(*keys).applyInPandas(lambda pdf: fold(pdf), schema)
    head = [*keys, "date", "plt_used", "t_pred"]
    alert = (F.col("r1") + F.col("r2")) <= F.lit(float(fold.min_inventory))
    return ledger.select(*head, alert.alias("alert"), *LEDGER_COLUMNS)


def low_stock_alerts(ledger: DataFrame, keys: Keys = ()) -> DataFrame:
    """Days whose ledger raises an alert."""
    return ledger.filter("alert").select(*keys, "date", "r1", "r2")
