"""Report filters: parameters -> a list of Column predicates.

A predicate is added only when its parameter is set, so every predicate that remains is
a plain comparison Catalyst can push into the scan (partition filters on ``usage_date``,
Parquet filters on the raw timestamp).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adoptlens.functions.calendar import DEFAULT_TZ, local_midnight_utc, utc_literal
from adoptlens.functions.features import has_any_tool
from adoptlens.functions.text import like_needle

# Columns searched by the free-text box, in the reference's order.
SEARCH_COLUMNS = ["user_email", "workforce_name", "practice", "location", "access_point", "product_area"]

# Multi-select dimensions: parameter name -> usage column.
USAGE_DIMS = {
    "practices": "practice",
    "teams": "team",
    "locations": "location",
    "accesses": "access_point",
    "designations": "designation",
}
ROSTER_DIMS = {"practices": "practice", "teams": "team", "locations": "location", "designations": "designation"}


def _as_date(d):
    if d is None or isinstance(d, dt.date):
        return d
    return dt.date.fromisoformat(str(d))


@dataclass(frozen=True)
class Filters:
    practices: list[str] | None = None
    teams: list[str] | None = None
    locations: list[str] | None = None
    accesses: list[str] | None = None
    designations: list[str] | None = None
    products: list[str] | None = None
    start_date: dt.date | str | None = None
    end_date: dt.date | str | None = None
    search: str | None = None
    tz: str = DEFAULT_TZ
    exclude: tuple[str, ...] = field(default=())

    def is_empty(self) -> bool:
        """True when no filter is set (the snapshot may then answer)."""
        lists = [self.practices, self.teams, self.locations, self.accesses, self.designations, self.products]
        return (all(not v for v in lists) and self.start_date is None and self.end_date is None
                and not like_needle(self.search))

    def without(self, *names: str) -> "Filters":
        """Copy that ignores the named parameters (self-excluding facets)."""
        return replace(self, exclude=tuple(self.exclude) + names)

    def predicates(self, df: DataFrame, dims: dict[str, str] = USAGE_DIMS,
                   instant_col: str | None = "utc_time") -> list[Column]:
        preds: list[Column] = []
        for param, col in dims.items():
            values = getattr(self, param)
            if values and param not in self.exclude:
                preds.append(F.col(col).isin(list(values)))
        if self.products and "products" not in self.exclude and "product_area" in df.columns:
            preds.append(has_any_tool("product_area", list(self.products)))
        start, end = _as_date(self.start_date), _as_date(self.end_date)
        if "dates" not in self.exclude:
            if start is not None:
                preds.append(F.col("usage_date") >= F.lit(start))
            if end is not None:
                preds.append(F.col("usage_date") <= F.lit(end))
            # Same bounds on the stored instant: lets the Parquet reader skip row groups
            # when usage_date is derived rather than a partition column.
            if instant_col and instant_col in df.columns:
                ts = F.col(instant_col)
                ts_type = df.schema[instant_col].dataType
                if start is not None:
                    preds.append(ts >= utc_literal(local_midnight_utc(start, self.tz), ts_type.simpleString()))
                if end is not None:
                    nxt = end + dt.timedelta(days=1)
                    preds.append(ts < utc_literal(local_midnight_utc(nxt, self.tz), ts_type.simpleString()))
        needle = like_needle(self.search)
        if needle and "search" not in self.exclude:
            pattern = f"%{needle}%"
            cols = [c for c in SEARCH_COLUMNS if c in df.columns]
            preds.append(reduce(lambda a, b: a | b,
                                [F.lower(F.coalesce(F.col(c), F.lit(""))).like(pattern) for c in cols]))
        return preds

    def apply(self, df: DataFrame, dims: dict[str, str] = USAGE_DIMS,
              instant_col: str | None = "utc_time") -> DataFrame:
        for p in self.predicates(df, dims, instant_col):
            df = df.filter(p)
        return df


def single_value(df: DataFrame, **params: str) -> DataFrame:
    """Legacy single-value filters: each ``column='value'``; the value 'All' switches it off."""
    for col, value in params.items():
        if value is not None and value != "All":
            df = df.filter(F.col(col) == value)
    return df


def non_blank(col: str) -> Column:
    return F.col(col).isNotNull() & (F.col(col) != "")
