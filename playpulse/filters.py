"""The two filters a report takes: an inclusive date range and a platform set."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_literal(value: date) -> Column:
    """A DATE constant for any year from 1 to 9999; a Python date goes wrong before 1000."""
    return F.lit(value.isoformat()).cast("date")


def _as_date(value: date | str | None, which: str) -> date:
    if value is None:
        raise ValueError(f"{which} is missing: a date range needs both bounds")
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    return date.fromisoformat(value)


@dataclass(frozen=True)
class PlayerFilter:
    """Dates are inclusive at both ends; a lower bound past the upper one selects nothing.

    ``platforms=None`` means every platform (players without one included),
    an empty collection means no platform, hence no rows. Of a ``datetime`` only the date
    counts.
    """

    date_from: date
    date_to: date
    platforms: tuple[str, ...] | None = None

    def __init__(
        self,
        date_from: date | str | None,
        date_to: date | str | None,
        platforms: Iterable[str] | None = None,
    ) -> None:
        if isinstance(platforms, str):
            raise TypeError("platforms takes a collection of names, not one string")
        object.__setattr__(self, "date_from", _as_date(date_from, "date_from"))
        object.__setattr__(self, "date_to", _as_date(date_to, "date_to"))
        object.__setattr__(self, "platforms", None if platforms is None else tuple(platforms))

    def in_range(self, day: str) -> Column:
        """Predicate on a date column, as literals the file scan can prune on."""
        return F.col(day).between(date_literal(self.date_from), date_literal(self.date_to))

    def on_platform(self, platform: str = "platform") -> Column:
        """Predicate on the *player's* platform; purchases carry their own, which is not used."""
        if self.platforms is None:
            return F.lit(True)
        return F.col(platform).isin(list(self.platforms))
