"""Clock arithmetic: period texts, durations, minute labels and membership."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadlens.functions.columns import col

DAY = 1440

# The four periods of the model day and their default clock ranges.
DEFAULT_RANGES = {"am": "0600_0900", "md": "0900_1500", "pm": "1500_1900", "nt": "1900_0600"}
PERIOD_NUMBER = {"am": 1, "md": 2, "pm": 3, "nt": 4}

_RANGE = re.compile(r"(\d{1,2}):?(\d{2})_(\d{1,2}):?(\d{2})")


@dataclass(frozen=True)
class Period:
    """One period of the plan; ``end`` may be 1440, wrap-around means ``end <= start``."""

    name: str
    start: int
    end: int
    source: str = "configured"

    @property
    def minutes(self) -> int:
        return (self.end - self.start) % DAY or DAY

    @property
    def text(self) -> str:
        return f"{self.start // 60:02d}{self.start % 60:02d}_{self.end // 60:02d}{self.end % 60:02d}"

    def hours(self, midnight: str = "wrap") -> float:
        """Length in hours; ``truncate`` cuts a period that crosses midnight at 24:00."""
        if midnight == "wrap":
            return self.minutes / 60
        start, end = self.start // 60, self.end // 60
        return float((24 if end < start else end) - start)


def parse_range(text: str) -> tuple[int, int]:
    """``HHMM_HHMM`` (3-4 digits, optional colon, 2400 only as an end) to minutes."""
    match = _RANGE.fullmatch(str(text).strip())
    if not match:
        raise ValueError(f"not a period range: {text!r}")
    h1, m1, h2, m2 = map(int, match.groups())
    start, end = h1 * 60 + m1, h2 * 60 + m2
    if m1 > 59 or m2 > 59 or start >= DAY or end > DAY:
        raise ValueError(f"period range outside the day: {text!r}")
    return start, end


def periods_from(ranges: dict[str, str]) -> list[Period]:
    """Periods from configured texts, names lower-cased and unique."""
    names = [n.lower() for n in ranges]
    if len(set(names)) != len(names):
        raise ValueError("duplicate configured time periods")
    return [Period(n.lower(), *parse_range(t)) for n, t in ranges.items()]


def duration_minutes(start: Column | str, end: Column | str) -> Column:
    span = F.pmod(col(end) - col(start), F.lit(DAY))
    return F.when(span == 0, F.lit(DAY)).otherwise(span)


def in_period(minute: Column | str, start: Column | str, end: Column | str) -> Column:
    """Half-open membership with wrap-around; equal ends own the whole day."""
    m, s, e = col(minute), col(start), col(end)
    return F.pmod(m - s, F.lit(DAY)) < duration_minutes(s, e)


def label(minute: int) -> str:
    return f"{minute // 60:02d}:{minute % 60:02d}"
