"""Small column expressions shared by the operators.

Missing values are NULL inside the library.  NaN and infinities are turned into NULL where a
table enters (``number``), because Spark orders NaN above every number and ``least``/``greatest``
skip NULL silently.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAIR = ["from_node_id", "to_node_id"]
KM_PER_MILE = 1.609344
METRES_PER_MILE = 1609.344


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def has(frame: DataFrame, *names: str) -> bool:
    return set(names) <= set(frame.columns)


def preferred(frame: DataFrame, names: Iterable[str]) -> str | None:
    """First of ``names`` that the table has."""
    return next((n for n in names if n in frame.columns), None)


def finite(value: Column | str) -> Column:
    """NULL unless the double is a real number."""
    v = col(value)
    return F.when(~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))), v)


def number(value: Column | str) -> Column:
    """Lenient conversion to double: bad text, NaN and infinity become NULL."""
    return finite(col(value).try_cast("double"))


def number_in(frame: DataFrame, name: str) -> Column:
    """``number`` of a column of a known table; plain when the column is integral already."""
    kind = frame.schema[name].dataType.simpleString()
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return F.col(name).cast("double")
    return number(name)


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """NULL unless the denominator is positive."""
    d = col(denominator)
    return F.when(d > 0, col(numerator) / d)


def zero_if_null(value: Column | str) -> Column:
    return F.coalesce(col(value), F.lit(0.0))


def capped(value: Column | str, limit: Column | str) -> Column:
    """Minimum of two values that is NULL as soon as one of them is."""
    v, m = col(value), col(limit)
    return F.when(v.isNotNull() & m.isNotNull(), F.least(v, m))


def is_close(a: Column | str, b: Column | str, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    """|a - b| <= atol + rtol |b|; NULL when a side is NULL."""
    return F.abs(col(a) - col(b)) <= F.lit(atol) + F.lit(rtol) * F.abs(col(b))


def differs(a: Column | str, b: Column | str, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    """Not close, where two NULLs count as equal and one NULL as different."""
    a, b = col(a), col(b)
    return F.when(a.isNull() & b.isNull(), False).otherwise(~F.coalesce(is_close(a, b, rtol, atol), F.lit(False)))


def first_positive(candidates: Sequence[tuple[Column, str]]) -> tuple[Column, Column]:
    """First finite and positive candidate, and the name it came from (NULL if none)."""
    if not candidates:
        return F.lit(None).cast("double"), F.lit(None).cast("string")
    hits = [(F.when(v > 0, v), name) for v, name in candidates]
    value = F.coalesce(*[h for h, _ in hits])
    source = F.coalesce(*[F.when(h.isNotNull(), F.lit(n)) for h, n in hits])
    return value, source


def positive_of(frame: DataFrame, candidates: Iterable[tuple[str, float]]) -> tuple[Column, Column]:
    """``first_positive`` over the columns the table really has, each with a unit factor."""
    return first_positive([(number_in(frame, n) * f, n) for n, f in candidates if n in frame.columns])


def normal_id(value: Column | str) -> Column:
    """Join text of a node or link id: trimmed, integer-like numbers without a fraction."""
    text = F.trim(col(value).cast("string"))
    as_number = number(text)
    whole = as_number.isNotNull() & (F.abs(as_number % 1) < 1e-9)
    return F.when(whole, as_number.cast("bigint").cast("string")).otherwise(text)


def pair_keys(frame: DataFrame, names: Sequence[str] = PAIR) -> DataFrame:
    """Normalise the pair columns only when they are not whole numbers already."""
    kinds = {frame.schema[n].dataType.simpleString() for n in names}
    if kinds <= {"int", "bigint"}:
        return frame.withColumns({n: F.col(n).cast("bigint") for n in names})
    return frame.withColumns({n: normal_id(n) for n in names})


def packed_pair(a: Column | str = "from_node_id", b: Column | str = "to_node_id") -> Column:
    """Both node ids in one BIGINT (ids below 2^31)."""
    return F.shiftleft(col(a).cast("bigint"), 32).bitwiseOR(col(b).cast("bigint"))


def pair_text(a: Column | str = "from_node_id", b: Column | str = "to_node_id") -> Column:
    return F.concat_ws("->", col(a).cast("string"), col(b).cast("string"))


# Texts that count as true.
TRUE_TEXTS = ("true", "1", "yes", "y")


def text_flag(value: Column | str) -> Column:
    return F.coalesce(F.lower(F.trim(col(value).cast("string"))).isin(*TRUE_TEXTS), F.lit(False))


def is_closed(frame: DataFrame, name: str = "allowed_use") -> Column:
    """Only the explicit word closes a link; a missing column closes none."""
    if name not in frame.columns:
        return F.lit(False)
    return F.coalesce(F.lower(F.trim(F.col(name).cast("string"))) == "closed", F.lit(False))


def facility_type(link_type: Column | str) -> Column:
    """Last digit of the link type (preprocessing and district comparison)."""
    return (col(link_type) % 10).cast("int")


def area_digit(link_type: Column | str) -> Column:
    """Hundreds digit of the link type (full link comparison calls this FT)."""
    return F.floor((col(link_type) / 100) % 10).cast("int")


def any_of(flags: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, flags)


def rounded(frame: DataFrame, digits: int, skip: Iterable[str] = ()) -> DataFrame:
    """Round every double column; the contract of report tables."""
    skip = set(skip)
    names = [f.name for f in frame.schema.fields if f.dataType.simpleString() == "double" and f.name not in skip]
    return frame.withColumns({n: F.round(n, digits) for n in names}) if names else frame
