"""Scalar column functions (X1-X14). Each takes and returns a ``Column``.

All are native Catalyst expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def to_timestamp_or_null(c, fmt: str | None = None, naive: bool = True) -> Column:
    """Text -> timestamp, unparseable -> null (pandas ``errors='coerce'``).

    ``naive`` (default) gives TIMESTAMP_NTZ, like pandas' naive datetimes, so
    the value does not depend on the session time zone.
    """
    c = _c(c)
    if fmt:
        ts = F.try_to_timestamp(c, F.lit(fmt))
        return ts.cast("timestamp_ntz") if naive else ts
    return c.try_cast("timestamp_ntz") if naive else F.try_to_timestamp(c)


def utc_wall_time(c) -> Column:
    """Instant (TIMESTAMP) -> its UTC wall time as TIMESTAMP_NTZ, whatever the
    session time zone (a naive value is returned unchanged)."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(c)), epoch)


def to_number_or_null(c, dtype: str = "double") -> Column:
    """Any -> number, bad -> null (pandas ``to_numeric(errors='coerce')``). NaN counts as
    missing; a whole number with a decimal point (``2001.0``) is an integer, another
    fraction is no valid integer and becomes null."""
    c = _c(c)
    number = F.nullif(F.nanvl(c.try_cast("double"), F.lit(None).cast("double")), F.lit(float("nan")))
    if dtype in ("double", "float"):
        return number.cast(dtype)
    whole = F.when(number == F.floor(number), number.try_cast(dtype))
    return F.coalesce(c.cast("string").try_cast(dtype), whole)


def to_ts(c, fmt: str | None = None) -> Column:
    """Text -> timestamp (strict)."""
    return F.to_timestamp(_c(c), fmt) if fmt else F.to_timestamp(_c(c))


def to_day(c) -> Column:
    """Timestamp -> date."""
    return F.to_date(_c(c))


def week_start(c) -> Column:
    """Monday of the week, as a DATE (``date_trunc('week')``)."""
    return F.to_date(F.date_trunc("week", _c(c)))


def round_half_up(c, scale: int) -> Column:
    """SQL ``ROUND`` (half-up)."""
    return F.round(_c(c), scale)


def round_half_even(c, scale: int = 2) -> Column:
    """Numpy-style rounding: scale, round half to even, unscale."""
    k = float(10 ** scale)
    return F.rint(_c(c) * F.lit(k)) / F.lit(k)


#: Field texts that a CSV reader takes as missing, beside the empty field.
MISSING = ("NA", "N/A", "n/a", "NULL", "null", "NaN", "nan", "None", "<NA>", "#N/A")


def missing_to_null(c, tokens=MISSING) -> Column:
    """A text field that is one of ``tokens`` is missing."""
    return F.when(~one_of(c, tokens), _c(c))


def weighted_sum(terms: list[tuple[float, object]]) -> Column:
    """``sum(w_i * c_i)`` with double weights."""
    out = None
    for w, c in terms:
        t = _c(c) * F.lit(float(w))
        out = t if out is None else out + t
    return out


def flag01(cond: Column) -> Column:
    """Boolean -> 1/0 (null -> 0, like ``np.where``)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def run_timestamp(ts: str | None = None) -> Column:
    """Load time stamp (naive wall time, like ``NOW()`` into a Postgres
    TIMESTAMP); a fixed ``ts`` text makes reruns and tests repeatable."""
    return F.lit(ts).cast("timestamp_ntz") if ts else F.localtimestamp()


def record_json(*cols) -> Column:
    """X11: whole record -> JSON text, null fields kept."""
    return F.to_json(F.struct(*[_c(c) for c in cols]), {"ignoreNullFields": "false"})


def int_or_zero(c) -> Column:
    """To int, truncated toward zero, with 0 for a missing, null or bad value."""
    c = _c(c)
    return F.coalesce(c.cast("string").try_cast("int"), c.try_cast("double").try_cast("int"), F.lit(0))


def one_of(c, values) -> Column:
    """Membership in constants."""
    return _c(c).isin(list(values))


def true_only(cond: Column) -> Column:
    """Three-valued logic helper: unknown counts as false."""
    return F.coalesce(cond, F.lit(False))
