"""Scalar column expressions used by the timing operators.

All relative times are carried as integer microseconds and converted to
seconds at the edge, so sums and differences are exact and the same on any
engine. Rounding to milliseconds is that of the double (half-even on its binary
value), decided on the integers and the double's exact distance from the midpoint.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EVENT_TYPE_PREFIX = "EVENT_TYPE_"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_ts(c) -> Column:
    """ISO-8601 string (``Z`` or offset, up to nanoseconds) -> TIMESTAMP; bad -> NULL."""
    return F.try_to_timestamp(col(c))


def micros(c) -> Column:
    """timestamp (LTZ or NTZ) -> integer microseconds since the epoch."""
    return F.unix_micros(col(c).cast("timestamp"))


def micros_between(start, end) -> Column:
    """F16: ``end - start`` in integer microseconds."""
    return micros(end) - micros(start)


def seconds(us) -> Column:
    """Integer microseconds -> DOUBLE seconds."""
    return col(us) / F.lit(1_000_000.0)


def seconds_between(start, end) -> Column:
    """F16: elapsed seconds between two timestamps."""
    return seconds(micros_between(start, end))


def round_ms(us) -> Column:
    """microseconds -> seconds rounded to 3 decimals, half-even on the double's binary value.

    That is what correct rounding of the double ``us / 1e6`` to three decimals
    gives: off the half-milliseconds the integer decides; on one, whether the
    double lies above or below it (most do), and only where it is exact, the even neighbour.
    """
    whole = F.floor(col(us) / F.lit(1000))
    over = col(us) - whole * F.lit(1000)
    return (whole + F.when(over == 500, _half_up_part(col(us), whole)).otherwise((over > 500).cast("long"))) / F.lit(1000.0)


def _half_up_part(us: Column, whole: Column) -> Column:
    """1 if the double ``us / 1e6`` rounds up from its half-millisecond, else 0.

    The exact product of the double with 10**6 is compared with ``us``: split
    in two parts of 26 bits, each part's product fits a double.
    """
    x = us.cast("double") / F.lit(1_000_000.0)
    scaled = x * F.lit(134_217_729.0)           # 2**27 + 1
    high = scaled - (scaled - x)
    low = x - high
    product = x * F.lit(1_000_000.0)
    error = (high * F.lit(1_000_000.0) - product) + low * F.lit(1_000_000.0)
    above = (product - us.cast("double")) + error
    return F.when(above > 0, F.lit(1)).when(above < 0, F.lit(0)).otherwise(F.pmod(whole, F.lit(2))).cast("long")


def clamp_round_ms(us) -> Column:
    """``max(0, round(x, 3))``."""
    return F.greatest(F.lit(0.0), round_ms(us))


def task_label(n) -> Column:
    """F8: zero-padded label ``task_%02d``."""
    return F.format_string("task_%02d", col(n))


def label_number(label, part: int = -1) -> Column:
    """Integer after ``_`` in a label; ``part`` picks the piece (-1 = last). NULL if not a number."""
    pieces = F.split(col(label), "_")
    piece = F.element_at(pieces, part) if part < 0 else F.get(pieces, part)
    return F.when(piece.rlike("^[0-9]+$"), piece.try_cast("long"))


def activity_label(activity_id, running_number) -> Column:
    """Label rule of an event history: missing -> running number, digits -> ``task_%02d``, else verbatim."""
    a = col(activity_id)
    return (
        F.when(a.isNull() | (a == ""), task_label(running_number))
        .when(a.rlike("^[0-9]+$"), task_label(a.try_cast("long")))
        .otherwise(a)
    )


def normalize_event_type(c) -> Column:
    """Accept ``ActivityTaskScheduled`` and ``EVENT_TYPE_ACTIVITY_TASK_SCHEDULED`` alike."""
    c = col(c)
    # The canonical spelling passes through without touching the regex engine.
    snake = F.upper(F.regexp_replace(c, "([a-z0-9])([A-Z])", "$1_$2"))
    return (F.when(c.startswith(EVENT_TYPE_PREFIX), c)
            .when(snake.startswith(EVENT_TYPE_PREFIX), snake)
            .otherwise(F.concat(F.lit(EVENT_TYPE_PREFIX), snake)))


def strip_host(worker) -> Column:
    """``"12@host"`` -> ``"12"``; no ``@`` -> unchanged."""
    w = col(worker)
    return F.when(w.contains("@"), F.split_part(w, F.lit("@"), F.lit(1))).otherwise(w)


def percent(part, whole) -> Column:
    """``part / whole * 100``; NULL when ``whole`` is 0."""
    return F.try_divide(col(part).cast("double"), col(whole).cast("double")) * F.lit(100.0)


def iso_string(ts) -> Column:
    """Timestamp -> ``yyyy-MM-ddTHH:mm:ss.ffffffZ`` (how run logs spell times)."""
    return F.date_format(col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def fixed3(x, width: int = 0) -> Column:
    """fixed-width 3-decimal text, e.g. ``%14.3f``."""
    return F.format_string(f"%{width}.3f" if width else "%.3f", col(x))


def floor_div(num, den) -> Column:
    """Exact integer floor division for ``den > 0`` (DECIMAL(38,0) arithmetic, no double rounding)."""
    n, d = col(num).cast("decimal(38,0)"), col(den).cast("decimal(38,0)")
    return ((n - F.pmod(n, d)) / d).cast("decimal(38,0)")


def half_up_div(num, den) -> Column:
    """``num / den`` rounded half-up to an integer, exactly, for integer inputs; NULL if ``den`` is 0."""
    n, d = col(num).cast("decimal(38,0)"), col(den).cast("decimal(38,0)")
    n2 = F.when(d < 0, -n).otherwise(n)
    d2 = F.abs(d)
    return F.when(d2 != 0, floor_div(n2 * 2 + d2, d2 * 2))


def fixed_ratio(num, den, decimals: int, scale: int = 1) -> Column:
    """Text of ``num * scale / den`` with ``decimals`` digits, rounded half-up on the exact ratio.

    Formatting a double with ``%.Nf`` on the JVM rounds its shortest decimal
    form, not its binary value, so report numbers are rounded as integers
    first and only then printed.
    """
    units = half_up_div(col(num).cast("decimal(38,0)") * F.lit(scale * 10 ** decimals), den)
    return F.format_string(f"%.{decimals}f", units.cast("double") / F.lit(float(10 ** decimals)))
