"""Rounding, ratios and averages."""

from __future__ import annotations


def half_even(x: str, places: int = 2) -> str:
    """Round to ``places`` with ties to the even digit, as a decimal.

    Six decimals settle the ties of a two-decimal ratio; rounding a double directly would not.
    """
    return f"bround(CAST({x} AS decimal(28,6)), {places})"


def r2(x: str) -> str:
    """Two decimals, ties to even, as a double."""
    return f"CAST({half_even(x)} AS double)"


def r2_or_zero(x: str) -> str:
    return r2(f"coalesce({x}, 0)")


def exact_avg(x: str) -> str:
    """Average from the exact decimal sum; NULL for a group without values."""
    return f"try_divide(CAST(sum({x}) AS double), count({x}))"


def conversion_rate(conversions: str, clicks: str) -> str:
    """Conversions in percent of clicks. No clicks gives 0 (see ``undefined_rate`` in quality)."""
    return r2(f"coalesce(try_divide({conversions}, {clicks}) * 100, 0)")


def engagement_score(minutes: str, views: str, clicks: str) -> str:
    """Weighted activity, exact in decimals. Not clamped."""
    return r2(f"0.3 * {minutes} + 0.2 * {views} + 0.5 * {clicks}")


def hours(minutes: str) -> str:
    return f"CAST(coalesce({minutes}, 0) AS double) / 60"


def per(value: str, divisor: str) -> str:
    """``value / divisor`` where the divisor is positive, else 0."""
    return f"if({divisor} > 0, try_divide(CAST({value} AS double), {divisor}), 0)"


def _rounded(x: str, places: int, up: str) -> str:
    """Rounds the exact binary value of a double, as languages with such doubles do.

    ``p``, the double next to ``x * 10^places``, lies on the same side of every half as that number, or on the
    half itself. Only there does it matter what the multiplication lost: ``lost`` is that, without error,
    from the upper 26 bits of ``x`` and the rest. If it is zero, ``up`` decides, where ``q`` is the whole
    number below. From 2^46 on doubles lie further apart than hundredths, and ``x`` stays as it is.

    The rare case is a lambda, which Spark does not compile: it would make the code of a report's columns
    too long for the JIT.
    """
    scale = f"{10 ** places}D"
    upper = "(z * 134217729D - (z * 134217729D - z))"
    lost = f"({upper} * {scale} - z * {scale} + (z - {upper}) * {scale})"
    q = f"floor(z * {scale})"
    at_half = f"{q} + if({lost} > 0 OR ({lost} = 0 AND {up.format(q=q)}), 1, 0)"
    x = f"CAST({x} AS double)"
    p = f"({x} * {scale})"
    return (f"(CASE WHEN abs({x}) < {2 ** 46}D THEN if({p} - floor({p}) = 0.5D, "
            f"CAST(transform(array({x}), z -> {at_half})[0] AS double), rint({p})) / {scale} ELSE {x} END)")


def round_even(x: str, places: int = 2) -> str:
    """``x``, a double, to ``places`` decimals; an exact tie goes to the even digit."""
    return _rounded(x, places, "{q} % 2 != 0")


def round_even_or_zero(x: str, places: int = 2) -> str:
    return round_even(f"coalesce({x}, 0)", places)


def to_fixed_even(x: str, places: int) -> str:
    """Text with exactly ``places`` decimals, exact ties to the even digit."""
    return f"CAST(CAST({round_even(x, places)} AS decimal(28,{places})) AS string)"


def fixed(x: str, places: int) -> str:
    """Text with exactly ``places`` decimals; an exact tie goes away from zero, as on report pages."""
    return (f"CAST(CAST({_rounded(x, places, 'z > 0')} "
            f"AS decimal(28,{places})) AS string)")
