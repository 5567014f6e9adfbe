"""Statistics of one series, computed inside its row (SQL text).

A series is at most one value per calendar position, so each of these is a short loop in the JVM
without a shuffle.
"""

from __future__ import annotations

from wattline import constants as C
from wattline.functions.lists import let, once

PERIOD = 12
HALF = PERIOD // 2
MIN_SEASONAL = 2 * PERIOD
# A spread below this share of the largest value is rounding noise.
NOISE = 1e-9


def total(items: str) -> str:
    return f"aggregate({items}, 0D, (acc, x) -> acc + x)"


def mean(items: str) -> str:
    return once(items, "xs", lambda a: f"try_divide({total(a)}, size({a}))")


def _with_moments(items: str, body: str) -> str:
    """``body`` over the items ``xs``, their mean ``mu`` and population deviation ``sd``."""
    squares = "aggregate(xs, 0D, (acc, x) -> acc + (x - mu) * (x - mu))"
    deviation = f"sqrt(try_divide({squares}, size(xs)))"
    return let(items, "xs", let(mean("xs"), "mu", let(deviation, "sd", body)))


def zscores(readings: str) -> str:
    """Population z-scores; all 0 for a flat series."""
    return _with_moments(
        readings, f"transform(xs, x -> if(sd < {C.FLAT_STD}D, 0D, (x - mu) / sd))"
    )


def zscores_or_null(readings: str) -> str:
    """Population z-scores; all NULL for a constant series."""
    varied = let("array_max(xs) != array_min(xs)", "varied", "transform(xs, x -> if(varied, (x - mu) / sd, null))")
    return _with_moments(readings, varied)


def max_abs(items: str) -> str:
    return f"array_max(transform({items}, x -> abs(x)))"


def max_abs_zscore(items: str, scale: str) -> str:
    """Largest |z|; NULL when the spread is noise against ``scale``."""
    largest = max_abs("transform(xs, x -> try_divide(x - mu, sd))")
    return _with_moments(items, f"if(sd > {scale} * {NOISE}D, {largest}, null)")


def positive_min(readings: str) -> str:
    return f"coalesce(array_min(filter({readings}, x -> x > 0)), 0D)"


def nonzero_min(readings: str) -> str:
    return f"coalesce(array_min(filter({readings}, x -> x != 0)), 0D)"


def log1p_scale(value: str) -> str:
    return f"log1p({value})"


def count_zero(readings: str) -> str:
    return f"size(filter({readings}, x -> x = 0))"


def centred_trend(readings: str) -> str:
    """2x12 moving average: item j belongs to position j + 6; empty below 13 readings."""

    def body(a: str) -> str:
        ends = f"(get({a}, p - {HALF}) + get({a}, p + {HALF})) / 2"
        inner = total(f"slice({a}, p - {HALF - 2}, {PERIOD - 1})")
        positions = f"sequence({HALF}, size({a}) - {HALF + 1})"
        trend = f"transform({positions}, p -> ({ends} + {inner}) / {PERIOD})"
        return f"if(size({a}) > {PERIOD}, {trend}, CAST(array() AS array<double>))"

    return once(readings, "series", body)


def _line(points: str, at: str) -> str:
    """Values at ``at`` of the least-squares line through points 0, 1, ... of a list."""
    centre = "(size(ys) - 1) / 2"
    moment = total(f"transform(ys, (y, u) -> (u - {centre}) * y)")
    spread = "(size(ys) * (size(ys) * size(ys) - 1) / 12)"
    line = f"named_struct('level', {mean('ys')}, 'slope', {moment} / {spread}, 'centre', {centre})"
    values = f"transform({at}, u -> fit.level + fit.slope * (u - fit.centre))"
    return let(points, "ys", let(line, "fit", values))


def extended_trend(readings: str) -> str:
    """The centred trend with both ends filled from lines fitted near them.

    Each line uses up to 12 trend points. The line at the back leaves out the last trend point.
    """
    fitted = f"least({PERIOD}, size(trend) - 1)"
    front = _line(f"slice(trend, 1, {fitted})", f"sequence(-{HALF}, -1)")
    back = _line(
        f"slice(trend, size(trend) - {fitted}, {fitted})",
        f"sequence({fitted} + 1, {fitted} + {HALF})",
    )
    return let(centred_trend(readings), "trend", f"concat({front}, trend, {back})")


def _remove_season(detrended: str) -> str:
    """Take off each phase's mean, itself centred over the phases."""
    phase = let(f"filter(rest, (x, i) -> i % {PERIOD} = k)", "phase", mean("phase"))
    phases = f"transform(sequence(0, {PERIOD - 1}), k -> {phase})"
    adjusted = f"transform(rest, (x, i) -> x - (get(phases, i % {PERIOD}) - centre))"
    return let(detrended, "rest", let(phases, "phases", let(mean("phases"), "centre", adjusted)))


def seasonal_residual(readings: str, extend: bool = True) -> str:
    """What an additive 12-step decomposition leaves over; without ``extend`` only the middle."""

    def body(a: str) -> str:
        trend = extended_trend(a) if extend else centred_trend(a)
        values = a if extend else f"slice({a}, {HALF + 1}, size({a}) - {PERIOD})"
        return _remove_season(f"zip_with({values}, {trend}, (x, y) -> x - y)")

    return once(readings, "series", body)


def _gated(readings: str, zeros: str, residual: str) -> str:
    long_enough = f"size({readings}) >= {MIN_SEASONAL} AND {count_zero(readings)} {zeros}"
    return f"if({long_enough}, {residual}, {C.NO_RESIDUAL}D)"


def residual_z(readings: str) -> str:
    """Largest |z| of the residual, -99 for a short series or one with more than 3 zeros.

    NULL where the residual is constant but for rounding.
    """
    return once(
        readings,
        "series",
        lambda a: _gated(a, "<= 3", let(max_abs(a), "scale", max_abs_zscore(seasonal_residual(a), "scale"))),
    )


def residual_z_v1(readings: str) -> str:
    """Older variant: trend not extended, fewer than 3 zeros, 0 for a constant residual."""

    def body(a: str) -> str:
        largest = let(max_abs(a), "scale", max_abs_zscore(seasonal_residual(a, extend=False), "scale"))
        return _gated(a, "< 3", f"coalesce({largest}, 0D)")

    return once(readings, "series", body)
