"""Weather-code rules as Column expressions (JVM-side, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# WMO weather code -> condition text (must equal the reference's map).
WMO_CONDITIONS = {
    0: "Clear",
    1: "Mainly Clear",
    2: "Partly Cloudy",
    3: "Overcast",
    45: "Fog",
    48: "Rime Fog",
    51: "Light Drizzle",
    53: "Drizzle",
    55: "Heavy Drizzle",
    56: "Freezing Drizzle",
    57: "Heavy Freezing Drizzle",
    61: "Light Rain",
    63: "Rain",
    65: "Heavy Rain",
    66: "Freezing Rain",
    67: "Heavy Freezing Rain",
    71: "Light Snow",
    73: "Snow",
    75: "Heavy Snow",
    77: "Snow Grains",
    80: "Light Showers",
    81: "Showers",
    82: "Heavy Showers",
    85: "Light Snow Showers",
    86: "Heavy Snow Showers",
    95: "Thunderstorm",
    96: "Thunderstorm with Hail",
    99: "Severe Thunderstorm",
}
# Inclusive code ranges that mean rain / snow.
RAIN_CODE_RANGES = [(51, 67), (80, 82), (95, 99)]
SNOW_CODE_RANGES = [(71, 77), (85, 86)]
RAIN_LIKELY_PROBABILITY = 30  # strict '>'


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def condition_text(code) -> Column:
    """Mapped text; NULL -> 'Unknown'; unmapped -> 'Code <n>'.

    A 28-entry literal map is a constant folded into the projection, so no join is
    needed at all.
    """
    code = _col(code)
    mapping = F.create_map(*[x for k, v in WMO_CONDITIONS.items() for x in (F.lit(k), F.lit(v))])
    return (F.when(code.isNull(), F.lit("Unknown"))
            .otherwise(F.coalesce(F.try_element_at(mapping, code.cast("int")),
                                  F.concat(F.lit("Code "), code.cast("string")))))


def _in_ranges(code: Column, ranges) -> Column:
    cond = None
    for lo, hi in ranges:
        term = code.between(lo, hi)
        cond = term if cond is None else (cond | term)
    return F.coalesce(cond, F.lit(False))


def is_rain_code(code) -> Column:
    """51..67, 80..82, 95..99; NULL -> false."""
    return _in_ranges(_col(code), RAIN_CODE_RANGES)


def is_snow_code(code) -> Column:
    """71..77, 85..86; NULL -> false."""
    return _in_ranges(_col(code), SNOW_CODE_RANGES)


def had_rain(rain_sum, code) -> Column:
    """rain_sum > 0 (NULL counts as 0) OR rain code."""
    return (F.coalesce(_col(rain_sum), F.lit(0)) > 0) | is_rain_code(code)


def had_snow(snow_sum, code) -> Column:
    return (F.coalesce(_col(snow_sum), F.lit(0)) > 0) | is_snow_code(code)


def rain_likely(code, probability) -> Column:
    """Rain code OR probability > 30 (strict); NULL probability -> false."""
    return is_rain_code(code) | F.coalesce(_col(probability) > RAIN_LIKELY_PROBABILITY, F.lit(False))


def snow_likely(code) -> Column:
    return is_snow_code(code)


def pct_to_int(x) -> Column:
    """Round half to even (Python ``round``), then int; NULL stays NULL."""
    return F.bround(_col(x), 0).cast("bigint")
