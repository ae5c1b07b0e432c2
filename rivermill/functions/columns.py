"""Column expressions: geography, calendar, encodings, polynomials, text keys."""

from __future__ import annotations

import math
import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Physics and calibration constants of the flow model.
EARTH_RADIUS_KM = 6371.0
KELVIN = 273.15
LAPSE_RATE = 0.0065
SOLAR_CONSTANT = 0.0820
LATENT_HEAT = 2.45
K_EXT_SLOPE = 0.0118
K_EXT_INTERCEPT = 0.21
GRAVITY = 9.81
EPS = 1e-6

# Season name by calendar month.
SEASONS = {
    "winter": (12, 1, 2),
    "spring": (3, 4, 5),
    "summer": (6, 7, 8),
    "autumn": (9, 10, 11),
}
SEASON_CODES = {"DJF": "winter", "MAM": "spring", "JJA": "summer", "SON": "autumn"}

# Letters replaced in metric keys.
SLUG_FROM = "àâäéèêëîïôöùûüç "
SLUG_TO = "aaaeeeeiioouuuc_"


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    p1, p2 = F.radians(lat1), F.radians(lat2)
    a = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(a))


def season(ts: Column) -> Column:
    month = F.month(ts)
    out = F.when(month.isin(*SEASONS["winter"]), "winter")
    for name in ("spring", "summer", "autumn"):
        out = out.when(month.isin(*SEASONS[name]), name)
    return out


def season_of_code(code: Column) -> Column:
    names = iter(SEASON_CODES.items())
    short, name = next(names)
    out = F.when(code == short, name)
    for short, name in names:
        out = out.when(code == short, name)
    return out


def cyclic(value: Column, period: float) -> tuple[Column, Column]:
    """(sin, cos) of a calendar value on a circle."""
    angle = F.lit(2 * math.pi) * value / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def floor_zero(x: Column) -> Column:
    """max(x, 0) that keeps NULL."""
    return F.when(x < 0, F.lit(0.0)).otherwise(x)


def cap(x: Column, top: Column) -> Column:
    """min(x, top); a NULL top does not cap, a NULL x stays NULL."""
    return F.when(x > top, top).otherwise(x)


def bound(x: Column, lo: float, hi: float) -> Column:
    return F.when(x < lo, F.lit(lo)).when(x > hi, F.lit(hi)).otherwise(x)


def to_log(q: Column) -> Column:
    return F.log1p(q)


def from_log(y: Column) -> Column:
    """Back to m3/s, never negative."""
    return floor_zero(F.expm1(y))


def basin_temperature(temp_k: Column, alt_basin: Column, alt_point: Column) -> Column:
    """Temperature at the mean altitude of the watershed, in degrees Celsius."""
    return temp_k - KELVIN - (alt_basin - alt_point) * LAPSE_RATE


def et0(lat: Column, ts: Column, mean_temp_k: Column, kc: Column) -> Column:
    """Hourly reference evapotranspiration from latitude, day of year and the reference-year mean temperature."""
    phi, j = F.radians(lat), F.dayofyear(ts).cast("double")
    turn = F.lit(2 * math.pi) * j / 365
    dr = 1 + 0.033 * F.cos(turn)
    decl = 0.409 * F.sin(turn - 1.39)
    sunset = F.acos(-F.tan(phi) * F.tan(decl))
    daily = (
        F.lit(24 * 60 / math.pi * SOLAR_CONSTANT)
        * dr
        * (sunset * F.sin(phi) * F.sin(decl) + F.cos(phi) * F.cos(decl) * F.sin(sunset))
    )
    k_ext = K_EXT_SLOPE * (mean_temp_k - KELVIN) + K_EXT_INTERCEPT
    return kc * k_ext * (daily / 24 / LATENT_HEAT)


def polynomial(coeffs: Column, x: Column) -> Column:
    """Coefficients from degree 0 upward."""
    return F.aggregate(F.reverse(coeffs), F.lit(0.0), lambda acc, c: acc * x + c)


def distance_windows(km: Column) -> Column:
    """Accumulation windows in hours for a weather point at this distance from the outlet."""

    def hours(*values: int) -> Column:
        return F.array(*[F.lit(v) for v in values])

    # Window lists by distance class.
    return (
        F.when(km <= 50, hours(1, 3, 6, 12, 24, 36, 48, 72))
        .when(km <= 100, hours(6, 12, 24, 36, 48, 72))
        .when(km <= 1000, hours(12, 24, 36, 48, 72, 168))
        .otherwise(hours(24, 36, 48, 72, 168))
    )


def paris_time(ts: Column) -> Column:
    """UTC instant as Paris wall clock, for display only."""
    return F.from_utc_timestamp(ts, "Europe/Paris")


def parse_utc(text: Column) -> Column:
    """`2024-01-31T05:00:00Z` or `31/01/2024`."""
    return F.coalesce(
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ssX")), F.try_to_timestamp(text, F.lit("dd/MM/yyyy"))
    )


@lru_cache(maxsize=1)
def _plain_letters() -> tuple[dict[str, str], dict[str, str]]:
    """Every character with a plain ASCII form under compatibility decomposition: one letter, or several."""
    single, several = {}, {}
    for code in range(0x80, sys.maxunicode + 1):
        ch = chr(code)
        plain = unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode().lower()
        if plain:
            (single if len(plain) == 1 else several)[ch] = plain
    return single, several


def fold_text(text: Column) -> Column:
    """Lower case without accents; what has no plain letter is dropped."""
    single, several = _plain_letters()
    low = F.lower(text)
    # One literal holds the table of characters with several letters; only texts that have such a one are taken apart.
    table = F.str_to_map(F.lit("\x01".join(f"{c}\x02{p}" for c, p in several.items())), F.lit("\x01"), F.lit("\x02"))
    apart = F.transform(F.split(low, ""), lambda c: F.coalesce(F.try_element_at(table, c), c))
    wide = F.length(F.translate(low, "".join(several), "")) < F.length(low)
    folded = F.translate(F.when(wide, F.array_join(apart, "")).otherwise(low), "".join(single), "".join(single.values()))
    return F.when(low.rlike(r"[^\x00-\x7F]"), F.regexp_replace(folded, r"[^\x00-\x7F]", "")).otherwise(low)


def slug(text: Column) -> Column:
    """Metric key of a label: known accents folded, spaces as underscores, letters and digits kept."""
    plain = F.translate(F.lower(text), SLUG_FROM, SLUG_TO)
    return F.regexp_replace(plain, r"[^\p{L}\p{N}_]", "")


def null_safe(x: Column, digits: int = 4) -> Column:
    """NaN as NULL, rounded."""
    return F.when(~F.isnan(x), F.round(x, digits))

