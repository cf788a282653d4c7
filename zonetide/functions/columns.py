"""Column -> Column helpers. All of them are native expressions, so they stay inside code generation."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonetide.functions import fixed_values as V


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def num(value: float) -> Column:
    """A double literal: bare literals such as 1.2 would turn the result into a decimal."""
    return F.lit(float(value)).cast("double")


def interval(text: str) -> Column:
    """An interval literal such as `30 days`."""
    if not re.fullmatch(r"\s*\d+\s+(microsecond|second|minute|hour|day|week)s?\s*", text, re.IGNORECASE):
        raise ValueError(f"not an interval: {text!r}")
    return F.expr(f"INTERVAL {text}")


def moment(value) -> Column:
    """A timestamp literal from text or datetime; a column stays as it is."""
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


# --- time -----------------------------------------------------------------------------------------------------------

def date_parts(ts: Column | str) -> dict[str, Column]:
    """Calendar parts of a timestamp; weekday 1 is Sunday."""
    c = col(ts)
    return {
        "date": F.to_date(c),
        "hour": F.hour(c),
        "year": F.year(c),
        "month": F.month(c),
        "day": F.dayofmonth(c),
        "day_of_week": F.dayofweek(c),
    }


def hour_of(ts: Column | str) -> Column:
    return F.date_trunc("hour", col(ts))


def epoch_hour(ts: Column | str) -> Column:
    return F.floor(F.unix_timestamp(col(ts)) / 3600)


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Minutes from start to end, whole seconds only."""
    return (F.unix_timestamp(col(end)) - F.unix_timestamp(col(start))) / 60


def is_weekend(ts: Column | str) -> Column:
    return F.dayofweek(col(ts)).isin(1, 7)


def is_rush(ts: Column | str) -> Column:
    return is_morning_rush(ts) | is_evening_rush(ts)


def is_morning_rush(ts: Column | str) -> Column:
    return F.hour(col(ts)).between(*V.MORNING_RUSH)


def is_evening_rush(ts: Column | str) -> Column:
    return F.hour(col(ts)).between(*V.EVENING_RUSH)


def time_category(ts: Column | str) -> Column:
    return (
        F.when(is_weekend(ts), "Weekend")
        .when(is_morning_rush(ts), "Rush Hour")
        .when(is_evening_rush(ts), "Evening Rush")
        .otherwise("Regular")
    )


def shift(ts: Column | str, text: str, back: bool = False) -> Column:
    step = interval(text)
    return col(ts) - step if back else col(ts) + step


def parse_ts(text: Column | str) -> Column:
    """ISO-8601 text to timestamp; null where it does not parse."""
    return col(text).try_cast("timestamp")


def hour_label(hour: Column | str) -> Column:
    return F.concat(col(hour).cast("string"), F.lit(":00"))


# --- numbers --------------------------------------------------------------------------------------------------------

def rnd(c: Column | str, digits: int) -> Column:
    """Round half up after dropping float noise.

    A mean summed in another order differs in the last bits, which flips plain rounding at a half; nine digits first
    makes the result the same on every run.
    """
    return F.round(F.round(col(c).cast("double"), 9), digits)


def tip_pct(tip: Column | str, fare: Column | str) -> Column:
    return F.when(col(fare) > 0, col(tip) / col(fare) * 100).otherwise(num(0))


def peak_factor(n: Column | str, mean: Column | str) -> Column:
    return F.when(col(mean) > 0, col(n) / col(mean)).otherwise(num(1))


def share_pct(part: Column | str, whole: Column | str) -> Column:
    """Part of whole in percent, null for an empty whole."""
    return col(part).cast("double") / F.nullif(col(whole), F.lit(0)) * 100


def capped(c: Column | str, cap: float) -> Column:
    return F.least(col(c).cast("double"), num(cap))


def first_of(*cs: Column | str) -> Column:
    return F.coalesce(*[col(c) for c in cs])


def total(*parts: Column | str) -> Column:
    """Sum of components, a null one counting as 0."""
    out = F.coalesce(col(parts[0]), num(0))
    for part in parts[1:]:
        out = out + F.coalesce(col(part), num(0))
    return out


def to_fahrenheit(celsius: Column | str) -> Column:
    return rnd(col(celsius) * 9 / 5 + 32, 2)


def planar_distance(lat1, lon1, lat2, lon2, per_degree: float = V.KM_PER_DEGREE) -> Column:
    """Flat distance in degrees times a length per degree; not great-circle."""
    return F.sqrt(F.pow(col(lat1) - col(lat2), 2) + F.pow(col(lon1) - col(lon2), 2)) * num(per_degree)


# --- labels ---------------------------------------------------------------------------------------------------------

def lookup(label: Column | str, table: Mapping[str, float], default: float | Column) -> Column:
    """Label -> value by an equality chain; null and unlisted labels get the default."""
    chain = None
    for key, value in table.items():
        hit = col(label) == key
        chain = F.when(hit, num(value)) if chain is None else chain.when(hit, num(value))
    return chain.otherwise(default if isinstance(default, Column) else num(default))


def condition_code(condition, default: float, codes: Mapping[str, float] = V.CONDITION_CODES) -> Column:
    return lookup(condition, codes, default)


def zone_type_code(zone_type, codes: Mapping[str, float] = V.ZONE_TYPE_CODES) -> Column:
    return lookup(zone_type, codes, V.ZONE_TYPE_OTHER)


def borough_code(borough, codes: Mapping[str, float] = V.BOROUGH_CODES) -> Column:
    return lookup(borough, codes, 0)


def zone_weather_score(condition) -> Column:
    return lookup(condition, V.ZONE_SCORE, 1)


def demand_weather_factor(condition, temperature) -> Column:
    """Condition first, then temperature."""
    by_temperature = (
        F.when(col(temperature) < V.COLD_BELOW, num(V.COLD_FACTOR))
        .when(col(temperature) > V.HOT_ABOVE, num(V.HOT_FACTOR))
        .otherwise(num(1))
    )
    return lookup(condition, V.DEMAND_FACTOR, by_temperature)


def impact_score(condition, trips) -> Column:
    """Daily weather impact: capped where a multiplier applies, else the plain count."""
    n = col(trips).cast("double")
    listed = col(condition).isin(*V.IMPACT_MULTIPLIER)
    return F.when(listed, capped(n * lookup(condition, V.IMPACT_MULTIPLIER, 1), V.IMPACT_CAP)).otherwise(n)


def surge_factor(n, mean) -> Column:
    return (
        F.when(col(n) > col(mean) * V.SURGE_HIGH_OVER, num(V.SURGE_HIGH))
        .when(col(n) < col(mean) * V.SURGE_LOW_UNDER, num(V.SURGE_LOW))
        .otherwise(num(1))
    )


def bad_weather(condition) -> Column:
    return F.coalesce(col(condition).isin(*V.BAD_WEATHER), F.lit(False))


def flag(c: Column | str) -> Column:
    """Boolean to 0/1, null counting as 0."""
    return F.coalesce(col(c).cast("int"), F.lit(0))


def flag_double(c: Column | str) -> Column:
    return flag(c).cast("double")


def is_airport(*zone_types) -> Column:
    hit = F.lit(False)
    for zone_type in zone_types:
        hit = hit | F.coalesce(col(zone_type) == V.AIRPORT, F.lit(False))
    return hit


def is_cross(borough_a, borough_b) -> Column:
    return F.coalesce(col(borough_a) != col(borough_b), F.lit(False))


def trip_label(vendor, ts) -> Column:
    """Vendor and pickup second; a label, not a key."""
    return F.concat_ws("_", col(vendor).cast("string"), F.unix_timestamp(col(ts)).cast("string"))


def zone_attrs(zone, tourist: Iterable[str] = V.TOURIST_ZONES, business: Iterable[str] = V.BUSINESS_ZONES):
    """Zone type and area flags from the zone's name."""
    return {
        "zone_type": F.when(F.contains(F.lower(col(zone)), F.lit(V.AIRPORT)), V.AIRPORT).otherwise("neighborhood"),
        "is_tourist_area": col(zone).isin(*tourist),
        "is_business_district": col(zone).isin(*business),
    }


def route_topic(topic, routes=V.TOPIC_ROUTES) -> Column:
    """Rewrite a topic name; each step applies only where the whole name matches."""
    out = col(topic)
    for pattern, replacement in routes:
        out = F.regexp_replace(out, f"^{pattern}$", replacement)
    return out


# --- scores ---------------------------------------------------------------------------------------------------------

def stream_activity_score(trips, revenue, vendors) -> Column:
    """0.4 per trip, 0.4 per hundred of revenue, 0.2 per vendor."""
    return col(trips) * num(0.4) + col(revenue) / 100 * num(0.4) + col(vendors) * num(0.2)


def serving_activity_score(pickups, revenue) -> Column:
    """Ten per pickup plus a tenth of revenue, at most 100."""
    return capped(col(pickups) * 10 + col(revenue) / 10, 100)


def distance_per_hour(distance, minutes) -> Column:
    return F.when(col(minutes) > 0, col(distance) / (col(minutes) / 60)).otherwise(num(0))
