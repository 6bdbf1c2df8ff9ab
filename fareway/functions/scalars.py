"""Small column helpers: ratios, buckets, labels, JSON and text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from . import fixed_values as V


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def in_codes(c, codes) -> Column:
    return col(c).isin(*codes)


def status_flag(c, codes) -> Column:
    """1 where the code is in the set, else 0 (also for NULL)."""
    return F.when(in_codes(c, codes), 1).otherwise(0)


def decode(c, mapping: dict) -> Column:
    """Value of a small fixed mapping, NULL for other keys."""
    out = None
    for key, value in mapping.items():
        hit = col(c) == F.lit(key)
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out


def vehicle_class(category) -> Column:
    """Taxi for the taxi categories; anything else, NULL too, is Limo."""
    return F.when(in_codes(category, V.TAXI_CATEGORIES), "Taxi").otherwise("Limo")


def accepted_at(df_class: Column, accepted="accepted_ride_timestamp", on_route="on_route_timestamp") -> Column:
    """Limo trips count from acceptance, taxi trips from setting off."""
    return F.when(df_class == "Limo", col(accepted)).when(df_class == "Taxi", col(on_route))


def bucketize(c, bounds, labels, strict: bool = False) -> Column:
    """Label of the first bound that the value does not exceed; the last label is the remainder.

    A NULL value falls to the remainder, as a chain of comparisons does.
    """
    out = None
    for bound, label in zip(bounds, labels):
        hit = col(c) < bound if strict else col(c) <= bound
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(labels[len(bounds)]) if len(labels) > len(bounds) else out


def slot_label(weekday, hour, rules, other) -> Column:
    """First rule whose days and hours both match."""
    out = None
    for on_days, hours, label in rules:
        hit = col(hour).isin(*hours)
        if on_days is not None:
            hit = col(weekday).isin(*on_days) & hit
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(F.lit(other))


def shift_label(weekday, hour, rules=V.SHIFT_RULES, other=V.SHIFT_OTHER) -> Column:
    return slot_label(weekday, hour, rules, other)


def peak_label(weekday, hour) -> Column:
    return slot_label(weekday, hour, V.PEAK_RULES, V.PEAK_OTHER)


def trip_revenue(status, vehicle, weekday, hour, fees) -> Column:
    """Own revenue of a completed trip; NULL when it was not completed."""
    taxi = slot_label(weekday, hour, V.TAXI_REVENUE_RULES, V.TAXI_REVENUE_OTHER)
    limo = F.lit(V.LIMO_REVENUE_SHARE) * reduce(lambda a, b: a + b, [col(f) for f in fees])
    done = in_codes(status, V.COMPLETED)
    return F.when(done & (vehicle == "Taxi"), taxi).when(done & (vehicle == "Limo"), limo)


def place_type(zone_name, address) -> Column:
    """Place type by keywords in the zone name or the address, in order of priority."""
    name, addr = (F.lower(F.trim(col(c))) for c in (zone_name, address))
    out = None
    for label, in_name, in_address in V.PLACE_KEYWORDS:
        tests = [name.contains(w) for w in in_name] + [addr.contains(w) for w in in_address]
        hit = reduce(lambda a, b: a | b, tests)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(V.PLACE_OTHER)


def journey_type(pickup_type, drop_type) -> Column:
    out = None
    for place, label in V.JOURNEY_TYPES:
        hit = (col(pickup_type) == place) | (col(drop_type) == place)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(V.JOURNEY_TYPE_OTHER)


def no_bad_badges(badges, bad=V.BAD_BADGES) -> Column:
    """True without badges, or when none of the bad ones is named."""
    named = reduce(lambda a, b: a | b, [F.lower(col(badges)).contains(b.lower()) for b in bad])
    return col(badges).isNull() | ~named


def safe_ratio(num, den, scale: float = 1.0) -> Column:
    """`scale * num / den` as double, NULL for a zero or missing denominator."""
    num, den = col(num).cast("double"), col(den).cast("double")
    return F.when(den != 0, num * F.lit(float(scale)) / den)


def ratio_segment(num, den, rules, other) -> Column:
    """First `(test, label)` whose test accepts the safe ratio."""
    ratio = safe_ratio(num, den)
    out = None
    for test, label in rules:
        out = F.when(test(ratio), label) if out is None else out.when(test(ratio), label)
    return out.otherwise(other)


def count_segment(c, rules, other) -> Column:
    """First `(low, high, label)` with low <= value <= high; `None` leaves an end open."""
    out = None
    for low, high, label in rules:
        hit = F.lit(True)
        if low is not None:
            hit = hit & (col(c) >= low)
        if high is not None:
            hit = hit & (col(c) <= high)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(other)


def change_label(pickup_m, drop_m, limit_m: float = 150.0) -> Column:
    moved_up, moved_drop = col(pickup_m) > limit_m, col(drop_m) > limit_m
    return (
        F.when(moved_up & moved_drop, "Both Changed")
        .when(moved_up, "Pickup Changed")
        .when(moved_drop, "Drop Changed")
        .otherwise("No Change")
    )


def priority_label(dispatch_rank, eta_rank, best="ETA_rank_1", other="Others") -> Column:
    first = col(dispatch_rank) == 1
    return (
        F.when(first & (col(eta_rank) == 1), best)
        .when(first & (col(eta_rank) > 1), "Driver_Score_priortised")
        .otherwise(other)
    )


def outlier_label(dispatch_rank, eta_rank) -> Column:
    """As `priority_label`, with a label for the ETA-best driver the blend ranked lower, else NULL."""
    return (
        F.when((col(dispatch_rank) == 1) & (col(eta_rank) == 1), "ETA_rank")
        .when((col(dispatch_rank) == 1) & (col(eta_rank) > 1), "Driver_Score_priortised")
        .when((col(eta_rank) == 1) & (col(dispatch_rank) > 1), "ETA_priortised")
    )


def digits(c) -> Column:
    """Number left after dropping everything but digits and dots; NULL if there is none."""
    return F.regexp_replace(col(c), "[^0-9.]", "").try_cast("double")


def json_text(c, *path) -> Column:
    """Text at a JSON path of keys and array positions."""
    steps = "".join(f"[{p}]" if isinstance(p, int) else f".{p}" for p in path)
    return F.get_json_object(col(c), "$" + steps)


def logistic(x, midpoint: float, slope: float, clamp: bool = True) -> Column:
    x = col(x)
    if clamp:
        x = F.greatest(F.least(x, F.lit(0.999999)), F.lit(0.000001))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-slope) * (x - F.lit(midpoint))))


def min_max(x, low, high) -> Column:
    """(x - low) / (high - low), NULL when all values are equal."""
    spread = col(high) - col(low)
    return F.when(spread != 0, (col(x) - col(low)) / spread)


def composite_id(*parts, sep: str = "-") -> Column:
    """Parts joined with a separator; NULL as soon as one part is NULL."""
    texts = [col(p).cast("string") for p in parts]
    spaced = [x for t in texts for x in (F.lit(sep), t)][1:]
    return F.concat(*spaced)
