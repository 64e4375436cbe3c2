"""Deterministic pseudo-random columns: the draw depends only on seed, purpose and id."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from stayline.functions.scalars import clip, col


def uniform(seed: int, purpose: str, *ids: Column | str) -> Column:
    """Number in [0, 1) from the first 52 bits of an md5 digest."""
    parts = [F.lit(f"{seed}:{purpose}")] + [col(i).cast("string") for i in ids]
    digits = F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(2**52))


def normal(seed: int, purpose: str, *ids: Column | str) -> Column:
    """Standard normal draw from two uniform draws (Box-Muller)."""
    u1 = F.lit(1.0) - uniform(seed, purpose + "/r", *ids)
    u2 = uniform(seed, purpose + "/a", *ids)
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2 * math.pi) * u2)


def choice(u: Column, shares: dict) -> Column:
    """Key whose cumulative share first exceeds the uniform draw."""
    keys, total, out = list(shares), 0.0, None
    for key in keys[:-1]:
        total = round(total + shares[key], 10)
        out = F.when(u < total, key) if out is None else out.when(u < total, key)
    return F.lit(keys[-1]) if out is None else out.otherwise(keys[-1])


def poisson(u: Column, rate: float) -> Column:
    """Inverse-CDF Poisson draw; the steps cover all but 1e-12 of the mass."""
    steps, term, total, k = [], math.exp(-rate), math.exp(-rate), 0
    while total < 1 - 1e-12:
        steps.append(total)
        k += 1
        term *= rate / k
        total += term
    out = F.when(u < steps[0], 0)
    for i, step in enumerate(steps[1:], start=1):
        out = out.when(u < step, i)
    return out.otherwise(len(steps))


def poisson_small(u: Column, rate: Column, most: int) -> Column:
    """Poisson draw with a per-row rate, cut at `most`: counts the CDF steps below u."""
    term = F.exp(-rate)
    cdf, drawn = term, (u >= term).cast("int")
    for k in range(1, most):
        term = term * rate / k
        cdf = cdf + term
        drawn = drawn + (u >= cdf).cast("int")
    return drawn


def age(seed: int, customer_id: Column | str) -> Column:
    """Whole years from N(35, 10), truncated, clamped to 18..70."""
    years = (F.lit(35.0) + F.lit(10.0) * normal(seed, "age", customer_id)).cast("int")
    return clip(years, 18, 70).cast("int")


def gender(seed: int, customer_id: Column | str, shares: dict) -> Column:
    return choice(uniform(seed, "gender", customer_id), shares)


def channel(seed: int, customer_id: Column | str, channels: dict) -> Column:
    shares = {name: share for name, (share, _) in channels.items()}
    return choice(uniform(seed, "channel", customer_id), shares)


def is_return(seed: int, rate: Column, *line_key: Column | str) -> Column:
    """1 with the probability of the line's category, else 0."""
    return (uniform(seed, "return", *line_key) < rate).cast("int")


# Counter -> (clicks per recent order, Poisson mean, highest value).
PROXY_COUNTERS = {
    "emails_opened_30d": (2.0, 3.0, 25),
    "website_visits_30d": (5.0, 10.0, 60),
    "campaign_clicks_30d": (1.5, 2.0, 20),
    "app_sessions_30d": (3.0, 8.0, 50),
}


def proxy_counter(seed: int, name: str, customer_id: Column | str, orders: Column) -> Column:
    per_order, mean, most = PROXY_COUNTERS[name]
    value = orders * per_order + poisson(uniform(seed, name, customer_id), mean)
    return clip(value, 0, most).cast("int")


def support_tickets(seed: int, customer_id: Column | str, orders: Column) -> Column:
    u = uniform(seed, "tickets", customer_id)
    return poisson_small(u, orders.cast("double") * 0.1, 8).cast("int")


def loyalty(seed: int, customer_id: Column | str, orders: Column) -> Column:
    p = clip(orders.cast("double") / 10, 0.0, 0.8)
    return (uniform(seed, "loyalty", customer_id) < p).cast("int")
