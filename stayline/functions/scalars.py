"""Column functions. Each takes and returns Columns, so it stays inside codegen."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- numbers ---------------------------------------------------------------


def cents(amount: Column | str) -> Column:
    """Money as whole cents: sums are exact and do not depend on row order."""
    return F.rint(col(amount) * 100).cast("long")


def money(total_cents: Column | str) -> Column:
    return col(total_cents) / F.lit(100.0)


def exact(amount: Column | str, digits: int) -> Column:
    """Fixed-point whole number of any size, for exact sums over summed-up rows."""
    return F.rint(col(amount) * float(10**digits)).cast("decimal(28,0)")


def inexact(total: Column | str, digits: int) -> Column:
    """Double value of a fixed-point total."""
    return col(total).cast("double") / F.lit(float(10**digits))


def line_total(amount: Column | str, digits: int) -> Column:
    """Exact sum over single lines. Two sums of long halves stay in fast arithmetic
    and cannot overflow for one key with a large share of all lines."""
    units = F.rint(col(amount) * float(10**digits)).cast("long")
    high = F.sum(F.shiftright(units, 20)).cast("decimal(20,0)")
    low = F.sum(units.bitwiseAND(F.lit((1 << 20) - 1))).cast("decimal(20,0)")
    return inexact(high * F.lit(1 << 20) + low, digits)


def total(amount: Column | str) -> Column:
    """Order-independent sum of a money column of summed-up rows, to six digits."""
    return inexact(F.sum(exact(amount, 6)), 6)


def mean(amount: Column | str) -> Column:
    """Average from the order-independent sum."""
    return F.try_divide(total(amount), F.count(col(amount)))


def round_even(c: Column | str, digits: int) -> Column:
    """Round half to even on the scaled value."""
    scale = float(10**digits)
    return F.rint(col(c).cast("double") * scale) / scale


def clip(c: Column | str, low: float, high: float) -> Column:
    """Clamp to [low, high]; null stays null."""
    c = col(c)
    return F.when(c < low, F.lit(low)).when(c > high, F.lit(high)).otherwise(c)


def safe_ratio(top: Column | str, bottom: Column | str, otherwise: float = 0.0) -> Column:
    """top / bottom where bottom is positive, else the fallback."""
    top, bottom = col(top).cast("double"), col(bottom).cast("double")
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(float(otherwise)))


def trend(recent: Column | str, previous: Column | str) -> Column:
    """Relative change, 1 for growth from nothing, clamped to [-1, 5]."""
    recent, previous = col(recent).cast("double"), col(previous).cast("double")
    change = (
        F.when(previous > 0, (recent - previous) / previous)
        .when(recent > 0, F.lit(1.0))
        .otherwise(F.lit(0.0))
    )
    return clip(change, -1.0, 5.0)


def finite_or_zero(c: Column | str) -> Column:
    """Null, NaN and infinities become 0."""
    c = col(c).cast("double")
    bad = c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    return F.when(bad, F.lit(0.0)).otherwise(c)


def nan_to_null(c: Column | str) -> Column:
    c = col(c)
    return F.when(~F.isnan(c), c)


def scale_to_unit(c: Column | str, low: Column, high: Column) -> Column:
    """(c - low) / (high - low); a constant column becomes 0.5."""
    c = col(c)
    return F.when(high == low, F.lit(0.5)).otherwise((c - low) / (high - low))


def equal_width_bin(c: Column | str, low: Column, high: Column, bins: int) -> Column:
    """Right-closed bins 1..bins of equal width; a constant column falls in the middle."""
    width = (high - low) / bins
    raw = F.ceil(F.try_divide(col(c) - low, width))
    return F.when(high == low, F.lit((bins + 1) // 2)).otherwise(
        F.greatest(F.lit(1), F.least(F.lit(bins), raw)).cast("int")
    )


# -- lookups and text ------------------------------------------------------


def lookup(c: Column | str, mapping: dict, default=None) -> Column:
    """Value of a small dictionary, default where the key is absent or null."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    found = F.try_element_at(table, col(c))
    return found if default is None else F.coalesce(found, F.lit(default))


def normalise_category(c: Column | str) -> Column:
    return F.lower(F.trim(col(c)))


def first_contained(c: Column | str, rates: dict, default: float) -> Column:
    """Value of the first key that occurs inside the text."""
    text, out = F.lower(col(c)), F.lit(None)
    for key, value in reversed(list(rates.items())):
        out = F.when(text.contains(key), F.lit(value)).otherwise(out)
    return F.coalesce(out, F.lit(default))


def prefixed(prefix: str, c: Column | str) -> Column:
    return F.concat(F.lit(prefix), col(c).cast("string"))


def to_day(c: Column | str) -> Column:
    """Date of a date, timestamp or text; unparsable text becomes null."""
    return F.try_to_timestamp(col(c).cast("string")).cast("date")


def year_month(c: Column | str) -> Column:
    return F.date_format(col(c), "yyyy-MM")


def format_money(c: Column | str, symbol: str = "R$") -> Column:
    """Short money text: millions, thousands or plain."""
    c = col(c)
    return (
        F.when(c >= 1_000_000, F.concat(F.lit(f"{symbol} "), F.format_number(c / 1_000_000, 1), F.lit("M")))
        .when(c >= 1_000, F.concat(F.lit(f"{symbol} "), F.format_number(c / 1_000, 1), F.lit("K")))
        .otherwise(F.concat(F.lit(f"{symbol} "), F.format_number(c, 0)))
    )


def format_percent(c: Column | str, digits: int = 1) -> Column:
    return F.concat(F.format_number(col(c) * 100, digits), F.lit("%"))


# -- business rules --------------------------------------------------------


def rfm_segment(r: Column | str, f: Column | str, m: Column | str) -> Column:
    """Segment of three 1-5 scores; the first rule that holds wins."""
    r, f, m = col(r), col(f), col(m)

    def both(low: int) -> Column:
        return (f >= low) & (m >= low)

    return (
        F.when((r >= 4) & both(4), "Champions")
        .when((r >= 3) & both(3), "Loyal Customers")
        .when((r >= 4) & (f <= 3) & (m <= 3), "Potential Loyalists")
        .when((r <= 2) & both(4), "High Value At Risk")
        .when((r <= 2) & both(3), "At Risk")
        .when((r == 1) & (f <= 2) & (m <= 2), "Dormant")
        .otherwise("Needs Attention")
    )


def rfm_quadrant(recency: Column | str, frequency: Column | str) -> Column:
    recency, frequency = col(recency), col(frequency)
    return (
        F.when((recency <= 30) & (frequency >= 10), "Stars")
        .when(recency <= 30, "Potential")
        .when((recency > 90) & (frequency >= 5), "At Risk")
        .otherwise("Dormant")
    )


def risk_tier(prob: Column | str) -> Column:
    """Right-closed tiers of a probability; null outside [0, 1]."""
    p = col(prob)
    return (
        F.when((p < 0) | (p > 1), F.lit(None))
        .when(p <= 0.3, "Low Risk")
        .when(p <= 0.6, "Medium Risk")
        .when(p <= 1.0, "High Risk")
    )


def recommended_action(tier: Column | str, prob: Column | str, net_benefit: Column | str) -> Column:
    """Action text of value tier, churn probability and expected net benefit."""
    tier, p, gain = col(tier), col(prob), col(net_benefit)
    high, medium, low = (tier == t for t in ("High Value", "Medium Value", "Low Value"))
    return (
        F.when((gain <= 0) & low, "Let Go — Negative ROI")
        .when(gain <= 0, "Monitor — Marginal ROI")
        .when(high & (p >= 0.6), "Immediate Retention — Personal Outreach")
        .when(high & (p >= 0.3), "Proactive Retention — Premium Offer")
        .when(high, "Maintain — Loyalty Rewards")
        .when(medium & (p >= 0.5), "Targeted Campaign — Email + Discount")
        .when(medium, "Nurture — Cross-sell Campaign")
        .when(low & (p >= 0.5), "Low-Cost — Automated Email Sequence")
        .otherwise("Standard — No Specific Action")
    )


def predicted_flag(prob: Column | str, threshold: float = 0.5) -> Column:
    return (col(prob) >= threshold).cast("int")


def churn_band(prob: Column | str) -> Column:
    p = col(prob)
    return F.when(p >= 0.7, "red").when(p >= 0.5, "orange").otherwise("green")


def risk_band(prob: Column | str) -> Column:
    p = col(prob)
    return F.when(p < 0.3, "green").when(p < 0.6, "amber").otherwise("red")


def margin_band(margin: Column | str) -> Column:
    m = col(margin)
    return F.when(m < 0, "red").when(m <= 0.15, "amber").otherwise("green")


def score_band(score: Column | str) -> Column:
    s = col(score)
    return F.when(s < 33, "gray").when(s < 66, "amber").otherwise("red")


def rank_icon(rank: Column | str) -> Column:
    r = col(rank)
    return F.when(r <= 20, "red").when(r <= 50, "yellow").otherwise("green")
