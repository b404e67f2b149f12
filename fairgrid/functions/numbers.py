"""Number columns: tolerant parsing, units, tax and policy arithmetic, judgement (NUM-01 to NUM-10)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LITRES_PER_BARREL = 158.987294928
VAT = 0.10
#: Base fuel taxes in KRW a litre. Fixed values of the policy model.
BASE_TAX = {"gasoline": 745.89, "diesel": 528.75}
JUDGEMENTS = ("expensive", "cheap", "fair")
LABELS = {"page": {"expensive": "비쌈", "cheap": "저렴", "fair": "적정"}, "operations": {"expensive": "비쌈", "cheap": "쌈", "fair": "적정"}}


def parse_number(text: Column) -> Column:
    """NUM-01: commas, quotes and blanks go; what is then no number is null, and so is NaN."""
    x = F.regexp_replace(text, '[, "\\s]', "").try_cast("double")
    return F.when(~F.isnan(x), x)


def krw_per_litre(usd_per_barrel: Column, usdkrw: Column) -> Column:
    return usd_per_barrel * usdkrw / LITRES_PER_BARREL


def pretax(gross: Column, *taxes: Column) -> Column:
    """NUM-03: gross / 1.1 less the taxes; missing taxes count as 0."""
    out = gross / (1 + VAT)
    for t in taxes:
        out = out - F.coalesce(t, F.lit(0.0))
    return out


def policy_shift(base_tax: Column, rate: Column, pass_through: float = 1.0, with_vat: bool = True) -> Column:
    """NUM-04: what a tax cut takes off the price; rates outside 0 to 1 (both excluded) count as none."""
    return F.when((rate > 0) & (rate < 1), base_tax * rate * ((1 + VAT) if with_vat else 1.0) * pass_through).otherwise(0.0)


def position(actual: Column, low: Column, high: Column) -> dict[str, Column]:
    """NUM-06: valid, inside, above and below flags; false where a value is missing."""
    valid = actual.isNotNull() & low.isNotNull() & high.isNotNull()
    flag = lambda c: F.coalesce(valid & c, F.lit(False))
    return {"valid": valid, "inside": flag((actual >= low) & (actual <= high)), "above": flag(actual > high), "below": flag(actual < low)}


def judge(actual: Column, fair: Column, low: Column, high: Column) -> Column:
    """NUM-07: above the band is expensive, below cheap, within fair; without a full band the fair price decides; null without either."""
    return (
        F.when(actual.isNull(), None).when(actual > high, "expensive").when(actual < low, "cheap").when(low.isNotNull() & high.isNotNull(), "fair")
        .when(actual > fair, "expensive").when(actual < fair, "cheap").when(actual == fair, "fair")
    )


def rebuild_level(previous: Column, change: Column, log: bool = True) -> Column:
    """NUM-08: the level after a change in percent; null if either is missing or not finite."""
    finite = lambda c: ~F.isnan(c) & (F.abs(c) != float("inf"))
    return F.when(finite(previous) & finite(change), previous * (F.exp(change / 100) if log else 1 + change / 100))


def clip_low(x: Column, low: float = 0.0) -> Column:
    """A missing value stays missing, unlike with ``greatest``."""
    return F.when(x.isNotNull(), F.greatest(x, F.lit(low)))


def safe_json_number(x: Column) -> Column:
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def half_up(x: Column | str, digits: int) -> Column:
    """Rounded half up after the noise beyond nine digits is gone, so that sums in any order give the same value."""
    x = F.col(x) if isinstance(x, str) else x
    return F.round(x.cast("decimal(38,9)"), digits).cast("double")
