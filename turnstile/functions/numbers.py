"""Number parsing, fees, guarded ratios and number formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnstile.constants import ACQUIRING_FEE_RATE, DOWN_MARK, NO_CHANGE, SERVICE_FEE_RATE, UP_MARK


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def locale_number(c: Column | str) -> Column:
    """Text in one of several number formats to a double, null when unreadable.

    Spaces go.  With both marks the comma groups thousands.  A lone comma kind
    is decimal only when the last one has two characters behind it.
    """
    bare = F.translate(F.regexp_replace(_col(c), r"^\s+|\s+$", ""), "  ", "")
    last_comma_from_end = F.instr(F.reverse(bare), ",")
    cleaned = F.when(bare.contains("."), F.translate(bare, ",", "")).otherwise(
        F.when(last_comma_from_end == 3, F.translate(bare, ",", ".")).otherwise(
            F.translate(bare, ",", "")
        )
    )
    plain = cleaned.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")
    return F.when(plain, cleaned).try_cast("double")


def unreadable(text: Column | str, kind) -> Column:
    """There is a text, but it is no value of the type."""
    text = _col(text)
    return text.isNotNull() & text.try_cast(kind).isNull()


def fraction(numerator: Column | str, divisor: Column | str) -> Column:
    """Quotient as a double; null when the divisor is zero or null."""
    d = _col(divisor).cast("double")
    return _col(numerator).cast("double") / F.nullif(d, F.lit(0.0))


def zero_safe_fraction(numerator: Column | str, divisor: Column | str) -> Column:
    """Quotient as a double; 0 when it cannot be formed."""
    return F.coalesce(fraction(numerator, divisor), F.lit(0.0))


def zero_guarded_fraction(numerator: Column | str, divisor: Column | str) -> Column:
    """Quotient as a double; 0 on a zero divisor, null on a missing operand."""
    d = _col(divisor).cast("double")
    return F.when(d == 0, F.lit(0.0)).otherwise(_col(numerator).cast("double") / d)


def order_fee(amount: Column | str, status: Column | str, statuses, rate: str) -> Column:
    """Fee of a whole order in cents, half up; 0 for statuses without a fee."""
    fee = F.round(_col(amount).cast("decimal(18,2)") * F.lit(rate).cast("decimal(6,4)"), 2)
    return F.when(_col(status).isin(*statuses), fee).otherwise(F.lit(0)).cast("decimal(18,2)")


def service_fee(amount: Column | str, status: Column | str, statuses) -> Column:
    return order_fee(amount, status, statuses, SERVICE_FEE_RATE)


def acquiring_fee(amount: Column | str, status: Column | str, statuses) -> Column:
    return order_fee(amount, status, statuses, ACQUIRING_FEE_RATE)


def fee_share(fee: Column | str, parts: Column | str) -> Column:
    """An order's fee divided over its tickets, to cents; whole without tickets."""
    parts = _col(parts)
    share = F.round(_col(fee) / F.when(parts > 0, parts), 2)
    return F.when(parts > 0, share).otherwise(_col(fee)).cast("decimal(18,2)")


def net_amount(price: Column | str, *fees: Column | str) -> Column:
    out = _col(price)
    for fee in fees:
        out = out - _col(fee)
    return out


def budget_share(budget: Column | str, channel: Column | str, shares) -> Column:
    """Part of a sheet amount that counts: exact to six places."""
    amount = _col(budget).cast("decimal(24,6)")
    out = F.when(F.lit(False), amount)
    for name, (numerator, denominator) in shares.items():
        part = (amount * F.lit(numerator) / F.lit(denominator)).cast("decimal(24,6)")
        out = out.when(_col(channel) == name, part)
    return out.otherwise(amount)


def whole_half_even(c: Column | str) -> Column:
    """Nearest whole number, a half to the even neighbour."""
    return F.bround(_col(c), 0).cast("long")


def spaced_number(c: Column | str) -> Column:
    """``1234567`` as ``1 234 567``."""
    return F.translate(F.format_number(_col(c), 0), ",", " ")


def signed_percent(c: Column | str) -> Column:
    """``+5%``, ``-3%``, ``0%``; a dash when there is no value."""
    c = _col(c)
    text = F.concat(F.when(c > 0, F.lit("+")).otherwise(F.lit("")), c.cast("string"), F.lit("%"))
    return F.coalesce(text, F.lit(NO_CHANGE))


def trend_mark(c: Column | str) -> Column:
    c = _col(c)
    return F.when(c > 0, F.lit(UP_MARK)).when(c < 0, F.lit(DOWN_MARK)).otherwise(F.lit(""))
