"""Online orders: nested documents to one keyed row per ticket, with fees."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.constants import FEE_STATUSES
from turnstile.functions.keys import order_line_key, order_text
from turnstile.functions.numbers import acquiring_fee, fee_share, service_fee, unreadable
from turnstile.functions.times import order_timestamp
from turnstile.operators.reshape import explode_keeping_childless
from turnstile.schemas import MONEY, ONLINE_SALES


def _text(path: str) -> Column:
    return F.coalesce(F.col(path), F.lit(""))


def _money(path: str) -> Column:
    return F.coalesce(F.col(path).try_cast(MONEY), F.lit(0).cast(MONEY))


def unreadable_amounts() -> Column:
    """A document with an amount or price that is no number."""
    tickets = F.exists(
        "tickets",
        lambda t: unreadable(t["price_nominal"], MONEY) | unreadable(t["ticket_type"]["price"], MONEY),
    )
    payment = unreadable("payment.amount", MONEY) | unreadable("payment.discount", MONEY)
    return payment | F.coalesce(tickets, F.lit(False))


def rows_of_order() -> Column:
    """How many rows ``order_lines`` makes of a document."""
    tickets = F.coalesce(F.size("tickets"), F.lit(0))
    readable = order_timestamp("created_at").isNotNull()
    return F.when(readable, F.greatest(tickets, F.lit(1))).otherwise(F.lit(0))


def order_lines(documents: DataFrame, fee_statuses=FEE_STATUSES, keep: Sequence[str] = ()) -> DataFrame:
    """One row per ticket; an order without tickets gives one row without ticket.

    An order whose time cannot be read is dropped.  Fees are taken of the whole
    order and divided over its tickets.  A missing amount is 0; keep documents
    with ``unreadable_amounts`` out beforehand.  ``keep`` names further columns
    of the documents to hand on.  Narrow from end to end: no shuffle.

    ``explode`` reads an order's time once.  As a plain projection it would be
    read again in the filter, which the optimizer moves below it.
    """
    timed = documents.select("*", F.explode(F.array(order_timestamp("created_at"))).alias("__created"))
    per_order = timed.where(F.col("__created").isNotNull()).select(
        "event_id",
        _text("id").alias("order_id"),
        _text("eventSessionId").alias("event_session_id"),
        F.col("__created").alias("created_at"),
        _text("status.name").alias("status_name"),
        _text("status.title").alias("status_title"),
        _money("payment.amount").alias("payment_amount"),
        _money("payment.discount").alias("payment_discount"),
        F.coalesce(F.size("tickets"), F.lit(0)).alias("__parts"),
        "tickets",
        *keep,
    )
    with_fees = per_order.withColumns(
        {
            "__service": service_fee("payment_amount", "status_name", fee_statuses),
            "__acquiring": acquiring_fee("payment_amount", "status_name", fee_statuses),
            "__order": order_text(),
        }
    )
    lines = explode_keeping_childless(with_fees, "tickets", "t")
    return lines.withColumns(
        {
            "ticket_id": _text("t.id"),
            "price_nominal": _money("t.price_nominal"),
            "ticket_type_id": _text("t.ticket_type.id"),
            "ticket_type_name": _text("t.ticket_type.name"),
            "ticket_price": _money("t.ticket_type.price"),
            "timepad_commission": fee_share("__service", "__parts"),
            "acquiring_commission": fee_share("__acquiring", "__parts"),
        }
    ).select(order_line_key("__order").alias("order_hash"), *ONLINE_SALES.names[1:], *keep)
