"""Content keys: SHA-256 over the text of the fields that identify a row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def joined_text(*parts: Column | str, sep: str = "", null_token: str = "") -> Column:
    """Text of all parts in order; a missing part counts as ``null_token``."""
    texts = [F.coalesce(_col(p).cast("string"), F.lit(null_token)) for p in parts]
    return F.concat_ws(sep, *texts)


def content_key(*parts: Column | str, sep: str = "", null_token: str = "") -> Column:
    return F.sha2(joined_text(*parts, sep=sep, null_token=null_token), 256)


def packed_text(c: Column | str) -> Column:
    """The bytes of a text, those of a hex digest at half their length; different texts stay different, null stays null.

    For keys that are moved only to be compared.
    """
    text = _col(c).cast("string")
    digest = F.unhex(text)
    return F.coalesce(
        F.when(F.lower(F.hex(digest)) == text, F.concat(F.unhex(F.lit("01")), digest)),
        F.concat(F.unhex(F.lit("00")), text.cast("binary")),
    )


def receipt_key() -> Column:
    return content_key("sale_date", "kkm", "receipt_name", "itenm_id")


def answer_key() -> Column:
    return content_key("date", "value", "city")


def order_text() -> Column:
    """The part of ``order_line_key`` that all lines of an order share."""
    return joined_text("event_id", "order_id", "event_session_id", "created_at")


def order_line_key(order: Column | str | None = None) -> Column:
    """``order`` is the ``order_text``, where it was made once for all lines of an order."""
    return content_key(order_text() if order is None else order, "ticket_id", "ticket_type_id")


def budget_key(date_column: str) -> Column:
    return content_key("channel", "city", date_column, sep="_")
