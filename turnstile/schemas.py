"""Explicit schemas of the landed files and of the tables the jobs write.

No reader in this package infers a schema.  Times are wall-clock times without
a zone, so results do not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
QTY = T.DecimalType(18, 3)
BUDGET = T.DecimalType(24, 6)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


S, TS, L, D, B = T.StringType(), T.TimestampNTZType(), T.LongType(), T.DateType(), T.BooleanType()


REJECTS = _struct(file_path=S, line=S, reason=S, loaded_at=TS)

RECEIPTS = _struct(
    hash_256=S, sale_date=TS, kkm=S, receipt_id=S, receipt_name=S, item_category=S,
    itenm_id=S, item=S, qty=QTY, amount=MONEY, load_dttm=TS,
)

ANSWERS = _struct(id=S, date=TS, value=S, qty=L, city=S, file_name=S, load_dttm=TS)

ANSWER_VERSIONS = _struct(date=TS, city=S, value=S, qty=L, load_dttm=TS)

BUDGETS_WEEK = T.StructType(
    [T.StructField(n, S, True) for n in ("id", "channel", "dateFrom", "dateTo", "city")]
    + [T.StructField("budget", T.DoubleType(), True)]
)

BUDGETS_MONTH = T.StructType(
    [T.StructField(n, S, True) for n in ("id", "channel", "date", "city")]
    + [T.StructField("budget", T.DoubleType(), True)]
)

# An order document of the ticket API.  Amounts arrive as numbers or as text,
# so they are read as text and parsed.
ORDER_DOCUMENT = T.StructType(
    [
        T.StructField("id", S),
        T.StructField("eventSessionId", S),
        T.StructField("created_at", S),
        T.StructField("status", _struct(name=S, title=S)),
        T.StructField("payment", _struct(amount=S, discount=S)),
        T.StructField(
            "tickets",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("id", S),
                        T.StructField("price_nominal", S),
                        T.StructField("ticket_type", _struct(id=S, name=S, price=S)),
                    ]
                )
            ),
        ),
    ]
)

ONLINE_SALES = _struct(
    order_hash=S, order_id=S, event_session_id=S, created_at=TS, status_name=S,
    status_title=S, payment_amount=MONEY, payment_discount=MONEY, ticket_id=S,
    price_nominal=MONEY, ticket_type_id=S, ticket_type_name=S, ticket_price=MONEY,
    event_id=S, timepad_commission=MONEY, acquiring_commission=MONEY,
)

OFFLINE_SALES = _struct(
    sale_ts=TS, buyer=S, item_category=S, item=S, unit=S, qty=QTY, revenue=MONEY,
    city=S, load_dttm=TS,
)

CITIES = _struct(name_ru=S, name_en=S, event_id=S, kkm_name=S, is_active=B)

DATES = _struct(date=D, year=L, week=L, week_range=S)
