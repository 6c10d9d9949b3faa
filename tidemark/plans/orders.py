"""Order payments and their receipts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import Span
from tidemark.operators.pairing import interval_join, reconcile
from tidemark.operators.sequences import Pattern, match, open_close_outcomes


def order_payments(orders: DataFrame, seq: str, within: Span = "15 minutes", slice: Span | None = None) -> DataFrame:
    """Each created order with its first later payment, or a timeout (``order_id, event_type, ts``)."""
    kind = F.col("event_type")
    pattern = Pattern.begin("create", kind == "create").followed_by("pay", kind == "pay").within(within)
    return match(orders, ["order_id"], "ts", seq, pattern, slice)


def order_outcomes(orders: DataFrame, seq: str, within: Span = "15 minutes", slice: Span | None = None) -> DataFrame:
    """paid, paid_late, timeout or orphan_pay for every create and every stray pay."""
    kind = F.col("event_type")
    return open_close_outcomes(orders, ["order_id"], "ts", seq, kind == "create", kind == "pay", within, slice)


def _payments(orders: DataFrame) -> DataFrame:
    return orders.where(~F.col("tx_id").eqNullSafe(F.lit("")))


def payments_with_receipts(
    orders: DataFrame,
    receipts: DataFrame,
    before: Span = "3 seconds",
    after: Span = "5 seconds",
    bucket: Span | None = None,
) -> DataFrame:
    """Payments joined to receipts of the same transaction near in time."""
    return interval_join(_payments(orders), receipts, ["tx_id"], "ts", "ts", before, after, bucket)


def reconciled_payments(
    orders: DataFrame,
    receipts: DataFrame,
    seq: str,
    pay_waits: Span = "5 seconds",
    receipt_waits: Span = "3 seconds",
    slice: Span | None = None,
) -> DataFrame:
    """Payments and receipts matched one to one; whoever waits in vain is reported single."""
    return reconcile(_payments(orders), receipts, ["tx_id"], "ts", "ts", seq, seq, pay_waits, receipt_waits, slice)
