"""Valid / quarantine split of the four typed streams.

The reason is computed once per row; a row is valid exactly when it has none. The same functions
serve batch and streaming DataFrames and never shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldo import constants as C
from saldo.functions.validators import clean_amount, clean_currency


@dataclass(frozen=True)
class SplitRules:
    """What differs between the streams."""

    required: tuple = ()          # (column, rejection code) after the customer
    zero_allowed: bool = False
    suspicious: tuple = ()        # SQL conditions that flag a valid row


RULES = {
    "charges": SplitRules(
        suspicious=("amount = 0 AND status = 'succeeded'", "customer_id IS NULL",
                    "status = 'failed' AND failure_code IS NULL")),
    "refunds": SplitRules(
        required=(("charge_id", "MISSING_CHARGE_ID"),),
        suspicious=("amount = 0", "customer_id IS NULL", "charge_id IS NULL",
                    "status = 'failed' AND failure_reason IS NULL")),
    "disputes": SplitRules(
        required=(("charge_id", "MISSING_CHARGE_ID"),),
        suspicious=("customer_id IS NULL", "charge_id IS NULL", "reason IS NULL")),
    "subscriptions": SplitRules(
        required=(("plan_id", "MISSING_PLAN_ID"),), zero_allowed=True,
        suspicious=("customer_id IS NULL", "plan_id IS NULL", "`interval` IS NULL")),
}


def suspicious_flag(kind: str) -> Column:
    flags = [F.coalesce(F.expr(rule), F.lit(False)) for rule in RULES[kind].suspicious]
    result = flags[0]
    for flag in flags[1:]:
        result = result | flag
    return result


def rejection_reason(kind: str) -> Column:
    """First failing rule, NULL for a valid row."""
    rules = RULES[kind]
    amount = F.col("amount")
    reasons = [F.when(F.col("customer_id").isNull(), "MISSING_CUSTOMER_ID")]
    reasons += [F.when(F.col(c).isNull(), code) for c, code in rules.required]
    reasons += [
        F.when(~F.upper("currency").isin(C.STREAM_CURRENCIES), "INVALID_CURRENCY"),
        F.when(amount < 0 if rules.zero_allowed else amount <= 0, "INVALID_AMOUNT_NEGATIVE"),
        F.when(amount > C.STREAM_MAX_AMOUNT, "INVALID_AMOUNT_TOO_LARGE"),
    ]
    return F.coalesce(*reasons)


def judged(df: DataFrame, kind: str) -> DataFrame:
    """Every row with its rejection reason."""
    return df.withColumn("rejection_reason", rejection_reason(kind))


def valid_rows(judged_rows: DataFrame, kind: str) -> DataFrame:
    """Accepted rows, cleaned and flagged."""
    rows = judged_rows.filter(F.col("rejection_reason").isNull()).drop("rejection_reason")
    return rows.select(*[
        clean_amount(F.col(c), RULES[kind].zero_allowed).alias(c) if c == "amount"
        else clean_currency(F.col(c)).alias(c) if c == "currency"
        else F.col(f"`{c}`")
        for c in rows.columns
    ], suspicious_flag(kind).alias("validation_flag"))


def quarantine_rows(judged_rows: DataFrame, now: Column) -> DataFrame:
    """Rejected rows with their original values."""
    rows = judged_rows.filter(F.col("rejection_reason").isNotNull())
    values = [F.col(f"`{c}`") for c in rows.columns if c != "rejection_reason"]
    return rows.select(*values, now.alias("quarantine_timestamp"), "rejection_reason")


def split(df: DataFrame, kind: str, now: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine) of one stream or table."""
    rows = judged(df, kind)
    return valid_rows(rows, kind), quarantine_rows(rows, F.current_timestamp() if now is None else now)


def split_charges(df: DataFrame, now: Column | None = None):
    return split(df, "charges", now)


def split_refunds(df: DataFrame, now: Column | None = None):
    return split(df, "refunds", now)


def split_disputes(df: DataFrame, now: Column | None = None):
    return split(df, "disputes", now)


def split_subscriptions(df: DataFrame, now: Column | None = None):
    return split(df, "subscriptions", now)
