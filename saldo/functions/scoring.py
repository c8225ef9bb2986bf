"""Rule-based scores and decisions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from saldo import constants as C


def keyed_noise(key: Column, modulus: int) -> Column:
    """Stable integer in [0, modulus) from the first 32 bits of the key's MD5."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % modulus


def _score(base_points: Column, noise_points: Column) -> Column:
    """Clamp integer points (1/10000) to [0, 1]. NULL noise counts as none."""
    total = base_points + F.coalesce(noise_points, F.lit(0))
    return F.greatest(F.lit(0), F.least(F.lit(10000), total)) / F.lit(10000.0)


def fraud_rules(event_id: Column, amount: Column, customer: Column, brand: Column) -> Column:
    """struct(score, factors) from amount tier, guest checkout and brand."""
    very_high = amount > 100_000
    high = (amount > 50_000) & ~very_high
    guest = customer.isNull() | (customer == "")
    odd_brand = F.coalesce(F.lower(brand).isin(C.SUSPICIOUS_BRANDS), F.lit(False))
    points = (
        F.lit(500)
        + F.when(very_high, 2500).when(high, 1500).otherwise(0)
        + F.when(guest, 1500).otherwise(0)
        + F.when(odd_brand, 1000).otherwise(0)
    )
    factors = F.array_compact(F.array(
        F.when(very_high, "very_high_amount").when(high, "high_amount"),
        F.when(guest, "guest_checkout"),
        F.when(odd_brand, "unknown_card_brand"),
    ))
    return F.struct(
        _score(points, keyed_noise(event_id, 1001) - 500).alias("score"), factors.alias("factors")
    )


def fraud_level(score: Column) -> Column:
    return F.when(score >= 0.7, "high").when(score >= 0.3, "medium").otherwise("low")


def churn_rules(customer: Column, failures: Column, days_since_payment: Column) -> Column:
    """struct(probability, factors, actions) from the failure streak and the payment gap."""
    many, some = failures >= 3, failures >= 1
    gap = days_since_payment > 30
    points = (
        F.lit(500) + F.when(many, 3500).when(some, 1500).otherwise(0) + F.when(gap, 1500).otherwise(0)
    )
    factors = F.array_compact(F.array(
        F.when(many, "multiple_consecutive_failures").when(some, "recent_failure"),
        F.when(gap, "payment_gap"),
    ))
    actions = F.array_compact(F.array(
        F.when(many, "immediate_customer_outreach").when(some, "send_payment_update_reminder"),
        F.when(gap, "engagement_campaign"),
    ))
    return F.struct(
        _score(points, keyed_noise(customer, 1000) - 500).alias("probability"),
        factors.alias("factors"),
        actions.alias("actions"),
    )


def churn_level4(p: Column) -> Column:
    return (
        F.when(p >= 0.75, "critical").when(p >= 0.5, "high").when(p >= 0.25, "medium").otherwise("low")
    )


def folded_code(code: Column) -> Column:
    """Lower-case failure code with underscores; empty when missing."""
    return F.replace(F.lower(F.coalesce(code, F.lit(""))), F.lit(" "), F.lit("_"))


def retry_strategy(failure_code: Column, attempt: Column) -> Column:
    """struct(action, delay_seconds, max_attempts, confidence, reason) for a failed payment."""
    code = folded_code(failure_code)
    top = C.RETRY_MAX_ATTEMPTS
    quoted = F.concat(F.lit("Failure code '"), code, F.lit("'"))
    # The exponent is bounded before the power so that the arithmetic cannot overflow.
    backoff = F.least(F.lit(3600), 60 * F.pow(F.lit(2), F.least(attempt, F.lit(12)) - 1)).cast("bigint")
    linear = F.least(F.lit(3600).cast("bigint"), 120 * attempt.cast("bigint"))

    def outcome(action, delay, confidence, reason):
        return F.struct(
            F.lit(action).alias("action"),
            delay.cast("bigint").alias("delay_seconds"),
            F.lit(top).cast("bigint").alias("max_attempts"),
            F.lit(confidence).alias("confidence"),
            reason.alias("reason"),
        )

    none = F.lit(None)
    return (
        F.when(
            code.isin(C.NON_RETRYABLE_CODES),
            outcome("do_not_retry", none, 0.95, F.concat(quoted, F.lit(" is not retryable"))),
        )
        .when(
            code.isin(C.CUSTOMER_ACTION_CODES),
            outcome("contact_customer", none, 0.90, F.concat(quoted, F.lit(" requires customer action"))),
        )
        .when(
            attempt >= top,
            outcome("do_not_retry", none, 0.85, F.lit(f"Maximum attempts ({top}) reached")),
        )
        .when(
            code.isin(C.TRANSIENT_CODES) | (code == ""),
            outcome("retry_delayed", backoff, 0.75, F.concat(
                F.lit("Transient failure, retry in "), backoff.cast("string"), F.lit("s (attempt "),
                attempt.cast("string"), F.lit(f"/{top})"))),
        )
        .otherwise(outcome("retry_delayed", linear, 0.60, F.concat(
            F.lit("Unknown failure code '"), code, F.lit("', conservative retry in "),
            linear.cast("string"), F.lit("s"))))
    )


def is_card_expired(month: Column, year: Column, as_of: Column) -> Column:
    """A card is valid through its expiry month; a missing or zero part means not expired."""
    known = (F.coalesce(month, F.lit(0)) != 0) & (F.coalesce(year, F.lit(0)) != 0)
    return known & (year * 12 + month < F.year(as_of) * 12 + F.month(as_of))


def optimal_retry_hour(code: Column, amount: Column) -> Column:
    funds = F.lower(F.coalesce(code, F.lit(""))).contains("insufficient_funds")
    return F.when(funds, 9).when(amount > 5_000_000, 14).otherwise(10)


def recovery_confidence(code: Column, ltv: Column, email: Column, phone: Column) -> Column:
    points = (
        F.lit(60)
        + F.when(F.coalesce(code, F.lit("")) != "", 15).otherwise(0)
        + F.when(ltv > 0, 10).otherwise(0)
        + F.when(email | phone, 10).otherwise(0)
    )
    return F.least(points, F.lit(95)) / F.lit(100.0)
