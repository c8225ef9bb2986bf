"""Event enrichment: business rules, fraud, retry, churn and recovery decisions, bronze rows.

All rules are column expressions over one row, so the whole chain is a single narrow stage. Only two
optional inputs add a join: block lists given as tables and customer history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saldo import constants as C
from saldo.functions import scoring as R
from saldo.functions.macros import whole_days
from saldo.operators.sequences import trailing_count
from saldo.schemas import BRONZE

RULE_ERRORS = T.ArrayType(T.StructType([
    T.StructField("rule", T.StringType()), T.StructField("code", T.StringType()),
    T.StructField("message", T.StringType()),
]))


def _blocked(df: DataFrame, column: str, values: list[str], table: DataFrame | None, flag: str) -> DataFrame:
    """Marks rows on a block list: a literal list, or a table joined without a forced strategy.

    Whether the table is broadcast is left to its measured size (autoBroadcastJoinThreshold, AQE); a
    large list falls back to a sort-merge join, whose hot keys AQE splits.
    """
    if table is None:
        return df.withColumn(flag, F.coalesce(F.col(column).isin(values), F.lit(False)))
    listed = table.select(column).distinct().withColumn(flag, F.lit(True))
    return df.join(listed, column, "left").withColumn(flag, F.col(flag).isNotNull())


def business_rules(
    df: DataFrame, blocked_customers: DataFrame | None = None, blocked_merchants: DataFrame | None = None
) -> DataFrame:
    """Adds is_valid, errors, warnings and rules_checked."""
    columns = df.columns
    df = _blocked(df, "customer_id", C.BLOCKED_CUSTOMERS, blocked_customers, "_bad_customer")
    df = _blocked(df, "merchant_id", C.BLOCKED_MERCHANTS, blocked_merchants, "_bad_merchant")
    amount = F.coalesce("amount_cents", F.lit(0))
    currency = F.upper(F.coalesce("currency", F.lit("")))

    def broken(condition, rule, code, *message):
        parts = [F.lit(m) if isinstance(m, str) else m.cast("string") for m in message]
        return F.when(condition, F.struct(
            F.lit(rule).alias("rule"), F.lit(code).alias("code"), F.concat(*parts).alias("message")))

    entries = [
        broken(amount <= 0, "amount_bounds", "AMOUNT_NOT_POSITIVE", "Amount must be greater than zero"),
        broken(amount > C.MAX_AMOUNT_CENTS, "amount_bounds", "AMOUNT_EXCEEDS_MAXIMUM",
               "Amount ", amount, f" exceeds maximum {C.MAX_AMOUNT_CENTS}"),
        broken(~currency.isin(C.RULE_CURRENCIES), "currency_allowed", "CURRENCY_NOT_ALLOWED",
               "Currency '", currency, "' is not in allowed list"),
        broken(F.col("_bad_customer"), "customer_blocklist", "CUSTOMER_BLOCKLISTED",
               "Customer '", F.col("customer_id"), "' is blocklisted"),
        broken(F.col("_bad_merchant"), "merchant_blocklist", "MERCHANT_BLOCKLISTED",
               "Merchant '", F.col("merchant_id"), "' is blocklisted"),
        *[
            broken(F.coalesce(F.trim(name), F.lit("")) == "", "required_fields", "MISSING_REQUIRED_FIELD",
                   f"Required field '{name}' is missing or empty")
            for name in C.REQUIRED_FIELDS
        ],
    ]
    warning = F.when(amount > C.HIGH_VALUE_CENTS, F.struct(
        F.lit("high_value_warning").alias("rule"),
        F.concat(F.lit("High-value transaction: "), amount.cast("string"), F.lit(" cents")).alias("message")))
    df = df.withColumn("errors", F.array_compact(F.array(*entries)).cast(RULE_ERRORS))
    return df.select(
        *columns, (F.size("errors") == 0).alias("is_valid"), "errors",
        F.array_compact(F.array(warning)).alias("warnings"),
        F.array(*[F.lit(r) for r in C.RULES_CHECKED]).alias("rules_checked"),
    )


def event_gates() -> dict[str, Column]:
    """Which decisions an event gets: scored, retried, churn."""
    status, kind = F.lower(F.coalesce("status", F.lit(""))), F.lower(F.coalesce("event_type", F.lit("")))
    has = lambda c, word: c.contains(word)
    return {
        "scored": has(status, "succeeded") | has(status, "captured") | has(kind, "succeeded") | has(kind, "captured"),
        "retried": has(status, "failed") | has(kind, "failed") | has(status, "declined"),
        "churn": F.coalesce(F.col("customer_id") != "", F.lit(False)),
    }


def fraud_score(df: DataFrame) -> DataFrame:
    """Adds fraud_score, risk_level and risk_factors."""
    rules = R.fraud_rules(F.col("event_id"), F.col("amount_cents"), F.col("customer_id"), F.col("card_brand"))
    columns = [c for c in df.columns if c not in ("fraud_score", "risk_level", "risk_factors")]
    scored = df.withColumn("_fraud", rules)
    return scored.select(
        *columns, F.col("_fraud.score").alias("fraud_score"),
        R.fraud_level(F.col("_fraud.score")).alias("risk_level"),
        F.col("_fraud.factors").alias("risk_factors"))


def customer_history(events: DataFrame, as_of) -> DataFrame:
    """Measured churn signals per customer at as_of. Aggregations only, no per-customer ordering."""
    now, at = F.lit(as_of).cast("timestamp"), F.col("provider_created_at")
    seen = events.filter(F.col("customer_id").isNotNull() & (at <= now)).select(
        "customer_id", "event_id", "status", "provider_created_at")
    failed = F.coalesce(F.lower("status").contains("failed"), F.lit(False))
    counts = seen.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_payments"),
        F.count_if(F.col("status") == "succeeded").alias("successful_payments"),
        F.count_if(failed).alias("failed_payments"),
        whole_days(F.max(at), now).alias("days_since_last_payment"),
        whole_days(F.max(F.when(failed, at)), now).alias("days_since_last_failure"),
    )
    streak = trailing_count(seen, "customer_id", F.struct(at, F.col("event_id")), failed, "consecutive_failures")
    return counts.join(streak, "customer_id")


def churn_signals(df: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Adds the churn inputs: declared defaults, or the customer's measured history where known.

    An event that itself failed counts as a running failure streak of at least one.
    """
    status = F.lower(F.coalesce("status", F.lit("")))
    failing = status.contains("failed") | status.contains("declined")
    streak = F.lit(C.DEFAULT_CHURN_SIGNALS["consecutive_failures"])
    gap = F.lit(C.DEFAULT_CHURN_SIGNALS["days_since_last_payment"])
    since_failure = F.lit(C.DEFAULT_CHURN_SIGNALS["days_since_last_failure"])
    columns = df.columns
    if history is not None:
        measured = history.select(
            "customer_id", F.col("consecutive_failures").alias("_streak"),
            F.col("days_since_last_payment").alias("_gap"),
            F.col("days_since_last_failure").alias("_since"))
        df = df.join(measured, "customer_id", "left")
        streak = F.coalesce("_streak", streak)
        gap, since_failure = F.coalesce("_gap", gap), F.coalesce("_since", since_failure)
    return df.select(
        *columns,
        F.when(failing, F.greatest(streak, F.lit(1))).otherwise(streak).alias("consecutive_failures"),
        gap.alias("days_since_last_payment"),
        F.when(failing, 0).otherwise(since_failure).alias("days_since_last_failure"),
    )


def churn_score(df: DataFrame) -> DataFrame:
    """Adds churn_score, churn_risk_level, churn_risk_factors and churn_actions from the signals."""
    rules = R.churn_rules(F.col("customer_id"), F.col("consecutive_failures"), F.col("days_since_last_payment"))
    columns = [c for c in df.columns if c not in ("churn_score", "churn_risk_level")]
    return df.withColumn("_churn", rules).select(
        *columns, F.col("_churn.probability").alias("churn_score"),
        R.churn_level4(F.col("_churn.probability")).alias("churn_risk_level"),
        F.col("_churn.factors").alias("churn_risk_factors"),
        F.col("_churn.actions").alias("churn_actions"))


def retry_decision(df: DataFrame, attempt: Column) -> DataFrame:
    """Adds the `retry` struct: action, delay_seconds, max_attempts, confidence, reason."""
    return df.withColumn("retry", R.retry_strategy(F.col("failure_code"), attempt))


def metadata_attempt(metadata: Column) -> Column:
    """Attempt count carried in the event's metadata, 1 when absent."""
    return F.coalesce(F.get_json_object(metadata, "$.retry_attempt_count").try_cast("bigint"), F.lit(1))


# --- recovery -------------------------------------------------------------------------------------

def _step(action: str, delay: Column | float, reason: Column | str, success: Column | float) -> Column:
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(
        F.lit(action).alias("action"), lit(delay).cast("double").alias("delay_hours"),
        lit(reason).alias("reason"), lit(success).cast("double").alias("expected_success_rate"))


def _plan(action: str, probability: Column | float, steps: list[Column], insights: list[Column]) -> Column:
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(
        F.lit(action).alias("primary_action"),
        F.array_compact(F.array(*steps)).alias("steps"),
        lit(probability).cast("double").alias("probability"),
        F.array_compact(F.array(*insights)).alias("notes"))


def recovery_plan(df: DataFrame, as_of) -> DataFrame:
    """Adds priority, primary_action, steps, probability, insights, retry hour and confidence.

    Expects failure_code, amount_cents, attempt_number, max_attempts, ltv_cents, subscription_tier,
    has_email, has_phone, has_backup, card_exp_month and card_exp_year.
    """
    col = F.col
    n, code = col("attempt_number"), R.folded_code(col("failure_code"))
    ltv, tier = col("ltv_cents"), col("subscription_tier")
    email, phone, backup = col("has_email"), col("has_phone"), col("has_backup")
    rich, premium = ltv > 10_000_000, F.coalesce(tier.isin("enterprise", "pro"), F.lit(False))
    priority = F.when(rich, "urgent").when(premium, "high").when(n >= 3, "high").otherwise("medium")
    opening = (
        F.when(rich, F.lit("High-value customer requires priority recovery"))
        .when(premium, F.concat(F.lit("Premium tier ("), tier, F.lit(") customer")))
        .when(n >= 3, F.lit("Multiple failed attempts - escalating priority"))
    )
    say = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    spare = F.when(backup, F.lit("Backup payment method available"))
    hours = F.least(F.pow(F.lit(2), F.least(n, F.lit(12)) - 1), F.lit(24)).cast("bigint")
    # In tenths, so that seven attempts give exactly zero; later ones stay at zero.
    retry_success = F.greatest(F.lit(7) - n, F.lit(0)) / F.lit(10.0)

    expired = _plan("update_payment_method", 0.35, [
        _step("update_payment_method", 0, "Card has expired and must be updated", 0.0),
        F.when(email, _step("dunning_email", 0.5, "Send card update request email", 0.35)),
        F.when(phone, _step("sms_reminder", 24, "Follow up with SMS if no response", 0.25)),
    ], [opening, F.lit("Card is expired")])
    card_update = _plan("update_payment_method", F.when(backup, 0.65).otherwise(0.30), [
        F.when(backup, _step("offer_alternative", 0, "Try backup payment method first", 0.65)),
        _step("dunning_email", 0, say("Notify customer of ", code), 0.30),
    ], [opening, say("Card issue (", code, ") requires customer action"), spare])
    transient = _plan("retry_optimal_time", 0.70, [
        _step("retry_optimal_time", hours, say("Retry after ", hours.cast("string"), "h for transient failure"),
              retry_success),
        F.when(n >= 3, _step("dunning_email", hours + 24, "Notify customer after multiple failures", 0.20)),
    ], [opening, say("Transient failure (", code, ") - good retry candidate")])
    customer = _plan("retry_optimal_time", F.when(backup, 0.55).otherwise(0.45), [
        F.when(backup, _step("offer_alternative", 0, "Offer to use backup payment method", 0.55)),
        _step("retry_optimal_time", 24, "Wait for funds to become available", 0.45),
        F.when(email, _step("dunning_email", 48, "Send friendly reminder about payment", 0.30)),
    ], [opening, say("Customer action required (", code, ")"), spare])
    other = _plan("retry_optimal_time", 0.50, [
        _step("retry_optimal_time", 4, "Standard retry after cooling period", 0.50),
        _step("dunning_email", 24, "Follow up with payment reminder", 0.25),
        F.when(n >= col("max_attempts") - 1,
               _step("escalate_to_support", 48, "Escalate to support before final attempt", 0.15)),
    ], [opening, say("Unknown failure code: ", F.when(code == "", "none").otherwise(code))])

    is_expired = R.is_card_expired(col("card_exp_month"), col("card_exp_year"), F.lit(as_of).cast("timestamp"))
    plan = (
        F.when(is_expired, expired)
        .when(code.isin(C.RECOVERY_CARD_UPDATE_CODES), card_update)
        .when(code.isin(C.RECOVERY_TRANSIENT_CODES), transient)
        .when(code.isin(C.RECOVERY_CUSTOMER_CODES), customer)
        .otherwise(other)
    )
    return df.withColumn("_plan", plan).select(
        *df.columns, priority.alias("priority"), "_plan.primary_action", "_plan.steps", "_plan.probability",
        col("_plan.notes").alias("insights"),
        R.optimal_retry_hour(col("failure_code"), col("amount_cents")).alias("optimal_retry_hour"),
        R.recovery_confidence(col("failure_code"), ltv, email, phone).alias("confidence"),
    )


# --- the whole chain ------------------------------------------------------------------------------

RULE_MODEL = "rules-v1"


def enrich(
    events: DataFrame,
    blocked_customers: DataFrame | None = None,
    blocked_merchants: DataFrame | None = None,
    history: DataFrame | None = None,
) -> DataFrame:
    """Unified events with validation result, scores and retry decision. Invalid events are kept."""
    gates = event_gates()
    df = business_rules(events, blocked_customers, blocked_merchants)
    df = churn_signals(df, history)
    fraud = R.fraud_rules(F.col("event_id"), F.col("amount_cents"), F.col("customer_id"), F.col("card_brand"))
    churn = R.churn_rules(F.col("customer_id"), F.col("consecutive_failures"), F.col("days_since_last_payment"))
    retry = R.retry_strategy(F.col("failure_code"), metadata_attempt(F.col("metadata")))
    df = (
        df.withColumn("_fraud", F.when(gates["scored"], fraud))
        .withColumn("_churn", F.when(gates["churn"], churn))
        .withColumn("retry", F.when(gates["retried"], retry))
    )
    return df.select(
        *events.columns,
        F.when(F.col("is_valid"), "passed").otherwise("failed").alias("validation_status"),
        F.col("errors").alias("validation_errors"), "warnings",
        F.col("_fraud.score").alias("fraud_score"),
        F.when(gates["scored"], R.fraud_level(F.col("_fraud.score"))).alias("risk_level"),
        F.col("_fraud.factors").alias("risk_factors"),
        F.when(gates["scored"], RULE_MODEL).alias("fraud_model_version"),
        "retry",
        F.col("_churn.probability").alias("churn_score"),
        F.when(gates["churn"], R.churn_level4(F.col("_churn.probability"))).alias("churn_risk_level"),
        # The rules give no estimate of the days left; the column is kept for models that do.
        F.lit(None).cast("bigint").alias("days_to_churn_estimate"),
        F.when(gates["churn"], RULE_MODEL).alias("churn_model_version"),
    )


def to_bronze(enriched: DataFrame, now: Column) -> DataFrame:
    """28-column bronze rows. The retry delay is taken from the strategy it belongs to."""
    versions = F.map_filter(
        F.create_map(
            F.lit("fraud_model_version"), F.col("fraud_model_version"),
            F.lit("churn_model_version"), F.col("churn_model_version")),
        lambda _, v: v.isNotNull())
    own = F.coalesce(F.from_json("metadata", "map<string,string>"), F.create_map().cast("map<string,string>"))
    kept = F.map_filter(own, lambda k, _: ~F.map_contains_key(versions, k))
    keep_nulls = {"ignoreNullFields": "false"}
    values = {
        "retry_strategy": F.to_json("retry", keep_nulls),
        "retry_delay_seconds": F.col("retry.delay_seconds"),
        "validation_errors": F.to_json("validation_errors"),
        "metadata": F.to_json(F.map_concat(kept, versions)),
        "ingested_at": now,
    }
    return enriched.select(*[
        values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in BRONZE.fields])
