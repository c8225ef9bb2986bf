"""Fixed values the results depend on: code lists, lookup tables, thresholds."""

# --- fixed values: null spellings -------------------------------------------------------------
NULL_SPELLINGS = ["", "null", "NULL", "Null", "none", "None", "NONE"]

# --- fixed values: three separate currency lists (stream, normalizer, business rules) ----------
STREAM_CURRENCIES = ["USD", "CAD", "GBP", "EUR", "JPY"]
SUPPORTED_CURRENCIES = [
    "USD", "EUR", "GBP", "JPY", "CAD", "AUD", "CHF", "CNY", "HKD", "NZD",
    "SEK", "SGD", "NOK", "MXN", "INR", "BRL", "KRW", "ZAR", "DKK", "PLN",
]
RULE_CURRENCIES = ["USD", "EUR", "GBP", "CAD", "AUD", "JPY", "CHF", "CNY", "HKD", "NZD"]

# --- fixed values: amount bounds ----------------------------------------------------------------
MAX_AMOUNT_CENTS = 100_000_000
STREAM_MAX_AMOUNT = 1_000_000
HIGH_VALUE_CENTS = 10_000

# --- fixed values: provider event type -> unified event type ------------------------------------
STRIPE_EVENT_TYPES = {
    "payment_intent.created": "payment.created",
    "payment_intent.succeeded": "payment.succeeded",
    "payment_intent.payment_failed": "payment.failed",
    "payment_intent.canceled": "payment.canceled",
    "payment_intent.processing": "payment.processing",
    "payment_intent.requires_action": "payment.requires_action",
    "payment_intent.amount_capturable_updated": "payment.amount_capturable_updated",
    "charge.succeeded": "charge.succeeded",
    "charge.failed": "charge.failed",
    "charge.pending": "charge.pending",
    "charge.captured": "charge.captured",
    "charge.refunded": "charge.refunded",
    "charge.updated": "charge.updated",
    "charge.dispute.created": "dispute.created",
    "charge.dispute.closed": "dispute.closed",
    "refund.created": "refund.created",
    "refund.updated": "refund.updated",
    "refund.failed": "refund.failed",
}
SQUARE_EVENT_TYPES = {
    "payment.created": "payment.created",
    "payment.updated": "payment.updated",
    "payment.completed": "payment.succeeded",
    "refund.created": "refund.created",
    "refund.updated": "refund.updated",
}
ADYEN_EVENT_TYPES = {
    "AUTHORISATION": "payment.authorized",
    "CAPTURE": "payment.captured",
    "CANCELLATION": "payment.canceled",
    "REFUND": "refund.created",
    "REFUND_FAILED": "refund.failed",
    "CHARGEBACK": "dispute.created",
    "CHARGEBACK_REVERSED": "dispute.reversed",
    "NOTIFICATION_OF_CHARGEBACK": "dispute.notification",
    "SECOND_CHARGEBACK": "dispute.second_chargeback",
    "PENDING": "payment.pending",
    "REPORT_AVAILABLE": "report.available",
    "PAYOUT_DECLINE": "payout.declined",
    "PAYOUT_EXPIRE": "payout.expired",
    "PAYOUT_THIRDPARTY": "payout.third_party",
}
BRAINTREE_EVENT_TYPES = {
    "transaction_settled": "payment.settled",
    "transaction_settlement_declined": "payment.settlement_declined",
    "transaction_disbursed": "payment.disbursed",
    "subscription_charged_successfully": "subscription.charged",
    "subscription_charged_unsuccessfully": "subscription.charge_failed",
    "subscription_canceled": "subscription.canceled",
    "subscription_expired": "subscription.expired",
    "subscription_trial_ended": "subscription.trial_ended",
    "subscription_went_active": "subscription.activated",
    "subscription_went_past_due": "subscription.past_due",
    "dispute_opened": "dispute.created",
    "dispute_won": "dispute.won",
    "dispute_lost": "dispute.lost",
    "dispute_accepted": "dispute.accepted",
    "dispute_expired": "dispute.expired",
    "disbursement": "disbursement.created",
    "disbursement_exception": "disbursement.exception",
    "sub_merchant_account_approved": "merchant.approved",
    "sub_merchant_account_declined": "merchant.declined",
    "check": "check.verified",
}

# --- fixed values: provider statuses, methods and brands ----------------------------------------
STRIPE_STATUS_HINTS = ["succeeded", "failed", "canceled", "pending", "processing"]
SQUARE_SOURCE_TYPES = {
    "CARD": "card", "CARD_ON_FILE": "card", "CASH": "cash", "EXTERNAL": "external",
    "WALLET": "wallet", "BANK_ACCOUNT": "bank_account",
    "BUY_NOW_PAY_LATER": "buy_now_pay_later", "SQUARE_ACCOUNT": "square_account",
}
SQUARE_STATUSES = {
    "APPROVED": "approved", "COMPLETED": "succeeded", "CANCELED": "canceled",
    "FAILED": "failed", "PENDING": "pending",
}
SQUARE_REFUND_STATUSES = {
    "PENDING": "pending", "COMPLETED": "succeeded", "REJECTED": "rejected", "FAILED": "failed",
}
ADYEN_STATUSES = {
    "AUTHORISATION": "authorized", "CAPTURE": "captured", "CANCELLATION": "canceled",
    "REFUND": "refunded", "REFUND_FAILED": "refund_failed", "CHARGEBACK": "disputed",
    "CHARGEBACK_REVERSED": "dispute_reversed", "PENDING": "pending",
}
ADYEN_METHODS = {
    "visa": "card", "mc": "card", "amex": "card", "discover": "card", "jcb": "card",
    "diners": "card", "cup": "card", "ideal": "bank_transfer",
    "sepadirectdebit": "bank_account", "paypal": "paypal", "applepay": "wallet",
    "googlepay": "wallet", "klarna": "buy_now_pay_later", "afterpay": "buy_now_pay_later",
    "affirm": "buy_now_pay_later",
}
ADYEN_BRANDS = {
    "visa": "visa", "mc": "mastercard", "amex": "amex", "discover": "discover",
    "jcb": "jcb", "diners": "diners",
}
# Ordered: the first rule with a matching word wins.
ADYEN_REFUSALS = [
    (["declined", "refused"], "declined"),
    (["fraud"], "fraud"),
    (["expired"], "expired_card"),
    (["insufficient"], "insufficient_funds"),
    (["invalid"], "invalid_card"),
    (["blocked"], "blocked"),
    (["cancelled", "canceled"], "canceled"),
]
BRAINTREE_KIND_STATUSES = {
    "transaction_settled": "settled",
    "transaction_settlement_declined": "settlement_declined",
    "transaction_disbursed": "disbursed",
    "subscription_charged_successfully": "succeeded",
    "subscription_charged_unsuccessfully": "failed",
    "subscription_canceled": "canceled",
    "dispute_opened": "disputed",
    "dispute_won": "dispute_won",
    "dispute_lost": "dispute_lost",
    "disbursement": "disbursed",
}
BRAINTREE_TXN_STATUSES = {
    "authorized": "authorized", "submitted_for_settlement": "pending", "settling": "pending",
    "settled": "settled", "voided": "canceled", "processor_declined": "failed",
    "gateway_rejected": "failed", "failed": "failed",
    "settlement_declined": "settlement_declined",
}
BRAINTREE_METHODS = {
    "credit_card": "card", "paypal_account": "paypal", "venmo_account": "venmo",
    "apple_pay_card": "wallet", "google_pay_card": "wallet", "android_pay_card": "wallet",
    "samsung_pay_card": "wallet", "visa_checkout_card": "wallet", "masterpass_card": "wallet",
    "us_bank_account": "bank_account", "sepa_debit_account": "bank_account",
    "local_payment": "local_payment",
}
BRAINTREE_BRANDS = {
    "visa": "visa", "mastercard": "mastercard", "american express": "amex", "amex": "amex",
    "discover": "discover", "jcb": "jcb", "diners club": "diners", "maestro": "maestro",
    "unionpay": "unionpay",
}

# --- fixed values: topics -------------------------------------------------------------------------
RAW_TOPICS = [
    "webhooks.stripe.payment_intent", "webhooks.stripe.charge", "webhooks.stripe.refund",
    "webhooks.square.payment", "webhooks.square.refund",
    "webhooks.adyen.notification", "webhooks.braintree.notification",
]
NORMALIZED_TOPIC = "payments.normalized"
DLQ_TOPIC = "payments.validation.dlq"
STREAM_TOPICS = {
    "charges": "payment_charges", "refunds": "payment_refunds",
    "disputes": "payment_disputes", "subscriptions": "payment_subscriptions",
}

# --- fixed values: structural rules ---------------------------------------------------------------
STRIPE_INTENT_STATUSES = [
    "requires_payment_method", "requires_confirmation", "requires_action", "processing",
    "requires_capture", "canceled", "succeeded",
]
STRIPE_CHARGE_STATUSES = ["succeeded", "pending", "failed"]
STRIPE_REFUND_STATUSES = ["pending", "succeeded", "failed", "canceled"]

# --- fixed values: business rules and scoring -----------------------------------------------------
BLOCKED_CUSTOMERS = ["cus_blocked_001", "cus_blocked_002", "cus_test_blocked"]
BLOCKED_MERCHANTS = ["merch_blocked_001"]
RULES_CHECKED = [
    "amount_bounds", "currency_allowed", "customer_blocklist", "merchant_blocklist",
    "required_fields",
]
REQUIRED_FIELDS = ["event_id", "provider", "event_type", "status"]
SUSPICIOUS_BRANDS = ["unknown", "other"]
NON_RETRYABLE_CODES = [
    "card_declined", "expired_card", "fraudulent", "stolen_card", "lost_card",
    "card_not_supported", "currency_not_supported", "do_not_honor", "generic_decline",
    "invalid_account", "invalid_amount", "invalid_card_number", "pickup_card",
    "restricted_card", "security_violation",
]
CUSTOMER_ACTION_CODES = [
    "insufficient_funds", "withdrawal_count_limit_exceeded", "card_velocity_exceeded",
    "authentication_required", "approve_with_id",
]
TRANSIENT_CODES = [
    "processing_error", "issuer_not_available", "try_again_later", "reenter_transaction",
    "network_error", "timeout",
]
RECOVERY_CARD_UPDATE_CODES = [
    "expired_card", "invalid_card_number", "card_declined", "lost_card", "stolen_card",
    "pickup_card",
]
RECOVERY_TRANSIENT_CODES = [
    "processing_error", "issuer_not_available", "try_again_later", "network_error", "timeout",
]
RECOVERY_CUSTOMER_CODES = [
    "insufficient_funds", "withdrawal_count_limit_exceeded", "card_velocity_exceeded",
    "authentication_required",
]
RETRY_MAX_ATTEMPTS = 5

# Churn inputs used when no customer history is supplied.
DEFAULT_CHURN_SIGNALS = {"days_since_last_payment": 5, "days_since_last_failure": 30, "consecutive_failures": 0}

# --- fixed values: categories checked by the quality suite ----------------------------------------
PROVIDERS = ["stripe", "square", "paypal", "adyen", "braintree"]
EVENT_CATEGORIES = ["charge", "refund", "dispute", "subscription", "failed_payment", "other"]
CUSTOMER_TIERS = ["platinum", "gold", "silver", "bronze"]
RISK_PROFILES = ["high_risk", "medium_risk", "low_risk"]
RISK_LEVELS = ["high", "medium", "low"]
HEALTH_CATEGORIES = ["excellent", "good", "fair", "poor"]
SEGMENT_TYPES = ["tier", "fraud_risk", "churn_risk", "payment_method"]
