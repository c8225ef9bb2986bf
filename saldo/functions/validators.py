"""Value checks and lookups shared by the normalizers and the stream split."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saldo import constants as C
from saldo.schemas import ERRORS


def lookup(table: dict[str, str], key: Column) -> Column:
    """Value of a literal map, NULL when absent."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), key)


def present(c: Column) -> Column:
    """Neither NULL nor empty text."""
    return c.isNotNull() & (c != "")


def normalize_null_string(c: Column) -> Column:
    """The seven exact null spellings become NULL."""
    return F.when(~c.isin(C.NULL_SPELLINGS), c)


def normalize_null(name: str, dtype: T.DataType) -> Column:
    """normalize_null_string on text columns, other types unchanged."""
    col = F.col(f"`{name}`")
    return normalize_null_string(col).alias(name) if isinstance(dtype, T.StringType) else col


def _verdict(value: Column, message: Column) -> Column:
    return F.struct(
        message.isNull().alias("is_valid"),
        F.when(message.isNull(), value).alias("value"),
        message.alias("message"),
    )


def validate_currency(c: Column, allowed: list[str] | None = None) -> Column:
    """struct(is_valid, value, message) for a currency code."""
    code = F.trim(F.upper(c))
    message = (
        F.when(c.isNull(), "Currency is required")
        .when(code == "", "Currency cannot be empty")
        .when(F.length(code) != 3, F.format_string("Currency must be 3 characters, got %d", F.length(code)))
        .when(~code.isin(allowed or C.SUPPORTED_CURRENCIES), F.concat(F.lit("Unsupported currency: "), code))
    )
    return _verdict(code, message)


def variant_integer(v: Column) -> Column:
    """Whole number held by a JSON value: numbers truncate, text must be a whole number."""
    kind = F.schema_of_variant(v)
    text = F.try_variant_get(v, "$", "string")
    whole_text = F.when(text.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(text).try_cast("decimal(38,0)"))
    number = F.try_variant_get(v, "$", "decimal(38,9)")
    truncated = F.when(number < 0, F.ceil(number)).otherwise(F.floor(number))
    return (
        F.when(kind == "STRING", whole_text)
        .when(kind == "BOOLEAN", F.try_variant_get(v, "$", "int"))
        .otherwise(truncated)
        .cast("decimal(38,0)")
    )


def validate_amount(
    amount: Column,
    supplied: Column | None = None,
    low: int = 0,
    high: int = C.MAX_AMOUNT_CENTS,
    allow_zero: bool = True,
) -> Column:
    """struct(is_valid, value, message) for an amount in cents.

    `amount` is the integer reading, NULL when it has none; `supplied` says whether any value was given.
    """
    given = amount.isNotNull() if supplied is None else supplied
    whole = amount.cast("decimal(38,0)")
    message = (
        F.when(~given, "Amount is required")
        .when(whole.isNull(), "Amount must be an integer")
        .when(whole < low, F.concat(F.lit(f"Amount must be >= {low}, got "), whole.cast("string")))
        .when(whole > high, F.concat(F.lit(f"Amount must be <= {high}, got "), whole.cast("string")))
    )
    if not allow_zero:
        message = F.coalesce(message, F.when(whole == 0, "Amount cannot be zero"))
    return _verdict(F.when(whole.between(low, high), whole).cast("bigint"), message)


def validate_refund_amount(
    amount: Column, supplied: Column | None = None, high: int = C.MAX_AMOUNT_CENTS
) -> Column:
    return validate_amount(amount, supplied, 0, high, True)


def amount_error_code(amount: Column, high: int = C.MAX_AMOUNT_CENTS) -> Column:
    """Code for an amount already found invalid."""
    return (
        F.when(amount > high, "INVALID_AMOUNT_TOO_LARGE")
        .when(amount < 0, "INVALID_AMOUNT_NEGATIVE")
        .otherwise("INVALID_AMOUNT")
    )


def error(when: Column, field: str, code: Column | str, message: Column | str) -> Column:
    """An error entry where the condition holds, else NULL."""
    as_col = lambda x: F.lit(x) if isinstance(x, str) else x
    return F.when(
        when,
        F.struct(F.lit(field).alias("field"), as_col(code).alias("code"), as_col(message).alias("message")),
    )


def collect_errors(*entries: Column) -> Column:
    """Ordered list of the entries that hold."""
    return F.array_compact(F.array(*entries)).cast(ERRORS)


def error_codes(errors: Column) -> Column:
    return F.transform(errors, lambda e: e["code"])


def primary_error_code(errors: Column) -> Column:
    return F.try_element_at(errors, F.lit(1))["code"]


EVENT_TYPE_MAPS = {
    "stripe": C.STRIPE_EVENT_TYPES,
    "square": C.SQUARE_EVENT_TYPES,
    "adyen": C.ADYEN_EVENT_TYPES,
    "braintree": C.BRAINTREE_EVENT_TYPES,
}


def normalize_event_type(provider: str, raw: Column) -> Column:
    """Unified event type; unmapped types keep the provider's convention."""
    unmapped = {"adyen": F.lower(raw), "braintree": F.replace(raw, F.lit("_"), F.lit("."))}
    return F.coalesce(lookup(EVENT_TYPE_MAPS[provider], raw), unmapped.get(provider, raw))


def parse_iso_or(text: Column, fallback: Column) -> Column:
    """ISO-8601 timestamp; missing or unreadable text gives the fallback."""
    return F.coalesce(F.try_to_timestamp(text), fallback)


# --- typed streams ------------------------------------------------------------------------------

def clean_amount(amount: Column, zero_allowed: bool = False) -> Column:
    low = amount >= 0 if zero_allowed else amount > 0
    return F.when(low & (amount <= C.STREAM_MAX_AMOUNT), amount)


def clean_currency(currency: Column) -> Column:
    folded = F.upper(currency)
    return F.when(~folded.isin("NULL", ""), folded)
