"""Signatures as the senders compute them, with Python's hmac: independent of the audited expression."""

import base64
import hmac

import pandas as pd
from pyspark.sql import functions as F

SECRETS = {
    "stripe": "whsec_fixture",
    "square": "square_fixture_key",
    "adyen": "44782DEF547AAA06C910C43932B1EB0C71FC68D9D0C057550C48EC2ACF6BA056",
}


def signer(provider: str):
    secret = SECRETS[provider]
    key = bytes.fromhex(secret) if provider == "adyen" else secret.encode()
    as_hex = provider == "stripe"

    @F.pandas_udf("string")
    def sign(message: pd.Series) -> pd.Series:
        digests = [hmac.digest(key, m, "sha256") for m in message]
        return pd.Series([d.hex() if as_hex else base64.b64encode(d).decode() for d in digests])

    return sign
