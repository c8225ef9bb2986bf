import base64
import hashlib
import hmac
import json

from pyspark.sql import functions as F

from saldo.operators import gateway as G

NOW = "2024-06-01 00:00:00"
EPOCH = 1717200000


def test_digest_equals_the_standard_one(spark):
    for key in (b"k", b"x" * 64, b"y" * 100):
        for message in (b"", b"hello", b"\x00\xff" * 50):
            rows = spark.createDataFrame([(bytearray(message),)], "m binary")
            got = bytes(rows.select(G.hmac_sha256(key, F.col("m")).alias("d")).first()["d"])
            assert got == hmac.new(key, message, hashlib.sha256).digest()


def verdicts(spark, provider, rows, secret, **kw):
    df = spark.createDataFrame([(i, bytearray(v), s) for i, (v, s) in enumerate(rows)], "i int, value binary, signature string")
    return [(r["verdict"], r["reason"]) for r in G.audit_signatures(df, provider, secret, NOW, **kw).orderBy("i").collect()]


def test_stripe(spark):
    sign = lambda t, body, key=b"s": hmac.new(key, f"{t}.".encode() + body, hashlib.sha256).hexdigest()
    good = sign(EPOCH, b"body")
    rows = [
        (b"body", f"t={EPOCH},v1={good}"), (b"body", f"t={EPOCH},v1=bad,v1={good}"), (b"other", f"t={EPOCH},v1={good}"),
        (b"body", f"t={EPOCH - 300},v1={sign(EPOCH - 300, b'body')}"), (b"body", f"t={EPOCH - 301},v1={sign(EPOCH - 301, b'body')}"),
        (b"body", f"t={EPOCH + 301},v1={sign(EPOCH + 301, b'body')}"), (b"body", None), (b"body", "junk"), (b"body", f"v1={good}"),
        (b"body", f"t=x,v1={good}"), (b"body", f"t={EPOCH}"),
    ]
    got = [v for v, _ in verdicts(spark, "stripe", rows, "s")]
    assert got == ["valid", "valid", "invalid", "valid", "expired", "expired"] + ["invalid"] * 5
    assert verdicts(spark, "stripe", rows[:1], "")[0] == ("valid", "verification skipped")


def test_square(spark):
    url = "https://x/y"
    sig = base64.b64encode(hmac.new(b"k", url.encode() + b"body", hashlib.sha256).digest()).decode()
    rows = [(b"body", sig), (b"bodY", sig), (b"body", None)]
    assert [v for v, _ in verdicts(spark, "square", rows, "k", url=url)] == ["valid", "invalid", "invalid"]
    assert verdicts(spark, "square", rows[:1], "k")[0] == ("invalid", "notification URL is required")


def test_adyen(spark):
    key = "00" * 32

    def item(amount, success, signed_amount=None, signed_success="true", signature=...):
        text = f"psp::acc:ref:{signed_amount if signed_amount is not None else amount}:EUR:CAPTURE:{signed_success}"
        sig = base64.b64encode(hmac.new(bytes.fromhex(key), text.encode(), hashlib.sha256).digest()).decode()
        extra = {} if signature is None else {"hmacSignature": sig}
        return json.dumps({"pspReference": "psp", "merchantAccountCode": "acc", "merchantReference": "ref",
                           "amount": {"value": amount, "currency": "EUR"}, "eventCode": "CAPTURE", "success": success,
                           "additionalData": extra}).encode()

    rows = [item(100, True), item(0, True, signed_amount=""), item(200, True, signed_amount=100), item(100, False), item(100, True, signature=None)]
    got = [v for v, _ in verdicts(spark, "adyen", [(r, None) for r in rows], key)]
    assert got == ["valid", "valid", "invalid", "invalid", "invalid"]
    assert verdicts(spark, "adyen", [(rows[0], None)], "zz")[0][1] == "invalid HMAC key format"
