"""Operator 12: base patterns against plain scanning, keys and tokens made here, and near misses."""

import base64
import hashlib
import hmac
import json
import random
import re

from dwspark.llm import key_formats as K
from dwspark.llm import secrets as S


def tlv(tag, content):
    n = len(content)
    size = bytes([n]) if n < 128 else bytes([0x80 + (n.bit_length() + 7) // 8]) + n.to_bytes((n.bit_length() + 7) // 8)
    return bytes([tag]) + size + content


def number(v):
    return tlv(2, v.to_bytes(v.bit_length() // 8 + 1))


P, Q = 2**521 - 1, 2**607 - 1  # primes
RSA = tlv(0x30, b"".join(map(number, [0, P * Q, 65537, pow(65537, -1, (P - 1) * (Q - 1)), P, Q, 3, 5, 7])))
EC = tlv(0x30, number(1) + tlv(4, bytes(range(32))) + tlv(0xA0, tlv(6, b"\x2a\x86\x48\xce\x3d\x03\x01\x07")))
PKCS8 = tlv(0x30, number(0) + tlv(0x30, tlv(6, b"\x2a\x86\x48\x86\xf7\x0d\x01\x01\x01") + b"\x05\x00") + tlv(4, RSA))
ED25519 = tlv(0x30, number(0) + tlv(0x30, tlv(6, b"\x2b\x65\x70")) + tlv(4, tlv(4, bytes(range(32)))))
PUBLIC = tlv(0x30, number(P * Q) + number(65537))


def field(b):
    return len(b).to_bytes(4) + b


OPENSSH = K.OPENSSH + field(b"none") + field(b"none") + field(b"") + (1).to_bytes(4) + field(field(b"ssh-ed25519") + field(b"x" * 32)) + field(b"abcdabcd" + b"k" * 64)


def b64(data, url=False):
    return (base64.urlsafe_b64encode(data).rstrip(b"=") if url else base64.b64encode(data)).decode()


def pem(data, label="RSA PRIVATE KEY", end="\n"):
    body = b64(data)
    return end.join([f"-----BEGIN {label}-----", *(body[i : i + 64] for i in range(0, len(body), 64)), f"-----END {label}-----"])


def jwt(algorithm="HS256", size=None, payload={"sub": "é"}):
    head = b64(json.dumps({"typ": "JWT", "alg": algorithm}).encode(), True) + "." + b64(json.dumps(payload).encode(), True)
    signature = hmac.new(b"k", head.encode(), hashlib.sha256).digest()
    return head + "." + b64(signature[: size or 32], True)


def kinds(text):
    return [(s[2], s[3], text[s[0] : s[1]]) for s in S.confirmed(text)]


def test_keys_are_told_by_structure():
    for data, kind in [(RSA, "rsa"), (EC, "ec"), (PKCS8, "pkcs8"), (ED25519, "pkcs8"), (OPENSSH, "openssh")]:
        assert K.private_key(data) == kind
        assert K.private_key(data[:-1]) is None and K.private_key(data + b"\0") is None
        for text in (b64(data), data.hex(), b64(data, True)):
            assert kinds(f"é {text}, x") == [("key", kind, text)]
        for end in ("\n", "\r\n", "\\n"):
            assert kinds("漢\n" + pem(data, end=end) + "\n.") == [("key", kind, pem(data, end=end))]
    assert K.private_key(PUBLIC) is None and kinds(b64(PUBLIC)) == []
    wrong = bytearray(RSA)
    wrong[40] ^= 1  # the modulus is no longer the product of the primes
    assert K.private_key(bytes(wrong)) is None
    assert kinds(pem(b"not a key at all, only text")) == []
    assert kinds(pem(RSA).replace("-----END", "-----NO")) == []
    old = "-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,%s\n\n" + b64(bytes(64)) + "\n-----END RSA PRIVATE KEY-----"
    assert kinds(old % ("0" * 32))[0][1] == "encrypted" and kinds(old % "zz") == []


def test_tokens_need_header_payload_and_signature():
    assert kinds(f"x={jwt()} y") == [("token", "HS256", jwt())]
    assert kinds(jwt(size=31)) == [] and kinds(jwt("none")) == [] and kinds(jwt(payload=[1])) == []
    assert kinds(jwt()[:8] + jwt()[12:]) == []  # the header is no JSON


def test_encoded_secrets_are_decoded_up_to_the_depth():
    inner = "password=hunter2hunter2 and more"
    once = b64(inner.encode())
    assert kinds(once) == [("encoded", "assign", once)]
    assert kinds(inner.encode().hex())[0][:2] == ("encoded", "assign")
    nested = b64(f"note: {b64(f'see {once}'.encode())}".encode())
    assert kinds(nested)[0][0] == "encoded"
    assert kinds(b64(f"x {nested}".encode())) == []
    assert kinds(b64(pem(EC).encode()))[0][:2] == ("encoded", "key")
    assert kinds(b64(b"only a plain sentence with nothing in it")) == []


def plain(text):
    """Base matches by the contract's own patterns."""
    out = []
    for kind, pattern, keep in [
        ("assign", r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 8),
        ("access", "AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
        ("hex", "[0-9a-f]+", lambda m: len(m[0]) >= 32),
    ]:
        out += [(m.start(), S.KINDS.index(kind), m.end()) for m in re.finditer(pattern, text) if keep(m)]
    return [f"{S.KINDS[k]}:{s}:{e}" for s, k, e in sorted(out)]


def test_base_spans_equal_plain_scanning_and_stay(spark):
    rng = random.Random(2)
    parts = ["password", "PassWD", "ſecret", "secret", "toKen", "token", "API_KEY", "apikey", '"', "'", " ", "  ", ":", "=", "==", "AKIA", "AKIAAKIA", "ABCDEF0123456789", "deadbeef" * 5, "g", "é", "\U0001f600", "hunter2!", "a.b/c+d_e-f=", "\n", pem(EC), jwt(), b64(RSA)]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(1500)] + ["", None, "token=" + "a" * 200000, "password" + " " * 100000, "eyJ" * 60000, "-----BEGIN PRIVATE KEY" * 3000]
    given = spark.createDataFrame([(i, t, "a", "b") for i, t in enumerate(texts)], "doc_id long, text string, spans string, row string").repartition(4)
    rows = S.find_secrets(given).select("row.doc_id", S.as_text(S.base_spans()).alias("base"), S.as_text("spans").alias("all"), S.count_confirmed().alias("n"), *[S.count_of(k).alias(k) for k in S.KINDS]).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = plain(texts[r["doc_id"]] or "")
        assert r["base"] == ",".join(want)
        assert [s for s in r["all"].split(",") if s.split(":")[0] in S.KINDS] == want
        assert [r[k] for k in S.KINDS] == [sum(w.startswith(k) for w in want) for k in S.KINDS]
    assert sum(r["n"] for r in rows) > 500


def test_repeated_null_and_empty_tables(spark):
    given = spark.createDataFrame([(None, "token: abcdefgh1"), (None, "token: abcdefgh1")], "doc_id long, text string")
    assert [len(r["spans"]) for r in S.find_secrets(given).collect()] == [1, 1]
    assert S.find_secrets(given.limit(0)).count() == 0
