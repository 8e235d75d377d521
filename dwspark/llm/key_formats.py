"""Private keys and signed tokens told by their structure: nested DER lengths, OpenSSH fields, JSON headers."""

from __future__ import annotations

import base64
import binascii
import json

INTEGER, BITS, OCTETS, OID, SEQUENCE = 0x02, 0x03, 0x04, 0x06, 0x30
#: Bytes of a signature by algorithm; RSA signatures have the size of the key.
SIGNATURE = {"HS256": (32,), "HS384": (48,), "HS512": (64,), "ES256": (64,), "ES256K": (64,), "ES384": (96,), "ES512": (132,), "EdDSA": (64, 114)}
RSA_SIGNATURE = (128, 256, 384, 512, 1024)
OPENSSH = b"openssh-key-v1\0"


def from_base64(text: str) -> bytes | None:
    """Bytes of base64 in either alphabet, with or without its padding; None if it can't be."""
    body = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except binascii.Error:
        return None


def elements(data: bytes) -> list[tuple[int, bytes]] | None:
    """(tag, content) of the DER elements that fill ``data`` exactly, lengths in shortest form; None if they don't."""
    out, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size >= 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > len(data):
                return None
            size, at = int.from_bytes(data[at : at + n]), at + n
            if size < 0x80 or size < 1 << 8 * (n - 1):
                return None
        if at + size > len(data):
            return None
        out.append((tag, data[at : at + size]))
        at += size
    return out


def _inside(data: bytes) -> list[tuple[int, bytes]] | None:
    """Elements of the one sequence that is all of ``data``."""
    outer = elements(data) if data[:1] == b"\x30" else None
    return elements(outer[0][1]) if outer and len(outer) == 1 else None


def _numbers(parts: list[tuple[int, bytes]]) -> list[int] | None:
    return [int.from_bytes(v, signed=True) for _, v in parts] if all(t == INTEGER and v for t, v in parts) else None


def der_key(data: bytes) -> str | None:
    """Kind of the private key that ``data`` is in DER."""
    parts = _inside(data)
    if not parts:
        return None
    tags = [t for t, _ in parts]
    numbers = _numbers(parts)
    if numbers and len(numbers) >= 9 and numbers[0] in (0, 1) and numbers[1] > 0 and numbers[1] == numbers[4] * numbers[5]:
        return "rsa"
    if numbers and len(numbers) == 6 and numbers[0] == 0 and numbers[2] > 1 and (numbers[1] - 1) % numbers[2] == 0:
        return "dsa"
    if tags[:2] == [INTEGER, OCTETS] and parts[0][1] == b"\x01" and 16 <= len(parts[1][1]) <= 66 and all(t in (0xA0, 0xA1) and elements(v) for t, v in parts[2:]):
        return "ec"
    if tags[:3] == [INTEGER, SEQUENCE, OCTETS] and parts[0][1] in (b"\x00", b"\x01"):
        algorithm, held = elements(parts[1][1]), parts[2][1]
        if algorithm and algorithm[0][0] == OID:
            inner = elements(held)
            if der_key(held) or (inner and len(inner) == 1 and inner[0][0] in (OCTETS, INTEGER) and len(inner[0][1]) >= 20):
                return "pkcs8"
    if tags == [SEQUENCE, OCTETS] and parts[1][1] and len(parts[1][1]) % 8 == 0:
        algorithm = elements(parts[0][1])
        if algorithm and [t for t, _ in algorithm] == [OID, SEQUENCE]:
            return "encrypted pkcs8"
    return None


def openssh_key(data: bytes) -> str | None:
    """OpenSSH's own format: length-prefixed fields that fill the data, and two equal check numbers if it isn't encrypted."""
    at = len(OPENSSH)

    def field() -> bytes:
        nonlocal at
        size = int.from_bytes(data[at : at + 4])
        if at + 4 + size > len(data):
            raise ValueError
        at += 4 + size
        return data[at - size : at]

    try:
        cipher, _, _ = field(), field(), field()
        keys, at = int.from_bytes(data[at : at + 4]), at + 4
        if not 1 <= keys <= 64 or any(int.from_bytes(p[:4]) + 4 > len(p) for p in [field() for _ in range(keys)]):
            return None
        held = field()
    except ValueError:
        return None
    if at != len(data) or len(held) < 8 or (cipher == b"none" and held[:4] != held[4:8]):
        return None
    return "openssh"


def private_key(data: bytes) -> str | None:
    return openssh_key(data) if data.startswith(OPENSSH) else der_key(data)


def pem_key(body: str) -> str | None:
    """Kind of the key between the lines of a PEM block; encrypted ones of the old form have an IV and whole cipher blocks."""
    lines = body.replace("\\r", "").replace("\\n", "\n").split("\n")
    heads = [h.strip() for h in lines if ":" in h]
    data = from_base64("".join("".join(h.split()) for h in lines if ":" not in h))
    if not data:
        return None
    iv = next((h.rpartition(",")[2] for h in heads if h.startswith("DEK-Info:")), None)
    if iv is not None:
        try:
            size = len(bytes.fromhex(iv))
        except ValueError:
            return None
        return "encrypted" if size in (8, 16) and len(data) % size == 0 else None
    return private_key(data)


def _object(part: str) -> dict | None:
    data = from_base64(part)
    try:
        found = json.loads(data) if data else None
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def signed_token(text: str) -> str | None:
    """Algorithm of a signed (three parts) or encrypted (five parts) web token."""
    parts = text.split(".")
    head = _object(parts[0])
    algorithm = head.get("alg") if head else None
    if not isinstance(algorithm, str):
        return None
    if len(parts) == 5 and isinstance(head.get("enc"), str):
        return algorithm if all(p == "" and i == 1 or from_base64(p) for i, p in enumerate(parts)) else None
    if len(parts) != 3 or _object(parts[1]) is None:
        return None
    signature = from_base64(parts[2]) or b""
    return algorithm if len(signature) in SIGNATURE.get(algorithm, RSA_SIGNATURE if algorithm[:2] in ("RS", "PS") else ()) else None
