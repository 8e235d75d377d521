"""Operator 12: secret scan with structural confirmation.

Base patterns are reported as they are: assigned values, access key ids and
long hex runs. Besides, everything that looks encoded is decoded, and reported only
if its structure proves it:

- ``key``: a PEM block, or a bare run of base64 or hex, that decodes to a private
  key: DER whose nested lengths fit to the byte and hold the parts of such a
  key, or the fields of an OpenSSH key;
- ``token``: a web token whose header names an algorithm, whose payload is an
  object and whose signature has the algorithm's size;
- ``encoded``: a run of base64 or hex that decodes to a text with a key, token,
  access key id or assigned value in it, at most ``DEPTH`` times over.

Each text is scanned whole where it lies; nothing is shuffled. All patterns take
time linear in the text.

Defined cases: null and empty texts have no spans; repeated rows are scanned
one by one; other columns are passed through in ``row``; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwspark.llm.key_formats import from_base64, pem_key, private_key, signed_token

#: Kinds of base spans, then of those the method adds; spans of one start are in this order.
KINDS = ["assign", "access", "hex"]
ADDED = ["key", "token", "encoded"]
DEPTH = 3

# Letters of the first pattern match in either case, ASCII only.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")

PEM = re.compile(r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----((?:(?!-----).)*)-----END [A-Z0-9 ]{0,40}PRIVATE KEY-----", re.DOTALL)
# base64 of "{" and what may follow it in JSON
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])e[yw][A-Za-z0-9_-]+(?:\.[A-Za-z0-9_-]*){2,4}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{32,}={0,2}")
HEX_CANDIDATE = re.compile(r"(?:[0-9a-f]{32,}|[0-9A-F]{32,})")
TEXT = re.compile(r"[\x09\x0A\x0D\x20-\x7E\u00A0-\uFFFF]*")

Span = tuple[int, int, str, str]


def base_matches(text: str) -> list[Span]:
    """(start, end, kind, detail) of the base patterns."""
    found = [(m.start(), m.end(), "assign", m[1].lower()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), m.end(), "access", "") for m in ACCESS.finditer(text)]
    return found + [(m.start(), m.end(), "hex", "") for m in HEX.finditer(text)]


def _decoded(candidate: str) -> Iterator[bytes]:
    """What a run can be read as: hex of whole bytes, base64."""
    if len(candidate) % 2 == 0 and HEX_CANDIDATE.fullmatch(candidate):
        yield bytes.fromhex(candidate)
    data = from_base64(candidate)
    if data:
        yield data


def _holds(data: bytes, depth: int) -> str | None:
    """What secret a decoded text holds."""
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return None
    if not TEXT.fullmatch(text):
        return None
    inner = [s for s in base_matches(text) if s[2] != "hex"] + confirmed(text, depth - 1)
    return min(inner)[2] if inner else None


def confirmed(text: str, depth: int = DEPTH) -> list[Span]:
    """Keys, tokens and encoded secrets; those of one kind don't overlap."""
    found: list[Span] = []
    for m in PEM.finditer(text):
        kind = pem_key(m[1])
        if kind:
            found.append((m.start(), m.end(), "key", kind))
    blocks = [s[:2] for s in found]
    for m in TOKEN.finditer(text):
        algorithm = signed_token(m[0])
        if algorithm:
            found.append((m.start(), m.end(), "token", algorithm))
    at = 0
    for m in CANDIDATE.finditer(text):
        while at < len(blocks) and blocks[at][1] <= m.start():
            at += 1
        if at < len(blocks) and blocks[at][0] < m.end():
            continue  # inside a PEM block
        for data in _decoded(m[0]):
            kind = private_key(data)
            if kind:
                found.append((m.start(), m.end(), "key", kind))
                break
            held = _holds(data, depth) if depth > 0 else None
            if held:
                found.append((m.start(), m.end(), "encoded", held))
                break
    return found


def spans_of(text: str | None) -> list[Span]:
    """All spans by start, then kind."""
    order = {k: i for i, k in enumerate(KINDS + ADDED)}
    return sorted(base_matches(text) + confirmed(text), key=lambda s: (s[0], order[s[2]])) if text else []


def find_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows ``row`` (struct of the columns but the text) and ``spans`` (kind, start, end in code points, detail)."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*rest).alias("row"), F.col(text_col).cast("string").alias("text"))
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("detail", pa.string())])

    def scan(got: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in got:
            spans = [[{"kind": k, "start": s, "end": e, "detail": d} for s, e, k, d in spans_of(t.as_py())] for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, pa.list_(span))], names=["row", "spans"])

    return rows.mapInArrow(scan, f"row {rows.schema['row'].dataType.simpleString()}, spans array<struct<kind:string,start:int,end:int,detail:string>>")


def base_spans() -> Column:
    return F.filter("spans", lambda s: s["kind"].isin(*KINDS))


def count_of(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def count_confirmed() -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"].isin(*ADDED))).cast("long")


def as_text(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
