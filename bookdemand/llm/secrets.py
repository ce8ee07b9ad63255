"""Secrets in texts: three fixed patterns, and structures that decode and parse as keys or
signed tokens.

A candidate for a structure is a place where base64 or hex text starts like one.  Its
first bytes are decoded; only if they go on as the structure's header says is as much
decoded as the header's length asks for, and reported if every nested length and every
part is right: DER private keys (PKCS#1, PKCS#8 plain and encrypted, SEC1, DSA), OpenSSH
keys, armoured keys, signed tokens with a JSON header, and two binary token formats.
Public keys, certificates and random base64 or hex do not parse as any of them.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import struct
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The three patterns of the contract, and their least lengths.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
BASE_KINDS = ("assign", "access", "hex")

# Kinds that the parsers add, in the order in which spans of one start are listed.
KINDS = (*BASE_KINDS, "armour", "key", "jwt", "fernet", "macaroon")
RANK = {k: n for n, k in enumerate(KINDS)}

# Where a structure may start.  Base64: DER's sequence (0x30), OpenSSH's magic, the token
# version 0x80 with a time's leading zeros, a packet length of two zeros, "-----BEGIN".
BASE64_START = re.compile(r"(?<![A-Za-z0-9+/_-])(?:M[A-P]|b3BlbnNzaC1rZXktdjE|gAAAA|LS0tLS1CRUdJTi)")
HEX_START = re.compile(r"(?<![0-9A-Fa-f])(?:30(?=[ :]?[0-9A-Fa-f])|6[Ff][ :]?70[ :]?65[ :]?6[Ee][ :]?73[ :]?73[ :]?68)")
TOKEN_START = re.compile(r"(?<![A-Za-z0-9_-])e[yw][A-Za-z0-9_-]+(?:\.[A-Za-z0-9_-]*){2,4}")
FERNET = re.compile(r"(gAAAA[A-Za-z0-9_-]+)={0,2}")
ARMOUR_START = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?)-----")
DIGITS = {64: re.compile(r"[A-Za-z0-9+/_-]"), 16: re.compile(r"[0-9A-Fa-f]")}
BREAK = re.compile(r"(?:\r?\n|\\r|\\n)[ \t]*|[ :]")
CIPHER_BLOCK = {"DES": 8, "AES": 16, "CAMELLIA": 16, "IDEA": 8, "RC2": 8}

SEQUENCE, INTEGER, OCTETS, OBJECT = 0x30, 0x02, 0x04, 0x06
PASSWORD_BASED = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))  # PKCS#5 and PKCS#12 schemes
LEAST_KEY_BYTES = 16
OPENSSH = b"openssh-key-v1\0"


class Digits:
    """Bytes that base64 or hex text stands for, decoded as far as asked; line breaks, and
    between hex bytes blanks or colons, are skipped."""

    def __init__(self, text: str, start: int, base: int) -> None:
        self.text, self.at, self.base = text, start, base
        self.chars: list[str] = []
        self.ends: list[int] = []

    def take(self, n: int) -> bytes | None:
        """The first ``n`` bytes, or None where the text holds fewer."""
        need = -(-n * 4 // 3) if self.base == 64 else 2 * n
        digit = DIGITS[self.base]
        while len(self.chars) < need:
            if digit.match(self.text, self.at):
                self.chars.append(self.text[self.at])
                self.at += 1
                self.ends.append(self.at)
                continue
            gap = BREAK.match(self.text, self.at)
            if not gap or (self.base == 64 and gap[0] in " :") or not digit.match(self.text, gap.end()):
                return None
            self.at = gap.end()
        some = "".join(self.chars[:need])
        if self.base == 16:
            return bytes.fromhex(some)
        return base64.b64decode(some.replace("-", "+").replace("_", "/") + "=" * (-len(some) % 4))[:n]

    def end(self, n: int) -> int:
        """Where the text of the first ``n`` bytes ends, padding included."""
        need = -(-n * 4 // 3) if self.base == 64 else 2 * n
        end = self.ends[need - 1]
        while self.base == 64 and need % 4 and self.text[end:end + 1] == "=":
            end, need = end + 1, need + 1
        return end


# ---------------------------------------------------------------- key encodings

def header(data: bytes, at: int) -> tuple[int, int, int] | None:
    """(tag, start, end) of the DER element at ``at``; lengths must be definite and shortest."""
    if at + 2 > len(data):
        return None
    tag, size, start = data[at], data[at + 1], at + 2
    if tag & 31 == 31:
        return None
    if size >= 0x80:
        n = size & 0x7F
        if not 1 <= n <= 4 or start + n > len(data) or data[start] == 0:
            return None
        size, start = int.from_bytes(data[start:start + n], "big"), start + n
        if size < 0x80:
            return None
    return tag, start, start + size


def elements(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill ``data[start:end]`` exactly, or None."""
    out = []
    while start < end:
        found = header(data, start)
        if found is None or found[2] > end:
            return None
        out.append(found)
        start = found[2]
    return out


def private_key(data: bytes) -> bool:
    """Is this one DER element that encodes a private key?"""
    top = elements(data, 0, len(data))
    if not top or len(top) != 1 or top[0][0] != SEQUENCE:
        return False
    parts = elements(data, *top[0][1:]) or []
    tags = [p[0] for p in parts]
    body = [data[a:b] for _, a, b in parts]

    def algorithm(k: int) -> bytes:
        """The object identifier that starts the sequence in part ``k``."""
        inner = elements(data, *parts[k][1:])
        return data[inner[0][1]:inner[0][2]] if inner and inner[0][0] == OBJECT else b""

    if tags[:2] == [SEQUENCE, OCTETS] and len(tags) == 2:
        return len(body[1]) >= LEAST_KEY_BYTES and algorithm(0).startswith(PASSWORD_BASED)
    if tags[:1] != [INTEGER] or body[0] not in (b"\0", b"\1"):
        return False
    if tags[1:3] == [SEQUENCE, OCTETS] and all(t in (0xA0, 0x81, 0xA1) for t in tags[3:]):
        return len(body[2]) >= LEAST_KEY_BYTES and bool(algorithm(1))
    if tags[1:2] == [OCTETS] and body[0] == b"\1":
        return len(body[1]) >= LEAST_KEY_BYTES and all(t in (0xA0, 0xA1) for t in tags[2:]) and all(
            elements(data, a, b) for _, a, b in parts[2:])
    numbers = tags[:9] == [INTEGER] * 9 and (len(tags) == 9 or tags[9:] == [SEQUENCE]) or tags == [INTEGER] * 6
    return numbers and all(body) and sum(map(len, body)) >= 2 * LEAST_KEY_BYTES


def openssh_size(take: Callable[[int], bytes | None]) -> int | None:
    """Bytes of an OpenSSH private key: magic, then strings and numbers whose lengths nest."""
    at = len(OPENSSH)

    def skip() -> bytes | None:
        nonlocal at
        head = take(at + 4)
        n = struct.unpack(">I", head[at:at + 4])[0] if head else 1 << 31
        data = take(at + 4 + n) if n < 1 << 31 else None
        at += 4 + n
        return None if data is None else data[at - n:at]

    if take(at) != OPENSSH or not (cipher := skip()) or not re.fullmatch(rb"[a-z0-9@.-]+", cipher) or not skip() or skip() is None:
        return None
    count = take(at + 4)
    count = struct.unpack(">I", count[at:at + 4])[0] if count else 0
    at += 4
    if count < 1 or any(not skip() for _ in range(count)):
        return None
    secret = skip()
    return at if secret and len(secret) >= LEAST_KEY_BYTES and (cipher != b"none" or secret[:4] == secret[4:8]) else None


def key_size(take: Callable[[int], bytes | None]) -> int | None:
    """Bytes of the private key that starts the data, or None if none does."""
    first = take(6)
    if first is None:
        return None
    if first == OPENSSH[:6]:
        return openssh_size(take)
    found = header(first, 0)
    # the first part must be a version number or an algorithm before all of it is decoded
    if not found or found[0] != SEQUENCE:
        return None
    inner = take(min(found[1] + 2, found[2]))
    if inner is None or inner[found[1]:found[1] + 1] not in (b"\x02", b"\x30"):
        return None
    if inner[found[1]] == INTEGER and inner[found[1] + 1:] != b"\x01":
        return None
    data = take(found[2])
    return found[2] if data is not None and private_key(data) else None


def pgp_secret(data: bytes) -> bool:
    """Does OpenPGP data start with a secret-key packet (tag 5) whose length fits?"""
    if len(data) < 8 or not data[0] & 0x80:
        return False
    if data[0] & 0x40:
        tag, first = data[0] & 0x3F, data[1]
        start, size = (2, first) if first < 192 else (3, ((first - 192) << 8) + data[2] + 192) if first < 224 else (6, int.from_bytes(data[2:6], "big"))
    else:
        tag, width = (data[0] >> 2) & 15, 1 << (data[0] & 3)
        if width > 4:
            return False
        start, size = 1 + width, int.from_bytes(data[1:1 + width], "big")
    return tag == 5 and LEAST_KEY_BYTES <= size <= len(data) - start and data[start] in (3, 4, 5, 6)


def armoured(label: str, body: str) -> bool:
    """Does the text between an armour's marks decode to the private key that it names?"""
    lines = [x.strip() for x in re.split(r"\r?\n|\\r|\\n", body)]
    fields = dict(x.split(":", 1) for x in lines if ":" in x)
    text = "".join(x for x in lines if ":" not in x)
    if label.endswith("BLOCK"):
        text = re.sub(r"=[A-Za-z0-9+/]{4}$", "", text)  # the checksum line
    try:
        data = base64.b64decode(re.sub(r"[ \t]", "", text), validate=True)
    except binascii.Error:
        return False
    if label.endswith("BLOCK"):
        return pgp_secret(data)
    if "ENCRYPTED" in fields.get("Proc-Type", ""):
        cipher, _, vector = fields.get("DEK-Info", "").strip().partition(",")
        block = CIPHER_BLOCK.get(cipher.split("-")[0])
        return bool(block and re.fullmatch(r"[0-9A-Fa-f]{16,}", vector) and data and len(data) % block == 0)
    return key_size(lambda n: data[:n] if n <= len(data) else None) == len(data)


# ---------------------------------------------------------------- tokens

def json_part(segment: str) -> dict | None:
    """The JSON object that a token's base64url segment holds."""
    try:
        value = json.loads(base64.urlsafe_b64decode(segment + "=" * (-len(segment) % 4)))
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def token_end(found: re.Match) -> int | None:
    """Where the signed (three segments) or encrypted (five) token ends, or None."""
    segments = found[0].split(".")
    head = json_part(segments[0])
    if not head or not isinstance(head.get("alg"), str) or not head["alg"]:
        return None
    if isinstance(head.get("enc"), str):
        return found.end() if len(segments) == 5 and all(segments[2:]) else None
    if json_part(segments[1]) is None or not segments[2] and head["alg"].lower() != "none":
        return None
    return found.start() + len(".".join(segments[:3]))


def fernet_end(text: str, start: int) -> int | None:
    """Where a token of version, time, vector, whole cipher blocks and a 32-byte signature ends."""
    found = FERNET.match(text, start)
    if not found or len(found[1]) % 4 == 1:
        return None
    data = base64.urlsafe_b64decode(found[1] + "=" * (-len(found[1]) % 4))
    seconds = int.from_bytes(data[1:9], "big")  # in the years 2000 to 2099
    return found.end() if len(data) >= 73 and len(data) % 16 == 73 % 16 and 946_684_800 <= seconds < 4_102_444_800 else None


def macaroon_size(digits: Digits) -> int | None:
    """Bytes of packets "four hex digits of length, name, blank, value, line end" up to the signature's."""
    at, first = 0, True
    while True:
        head = digits.take(at + 4)
        if head is None or not re.fullmatch(rb"[0-9a-f]{4}", head[at:]) or (n := int(head[at:], 16)) < 7:
            return None
        packet = digits.take(at + n)
        name, blank, value = (packet or b"")[at + 4:].partition(b" ")
        if not blank or not value.endswith(b"\n") or (first and name != b"location") or not re.fullmatch(rb"[a-z]+", name):
            return None
        at, first = at + n, False
        if name == b"signature":
            return at if len(value) == 33 else None


# ---------------------------------------------------------------- spans

def base_spans(text: str) -> Iterator[tuple[str, int, int]]:
    for m in ASSIGN.finditer(text):
        if len(m[2]) >= LEAST_VALUE:
            yield "assign", *m.span()
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if len(m[0]) >= LEAST_ACCESS:
                yield "access", *m.span()
    for m in HEX_LONG.finditer(text):
        yield "hex", *m.span()


# A greedy run of at least 24 is the same match as a run that is then found long enough.
HEX_LONG = re.compile(rf"{HEX.pattern[:-1]}{{{LEAST_HEX},}}")


def confirmed_spans(text: str) -> Iterator[tuple[str, int, int]]:
    """Spans whose decoded bytes parse; of one kind they do not overlap, and the key inside
    an armour is not listed again."""
    at, armours = 0, []
    while "-----BEGIN " in text and (m := ARMOUR_START.search(text, at)):
        stop, close = text.find("-----", m.end()), f"-----END {m[1]}-----"
        at = m.end()
        if stop >= 0 and text.startswith(close, stop) and armoured(m[1], text[m.end():stop]):
            at = stop + len(close)
            armours.append((m.start(), at))
            yield "armour", m.start(), at
    for m in TOKEN_START.finditer(text):
        if end := token_end(m):
            yield "jwt", m.start(), end
    done = dict.fromkeys(KINDS, 0)
    for base, starts in ((64, BASE64_START), (16, HEX_START)):
        for m in starts.finditer(text):
            start = m.start()
            k = bisect_right(armours, (start, len(text)))
            if k and start < armours[k - 1][1]:
                continue
            kind, end = structure(text, start, base)
            if end and start >= done[kind]:
                done[kind] = end
                yield kind, start, end


def structure(text: str, start: int, base: int) -> tuple[str, int | None]:
    """Kind and end of the key or binary token that starts at ``start``; no end: there is none."""
    if base == 64 and text.startswith("gAAAA", start):
        return "fernet", fernet_end(text, start)
    digits = Digits(text, start, base)
    if base == 64 and text.startswith("LS0", start):
        size = wrapped_size(digits)
        return "key", size and digits.end(size)
    if size := key_size(digits.take):
        return "key", digits.end(size)
    size = macaroon_size(digits) if base == 64 and text.startswith("MDA", start) else None
    return "macaroon", size and digits.end(size)


def wrapped_size(digits: Digits) -> int | None:
    """Bytes of armoured key text that is itself in base64."""
    step = 48
    while digits.take(step) is not None:
        step *= 2
    n = len(digits.chars) * 3 // 4
    inner = (digits.take(n) or b"").decode("latin-1")
    found = ARMOUR_START.match(inner)
    stop = inner.find("-----", found.end()) if found else -1
    close = f"-----END {found[1]}-----" if found else ""
    return stop + len(close) if stop >= 0 and inner.startswith(close, stop) and armoured(found[1], inner[found.end():stop]) else None


def all_spans(text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and all spans; each by start, then kind as listed."""
    if not text:
        return [], []
    base = list(base_spans(text))
    return tuple(sorted(s, key=lambda x: (x[1], RANK[x[0]])) for s in (base, base + list(confirmed_spans(text))))


def _join(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: doc_id, the number of base spans of each kind
    (n_assign, n_access, n_hex), n_confirmed, base_spans and spans (kind:start:end joined by
    commas, code points) and ``found``, an array of (kind, sha256 of the span's text), in
    which no secret is readable.  Null and empty texts have none; repeated rows and null ids
    come out as they came in; other columns are not read."""
    counts = [f"n_{k}" for k in BASE_KINDS]
    schema = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in counts), ("n_confirmed", pa.int64()), ("base_spans", pa.string()), ("spans", pa.string()),
                        ("found", pa.list_(pa.struct([("kind", pa.string()), ("digest", pa.string())])))])

    def row(doc_id, text: str | None) -> dict:
        base, spans = all_spans(text)
        return {"doc_id": doc_id, **{f"n_{k}": sum(s[0] == k for s in base) for k in BASE_KINDS}, "n_confirmed": len(spans) - len(base),
                "base_spans": _join(base), "spans": _join(spans),
                "found": [{"kind": k, "digest": hashlib.sha256(text[a:b].encode()).hexdigest()} for k, a, b in spans]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pylist([row(d, t.as_py()) for d, t in zip(batch.column(0).to_pylist(), batch.column(1))], schema)

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in counts)
                           + ", n_confirmed long, base_spans string, spans string, found array<struct<kind:string,digest:string>>")


def inventory(found: DataFrame) -> DataFrame:
    """(kind, digest, n_rows, n_spans) of the secrets in :func:`find`'s result: a secret that
    a third of all rows hold is counted in every task before rows are shuffled."""
    each = found.select("found", F.explode(F.array_distinct("found")).alias("x"))
    return each.select("x.*", F.size(F.filter("found", lambda y: y == F.col("x"))).alias("n")).groupBy("kind", "digest").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("n").alias("n_spans"))
