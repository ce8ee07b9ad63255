"""Secret scans: fixed patterns by brute force, structures by keys made with the usual tools."""

import base64
import hashlib
import json
import random
import re
import shutil
import subprocess

import pytest

from bookdemand.llm import secrets
from bookdemand.llm.base import table
from bookdemand.llm.queries import QUERIES

from conftest import SF001

WORDS = "Maple MAPS 30 300 45 token = x eyes MDAx 30:82:01 password gAAAA LS0tLS1CRUdJTi b3BlbnNzaC1rZXktdjE AKIA deadbeef" .split()


def plain_base(text):
    """The contract's patterns, read word for word."""
    out = []
    letters = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in "(password|passwd|secret|token|api_?key)")
    for m in re.finditer(letters + r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text or ""):
        out += [("assign", *m.span())] if len(m[2]) >= 6 else []
    out += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text or "") if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0])))


def der(tag, *parts):
    body = b"".join(parts)
    n = len(body)
    size = bytes([n]) if n < 128 else bytes([0x80 | (k := (n.bit_length() + 7) // 8)]) + n.to_bytes(k, "big")
    return bytes([tag]) + size + body


def number(n):
    return der(2, n.to_bytes(n.bit_length() // 8 + 1, "big"))


def url64(data):
    return base64.urlsafe_b64encode(data).decode().rstrip("=")


PICK = random.Random(11)
RSA = der(0x30, number(0), *(number(PICK.getrandbits(n)) for n in (1024, 17, 1024, 512, 512, 512, 512, 512)))
PUBLIC = der(0x30, der(0x30, der(6, bytes.fromhex("2a864886f70d010101")), der(5)), der(3, b"\0" + der(0x30, number(PICK.getrandbits(1024)), number(65537))))
PKCS8 = der(0x30, number(0), der(0x30, der(6, bytes.fromhex("2a864886f70d010101")), der(5)), der(4, RSA))
SEC1 = der(0x30, number(1), der(4, PICK.randbytes(32)), der(0xA0, der(6, bytes.fromhex("2a8648ce3d030107"))))
LOCKED = der(0x30, der(0x30, der(6, bytes.fromhex("2a864886f70d01050d")), der(0x30)), der(4, PICK.randbytes(64)))
JWT = ".".join([url64(json.dumps({"alg": "HS256", "typ": "JWT"}).encode()), url64(b'{"sub":"1"}'), url64(PICK.randbytes(32))])
JWE = ".".join([url64(b'{"alg":"dir","enc":"A256GCM"}'), "", url64(PICK.randbytes(12)), url64(PICK.randbytes(50)), url64(PICK.randbytes(16))])
FERNET = base64.urlsafe_b64encode(b"\x80" + (1_700_000_000).to_bytes(8, "big") + PICK.randbytes(16 + 32 + 32)).decode()
PACKETS = [b"location http://x\n", b"identifier abc\n", b"signature " + PICK.randbytes(32) + b"\n"]
MACAROON = base64.urlsafe_b64encode(b"".join(b"%04x" % (len(p) + 4) + p for p in PACKETS)).decode()


def pem(label, data, width=64):
    text = base64.b64encode(data).decode()
    return f"-----BEGIN {label}-----\n" + "\n".join(text[k:k + width] for k in range(0, len(text), width)) + f"\n-----END {label}-----"


def added(text):
    return [(k, text[a:b]) for k, a, b in secrets.all_spans(text)[1] if k not in secrets.BASE_KINDS]


@pytest.mark.parametrize("kind, value", [
    ("key", base64.b64encode(RSA).decode()), ("key", base64.b64encode(PKCS8).decode()), ("key", base64.urlsafe_b64encode(SEC1).decode()),
    ("key", base64.b64encode(LOCKED).decode()), ("key", RSA.hex()), ("key", SEC1.hex().upper()), ("key", SEC1.hex(":")), ("key", SEC1.hex(" ")),
    ("armour", pem("RSA PRIVATE KEY", RSA)), ("armour", pem("PRIVATE KEY", PKCS8)), ("armour", pem("EC PRIVATE KEY", SEC1).replace("\n", "\\n")),
    ("armour", pem("ENCRYPTED PRIVATE KEY", LOCKED).replace("\n", "\r\n")),
    ("key", base64.b64encode((pem("PRIVATE KEY", PKCS8) + "\n").encode()).decode()),
    ("jwt", JWT), ("jwt", JWE), ("fernet", FERNET), ("macaroon", MACAROON)])
def test_structures_are_found_whole(kind, value):
    for before, after in (("", ""), ("é ", " word"), ("key=\"", "\"\n"), ("a\n", "\nnext line"), ("Bearer ", ". Then"), ("(", ")")):
        got = added(before + value + after)
        assert [k for k, _ in got] == [kind]
        assert got[0][1] == value or value.startswith(got[0][1])  # base64 of armour may end in a line end
        assert len(got[0][1]) >= len(value) - 2


def test_what_does_not_parse_is_not_reported():
    flat = base64.b64encode(RSA).decode()
    wrong = [
        base64.b64encode(PUBLIC).decode(), pem("PUBLIC KEY", PUBLIC), pem("CERTIFICATE", PUBLIC), flat[:-8], flat[:40], RSA.hex()[:-2],
        pem("PRIVATE KEY", PUBLIC), pem("RSA PRIVATE KEY", RSA[:-1]),
        base64.b64encode(RSA[:5] + b"\x03" + RSA[6:]).decode(), JWT.rsplit(".", 1)[0], JWT.replace(JWT.split(".")[0], url64(b'{"typ":"JWT"}')),
        JWE.rsplit(".", 1)[0], FERNET[:-8], FERNET.replace("gAAAAA", "gAAAAP"), MACAROON[:-8], "eyJhbGciOiJub25lIn0", "30" * 400, "M" + "A" * 4000,
        base64.b64encode(PICK.randbytes(3000)).decode(), PICK.randbytes(3000).hex(), "x" * 40,
    ]
    for text in wrong:
        assert added(text) == [], text[:60]
    # an armour that does not fit is none, but the whole key inside it is a key
    for text in (pem("RSA PRIVATE KEY", RSA + b"\0\0\0"), pem("RSA PRIVATE KEY", RSA).replace("END RSA", "END EC")):
        assert [k for k, _ in added(text)] == ["key"]


def test_random_words_never_confirm():
    for seed in range(300):
        pick = random.Random(seed)
        text = pick.choice(["", " ", "\n"]).join(pick.choice(WORDS) for _ in range(80))
        assert added(text) == []
        assert secrets.all_spans(text)[0] == plain_base(text)


@pytest.mark.skipif(not (shutil.which("openssl") and shutil.which("ssh-keygen")), reason="needs the key tools")
def test_keys_of_the_usual_tools(tmp_path):
    def run(*command):
        return subprocess.run(command, capture_output=True, check=True, cwd=tmp_path, timeout=60).stdout.decode()

    made = {name: run("openssl", *command.split()) for name, command in {
        "pkcs8": "genpkey -algorithm RSA -pkeyopt rsa_keygen_bits:1024", "rsa": "genrsa -traditional 1024", "ec": "ecparam -name prime256v1 -genkey -noout",
        "ed": "genpkey -algorithm ed25519", "legacy": "genrsa -traditional -aes128 -passout pass:abcd 1024",
        "locked": "genpkey -algorithm RSA -pkeyopt rsa_keygen_bits:1024 -aes256 -pass pass:abcd"}.items()}
    for kind, words in (("ed25519", "x"), ("ecdsa", "")):
        run("ssh-keygen", "-q", "-t", kind, "-N", words and "long pass", "-f", f"{tmp_path}/{kind}")
        made[f"ssh-{kind}"] = (tmp_path / kind).read_text()
        public = (tmp_path / f"{kind}.pub").read_text()
        assert added(public) == []
    for name, text in made.items():
        assert added("see\n" + text + "end") == [("armour", text.rstrip("\n"))], name
        body = "".join(x for x in text.splitlines() if "-----" not in x)
        if name != "legacy":
            assert [k for k, _ in added(body)] == ["key"], name
            assert [k for k, _ in added(base64.b64decode(body).hex())] == ["key"], name
    (tmp_path / "pkcs8").write_text(made["pkcs8"])
    assert added(run("openssl", "pkey", "-in", "pkcs8", "-pubout")) == []


def test_find_and_inventory(spark):
    odd = [None, "", " ", "\x00", "TOKEN='abc.def' toKen:12345", "api-key=123456 apikey = 123456 API_KEY:\"123456\"", "ſecret=1234567 paſſword=1234567 toKen=1234567",
           "AKIA" + "Z9" * 8, "AKIAAKIA" + "A" * 30, "f" * 23 + "g" + "f" * 24, "token=" + "a1" * 20_000, "é" * 9 + JWT, "password" * 3000, "secret" + " " * 3000, JWT]
    rows = [(k, t, "clash", "clash") for k, t in enumerate(odd)] + [(None, JWT, "", ""), (14, JWT, "", ""), (14, JWT, "", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kind string, found string")
    found = secrets.find(docs)
    got = sorted(((r["doc_id"], r["base_spans"], r["spans"], r["n_assign"], r["n_access"], r["n_hex"], r["n_confirmed"]) for r in found.collect()), key=repr)
    join = lambda spans: ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    want = []
    for doc_id, text, *_ in rows:
        base, spans = plain_base(text), secrets.all_spans(text)[1]
        want.append((doc_id, join(base), join(spans), *(sum(s[0] == k for s in base) for k in secrets.BASE_KINDS), len(spans) - len(base)))
        assert [s for s in spans if s[0] in secrets.BASE_KINDS] == base
    assert got == sorted(want, key=repr)
    held = {(r["kind"], r["digest"]): (r["n_rows"], r["n_spans"]) for r in secrets.inventory(found).collect()}
    assert held["jwt", hashlib.sha256(JWT.encode()).hexdigest()] == (5, 5)
    assert secrets.find(docs.limit(0)).collect() == []


def test_query_equals_the_plain_patterns(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF001, "documents").collect()}
    rows = QUERIES["op13_secrets"](spark, SF001).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain_base(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(s[0] == k for s in base) for k in secrets.BASE_KINDS)
