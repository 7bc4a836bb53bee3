r"""Secret scans with structural confirmation (operator 8).

Base patterns (assignments, access keys, long hex strings) are reported as they match.  The method adds
spans only where decoding proves structure:

* ``pem``    a PEM block whose body is base64 of one whole DER value (nested lengths add up) or an OpenSSH key, or that
             its header lines call encrypted and whose body is whole cipher blocks; a PGP private key block whose
             checksum holds and whose first packet is a secret key
* ``der``    a base64 string, in one or more lines, that decodes to a DER sequence holding a key: nested lengths add
             up exactly and a known key algorithm, two big integers or a bare elliptic curve key (SEC1) is inside
* ``ssh``    a base64 string of length-prefixed fields that starts with a known key type and ends exactly
* ``jwt``    three base64url parts, the first a JSON object with "alg", the second a JSON object; or five (an encrypted
             token), the first a JSON object with "alg" and "enc"
* ``hexkey`` a hex string that decodes to such a DER sequence or length-prefixed key

A base64 or hex string that decodes to ASCII text is scanned again, two layers deep; what is confirmed inside is
reported with its kind and the span of the outer string.

Line ends may be written as such or escaped (a backslash and a letter, as in JSON and environment files).

Candidates are found over the whole text, never cut to a prefix.  Patterns have one quantified class after
a literal or character class, so matching is linear; a key over several lines is read as far as its own lengths say, an
OpenSSH key (whose first line tells no length) up to ``MAX_KEY`` characters, so many starts cost no more than that each.

Defined results: a null text is empty; equal rows give equal results; an empty table gives an empty result;
null ids and other columns pass through untouched.  Spans are code points, end exclusive.
"""

from __future__ import annotations

import base64
import binascii
import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: kinds in the order that breaks ties between spans of one start
KINDS = ("assign", "access", "hex", "pem", "der", "ssh", "jwt", "hexkey")

ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG_HEX = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{32,}(?![0-9A-Fa-f])")
BASE64 = re.compile(r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{32,}={0,2}(?![A-Za-z0-9+/=])")
TOKEN = re.compile(r"(?<![A-Za-z0-9])eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
SEALED = re.compile(r"(?<![A-Za-z0-9])eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+")
PGP = re.compile(r"-----BEGIN PGP PRIVATE KEY BLOCK-----((?:[^-]|-(?!----))*+)-----END PGP PRIVATE KEY BLOCK-----")
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY|[A-Z0-9 ]*PUBLIC KEY|CERTIFICATE)-----((?:[^-]|-(?!----))*+)-----END \1-----")
#: what a key in base64 starts with: a DER sequence, an SSH key type, an OpenSSH private key
KEY_START = re.compile(r"(?:M[A-P]|AAAAB3NzaC1|AAAAC3NzaC1|AAAAE2VjZHNh|b3BlbnNzaC1rZXk)[A-Za-z0-9+/]{6,}+")
BASE64_LINE = re.compile(r"([A-Za-z0-9+/]++)(={0,2})")
LINE_END = re.compile(r"[ \t]*+(?:\\++[rn]|[\r\n])++[ \t]*+")
ESCAPED_END = re.compile(r"\\+[rn]")

#: DER object identifiers of key algorithms (fixed values): RSA, RSAES-OAEP, RSASSA-PSS, EC, Ed25519, Ed448, X25519, X448, DSA, DH (two),
#: ML-DSA and ML-KEM (three each), and encrypted keys by PBES2, PBES1 (six) and PKCS 12 (six)
KEY_OIDS = tuple(bytes.fromhex(x) for x in (
    "06092a864886f70d010101", "06092a864886f70d010107", "06092a864886f70d01010a", "06072a8648ce3d0201", "06032b6570", "06032b6571", "06032b656e", "06032b656f",
    "06072a8648ce380401", "06092a864886f70d010301", "06072a8648ce3e0201", *(f"06096086480165030403{n}" for n in ("11", "12", "13")),
    *(f"06096086480165030404{n}" for n in ("01", "02", "03")), "06092a864886f70d01050d", *(f"06092a864886f70d0105{n}" for n in ("01", "03", "04", "06", "0a", "0b")),
    *(f"060a2a864886f70d010c010{n}" for n in range(1, 7))))
#: key types of the SSH wire format (fixed values)
SSH_TYPES = (b"ssh-rsa", b"ssh-dss", b"ssh-ed25519", b"ecdsa-sha2-nistp256", b"ecdsa-sha2-nistp384", b"ecdsa-sha2-nistp521")
SSH_MAGIC = b"openssh-key-v1\x00"
#: fields of an SSH public key by its type (fixed values)
SSH_FIELDS = dict(zip(SSH_TYPES, (3, 5, 2, 3, 3, 3)))
#: longest key in base64 that is followed over lines, in characters, and longest field of an SSH key, in bytes
MAX_KEY, MAX_FIELD = 1 << 16, 1 << 13
#: layers of base64 or hex around a key
LAYERS = 2


def der_items(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, content start, content end) of the DER values that fill data[start:end] exactly, else None."""
    items = []
    while start < end:
        if end - start < 2:
            return None
        tag, n, at = data[start], data[start + 1], start + 2
        if n >= 0x80:
            size = n & 0x7F
            if not 1 <= size <= 4 or at + size > end:
                return None
            n = int.from_bytes(data[at:at + size], "big")
            at += size
        if at + n > end:
            return None
        items.append((tag, at, at + n))
        start = at + n
    return items


def is_der_key(data: bytes) -> bool:
    """One DER sequence, all nested lengths exact, that holds a known key algorithm or two or more big integers, or is a SEC1 key."""
    top = der_items(data, 0, len(data)) if data[:1] == b"\x30" else None
    if not top or len(top) != 1:
        return False
    big, known, todo = 0, False, [top[0]]
    while todo:
        tag, s, e = todo.pop()
        if tag in (0x30, 0x31) or tag in (0xA0, 0xA1):
            inner = der_items(data, s, e)
            if inner is None:
                return False
            todo += inner
        elif tag == 0x02:
            big += e - s >= 8
        elif tag == 0x06:
            known = known or any(x[2:] == data[s:e] for x in KEY_OIDS)
    return known or big >= 2 or is_sec1(data, der_items(data, *top[0][1:]))


def is_sec1(data: bytes, items: list[tuple[int, int, int]]) -> bool:
    """Version 1, an octet string as long as a curve's number, then nothing but the curve [0] and the public key [1]."""
    return (len(items) >= 2 and items[0][0] == 0x02 and data[items[0][1]:items[0][2]] == b"\x01" and items[1][0] == 0x04
            and 14 <= items[1][2] - items[1][1] <= 72 and [t for t, _, _ in items[2:]] in ([0xA0], [0xA1], [0xA0, 0xA1], []))


def is_ssh_key(data: bytes) -> bool:
    """Length-prefixed fields that start with a known key type and fill the data, or an OpenSSH private key."""
    if data.startswith(SSH_MAGIC):
        n = int.from_bytes(data[15:19], "big")
        return 0 < n <= 64 and data[19:19 + n].isascii() and len(data) > 19 + n + 8
    at, fields = 0, []
    while at + 4 <= len(data):
        n = int.from_bytes(data[at:at + 4], "big")
        if at + 4 + n > len(data):
            return False
        fields.append(data[at + 4:at + 4 + n])
        at += 4 + n
    return at == len(data) and len(fields) >= 2 and fields[0] in SSH_TYPES


def decoded(text: str, url: bool = False) -> bytes | None:
    try:
        text += "=" * (-len(text) % 4)
        return base64.urlsafe_b64decode(text) if url else base64.b64decode(text, validate=True)
    except (binascii.Error, ValueError):
        return None


def ssh_length(data: bytes) -> int | None:
    """Bytes of the SSH public key that ``data`` begins with; if that many must be read to tell more, minus that number; None if it is no such key."""
    at, fields = 0, 1
    while fields:
        if at + 4 > len(data):
            return -at - 4
        n = int.from_bytes(data[at:at + 4], "big")
        if n > MAX_FIELD:
            return None
        if not at:
            if len(data) < 4 + n:
                return -4 - n
            fields = SSH_FIELDS.get(data[4:4 + n])
            if fields is None:
                return None
        at, fields = at + 4 + n, fields - 1
    return at


def is_pgp_private(body: str) -> bool:
    """Armor whose CRC-24 holds around packets that begin with a secret key or subkey."""
    lines = [x.strip() for x in ESCAPED_END.sub("\n", body).replace("\\/", "/").split("\n")]
    lines = [x for x in lines if x and ": " not in x]
    if len(lines) < 2 or not lines[-1].startswith("="):
        return False
    data, check = decoded("".join(lines[:-1]).rstrip("=")), decoded(lines[-1][1:])
    if not data or not check or len(check) != 3:
        return False
    crc = 0xB704CE
    for b in data:
        crc ^= b << 16
        for _ in range(8):
            crc = crc << 1 ^ (0x1864CFB if crc & 0x800000 else 0)
    tag = data[0] & 0x3F if data[0] & 0x40 else data[0] >> 2 & 0x0F
    return crc & 0xFFFFFF == int.from_bytes(check, "big") and bool(data[0] & 0x80) and tag in (5, 7)


def wrapped_key(text: str, start: int) -> tuple[str, int] | None:
    """Kind and end of a key in base64 that begins at ``start`` and may go on over several lines."""
    need = None
    if text[start] == "M":
        head = decoded(text[start:start + 8])
        size = head[1] & 0x7F if head[1] >= 0x80 else 0
        if size > 4:
            return None
        need = -(-(int.from_bytes(head[2:2 + size], "big") + 2 + size if size else head[1] + 2) * 4 // 3)  # base64 characters
        if need > len(text) - start:
            return None
    parts, have, at, width = [], 0, start, None
    public, known = text[start] == "A", -4
    while m := BASE64_LINE.match(text, at, start + MAX_KEY if need is None else len(text)):
        n = len(m[1])
        if public and need is None and (have + n) // 4 * 3 >= -known:
            # the lengths of the fields read so far say how far the key goes
            known = ssh_length(decoded("".join([*parts, m[1]])[:(have + n) // 4 * 4]) or b"")
            if known is None:
                return None
            need = -(-known * 4 // 3) if known > 0 else None
        if need is None and width and len(parts) > 1 and n > width:
            break  # longer than the lines before: not of the key
        parts.append(m[1])
        have, end = have + n, m.end()
        if m[2] or (need is not None and have >= need) or (need is None and width and n < width):
            break
        if len(parts) > 1:
            width = width or n
        sep = LINE_END.match(text, end)
        if not sep:
            break
        at = sep.end()
    if text[end:end + 1] == "=" or (need is not None and have != need):
        return None
    data = decoded("".join(parts))
    if data and text[start] == "M":
        return ("der", end) if is_der_key(data) else None
    return ("ssh", end) if data and is_ssh_key(data) else None


def is_pem(body: str) -> bool:
    """Base64 of one whole DER value or an OpenSSH key, or cipher blocks under a header that says so."""
    body = ESCAPED_END.sub("\n", body).replace("\\/", "/")
    plain = re.sub(r"(?m)^[ \t\"']*[A-Za-z0-9-]+:.*$", "", body)
    data = decoded(re.sub(r"[\s\"',]+", "", plain).rstrip("="))
    if not data:
        return False
    if plain != body and re.search(r"(?m)^[ \t\"']*Proc-Type:[ \t]*4,[ \t]*ENCRYPTED", body) and "DEK-Info:" in body:
        return len(data) % 8 == 0
    top = der_items(data, 0, len(data))
    return bool(top and len(top) == 1) or is_ssh_key(data)


def is_json_object(part: str, key: str | None = None) -> bool:
    try:
        value = json.loads(decoded(part, url=True) or b"")
    except (ValueError, RecursionError):
        return False
    return isinstance(value, dict) and (key is None or key in value)


def key_inside(data: bytes, layer: int) -> str | None:
    """Kind of the key that decoded bytes are, or hold as text under another layer."""
    if is_der_key(data):
        return "der"
    if is_ssh_key(data):
        return "ssh"
    if layer < LAYERS and data.isascii():
        found = confirmed(data.decode("ascii"), layer + 1)
        return min(found, key=lambda x: (x[1], -x[2], KINDS.index(x[0])))[0] if found else None  # the outermost
    return None


def confirmed(text: str, layer: int = 1) -> list[tuple[str, int, int]]:
    """Spans proved by decoding."""
    found = []
    for m in BASE64.finditer(text):
        data = decoded(m[0].rstrip("="))
        if data and (kind := key_inside(data, layer)):
            found.append((kind, *m.span()))
    single, done = {x[1:] for x in found}, 0
    for m in KEY_START.finditer(text):
        s = m.start()
        # the start of its run: after no base64 character, unless that is the letter of an escaped line end
        if s < done or (s and (text[s - 1].isascii() and text[s - 1].isalnum() or text[s - 1] in "+/") and not ESCAPED_END.fullmatch(text, max(0, s - 2), s)):
            continue
        if key := wrapped_key(text, s):
            done = key[1]
            if (s, done) not in single:
                found.append((key[0], s, done))
    if "-----BEGIN " in text:
        found += [("pem", *m.span()) for m in PEM.finditer(text) if is_pem(m[2])]
        found += [("pem", *m.span()) for m in PGP.finditer(text) if is_pgp_private(m[1])]
    if "eyJ" in text:
        sealed = [m.span() for m in SEALED.finditer(text) if is_json_object(m[0].split(".", 1)[0], "alg") and is_json_object(m[0].split(".", 1)[0], "enc")]
        found += [("jwt", *x) for x in sealed]
        for m in TOKEN.finditer(text):
            head, body, _ = m[0].split(".")
            if is_json_object(head, "alg") and is_json_object(body):
                found.append(("jwt", *m.span()))
    for m in LONG_HEX.finditer(text):
        if len(m[0]) % 2 == 0:
            data = bytes.fromhex(m[0])
            if kind := "hexkey" if is_der_key(data) or is_ssh_key(data) else key_inside(data, layer):
                found.append((kind, *m.span()))
    return found


def scan(text: str) -> list[tuple[str, int, int]]:
    """All confirmed spans (kind, start, end) by start, then kind."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", *m.span()) for m in HEX.finditer(text) if m.end() - m.start() >= 24]
    return sorted(found + confirmed(text), key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


SPANS = "array<struct<kind:string,start:long,end:long>>"


def spans(text: Column) -> Column:
    """Array of (kind, start, end) of a text column."""
    @F.pandas_udf(SPANS)
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"kind": k, "start": s, "end": e} for k, s, e in scan(t or "")] for t in texts], dtype=object)

    return of(text)


def redact(text: str, found: list[tuple[str, int, int]]) -> str:
    """The text with every reported span, overlapping ones as one, replaced by [REDACTED:kind]."""
    out, at, group = [], 0, None
    for kind, s, e in [*found, ("", len(text) + 1, len(text) + 1)]:
        if group and s < group[2]:
            group[2] = max(group[2], e)
            continue
        if group:
            out += [text[at:group[1]], f"[REDACTED:{group[0]}]"]
            at = group[2]
        group = [kind, s, e]
    return "".join(out) + text[at:]


def scan_secrets(docs: DataFrame, text_col: str = "text", name: str = "spans") -> DataFrame:
    """The documents with their spans in column ``name`` (replaced if it is there)."""
    return docs.withColumn(name, spans(F.col(f"`{text_col}`")))


def redact_secrets(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """The documents with secrets replaced in the text; all rows and columns stay, ``chars_col`` follows the text."""
    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else redact(t, scan(t)) for t in texts], dtype=object)

    out = docs.withColumn(text_col, clean(F.col(f"`{text_col}`")))
    if chars_col in docs.columns:
        changed = F.col(chars_col).isNotNull() & F.col(text_col).isNotNull()
        kind = docs.schema[chars_col].dataType
        out = out.withColumn(chars_col, F.when(changed, F.length(text_col).cast(kind)).otherwise(F.col(chars_col)))
    return out

