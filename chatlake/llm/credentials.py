r"""Credentials inside source code and configuration, found and redacted without breaking the surrounding text.

Method. A text is scanned in layers. A JSON text is taken apart into its string literals, each of which is a text of its
own. In any other text, percent signs, backslash sequences (\xNN, \uNNNN, octal) and numeric entities are read as what
they stand for, and the finds in the text so read are carried back to their places; hexadecimal and base64 runs, also
wrapped over lines, with 0x, or as lists of bytes, are decoded and what they hold is scanned again. Every layer is shorter
than the one before, so there is no limit to their number. Key containers are parsed by their binary grammar: the DER
structures of PKCS#1, DSA, SEC1, PKCS#8 (plain, and encrypted by an algorithm for that) and PKCS#12, the OpenSSH key
format and OpenPGP secret-key packets; digests, public keys and certificates have other structures and are left alone.
PuTTY key files and private members of JSON web keys are found as text. A find in a decoded layer redacts the whole
encoded literal; in a JSON literal it redacts the find and writes the literal again, so JSON stays valid.

What counts. Actual keys, passwords, tokens and private keys: tokens of known forms, values assigned to names of
credentials, passwords in URLs, command lines, netrc files and connection strings, PEM blocks with a private key.
References to variables, environments and stores, placeholders, masked values, digests, ids, public keys and
certificates are none.

Null gives null and no finds; an empty or very long text is scanned whole; repeated rows give the same result. A text
that begins like JSON but does not parse is plain text.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "[REDACTED:{}]"

# Published forms of tokens (fixed values).
_FORMS = [
    ("aws_key_id", r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])"),
    ("github_token", r"(?<![A-Za-z0-9])(?:gh[pousr]_[A-Za-z0-9]{30,}|github_pat_\w{40,})"),
    ("slack_token", r"(?<![A-Za-z0-9])xox[abeoprs]-[A-Za-z0-9-]{18,}"),
    ("payment_key", r"(?<![A-Za-z0-9])[srp]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    ("api_key", r"(?<![A-Za-z0-9_-])sk-[A-Za-z0-9_-]{20,}"),
    ("google_key", r"(?<![A-Za-z0-9])AIza[A-Za-z0-9_-]{35}"),
    ("gitlab_token", r"(?<![A-Za-z0-9])glpat-[A-Za-z0-9_-]{20,}"),
    ("package_token", r"(?<![A-Za-z0-9])(?:npm_[A-Za-z0-9]{36}|pypi-[A-Za-z0-9_-]{50,}|hf_[A-Za-z0-9]{30,}|dop_v1_[0-9a-f]{64})"),
    ("mail_token", r"(?<![A-Za-z0-9])SG\.[A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{16,}"),
    ("jwt", r"(?<![A-Za-z0-9])eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{4,}\.[A-Za-z0-9_-]{8,}"),
    ("webhook", r"https?://hooks\.[a-z0-9.-]+/services/[A-Z0-9]{6,}/[A-Z0-9]{6,}/[A-Za-z0-9]{16,}"),
    ("age_key", r"AGE-SECRET-KEY-1[A-Z0-9]{50,}"),
    ("oauth_token", r"(?<![A-Za-z0-9])(?:ya29\.[A-Za-z0-9_-]{20,}|GOCSPX-[A-Za-z0-9_-]{20,}|xapp-\d-[A-Z0-9]{8,}-[A-Za-z0-9-]{20,}|shp(?:at|ca|pa|ss)_[a-fA-F0-9]{32}|sq0csp-[A-Za-z0-9_-]{40,})"),
    ("url_signature", r"(?<=[?&]sig=)[A-Za-z0-9%+/_-]{20,}={0,2}"),
]
_FORM = [(k, re.compile(p)) for k, p in _FORMS]
#: A form is looked for only where one of its fixed parts occurs.
_FORM_GATES = {
    "aws_key_id": ("AKIA", "ASIA"), "github_token": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "github_pat_"), "slack_token": ("xox",), "payment_key": ("k_live_", "k_test_"), "api_key": ("sk-",), "google_key": ("AIza",), "gitlab_token": ("glpat-",),
    "package_token": ("npm_", "pypi-", "hf_", "dop_v1_"), "mail_token": ("SG.",), "jwt": ("eyJ",), "webhook": ("://hooks.",), "url_signature": ("sig=",), "age_key": ("AGE-SECRET",), "oauth_token": ("ya29.", "GOCSPX-", "xapp-", "shp", "sq0csp-"),
}
_PEM = re.compile(r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?-----(?P<body>.*?)(?:-----END (?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?-----|\Z)", re.S)
_PUBLIC = re.compile(r"-----BEGIN (?:[A-Z0-9]+ )*(?:PUBLIC KEY|CERTIFICATE)(?: BLOCK)?-----.*?(?:-----END [A-Z0-9 ]+-----|\Z)|\bssh-(?:rsa|ed25519|dss) [A-Za-z0-9+/=]+|\bdata:[\w/+.-]+;base64,[A-Za-z0-9+/=]+|\bsha(?:1|256|384|512)-[A-Za-z0-9+/=]+", re.S)

# Names of credentials. These patterns run over the text in ASCII lower case.
_WORDS = (
    r"(?:pass(?:word|wd|phrase|code)?|pwd|pgpassword|secret(?:[_-]?(?:access[_-]?)?key)?|(?:api|access|auth|account|signing|encryption|master|private|session|hmac|shared|storage|admin|service)[_-]?(?:key|secret|token)"
    r"|token|client[_-]?secret|credentials?|auth|accountkey|sharedaccesskey)"
)
# name, separator, then a quoted or a bare value; quotes may be escaped
_ASSIGN = re.compile(
    rf"{_WORDS}(?:\\*[\"'])?\]?\s*(?:=>|:=|[:=])\s*(?:(?:bytes\.fromhex|b64decode|base64\.b64decode|bytes|str|buffer\.from|secretstr)\(\s*)?(?:[rbfu]{{0,2}}(?P<q>\\*[\"'`]{{1,3}})(?P<v>[^\n\"'`\\]{{4,}}?)(?P=q)|(?P<bare>[^\s\"'`,;)}}\]\\]{{6,}}))"
)
# a value in an element, or beside a name in attributes or lines of their own
_ELEMENT = re.compile(
    rf"<[a-z0-9_.:-]*?{_WORDS}(?:\s[^<>]*)?>\s*(?:<!\[cdata\[)?(?P<v>[^<>\s][^<>\n]{{3,}}?)\s*(?:\]\]>)?\s*</|(?:\b(?:key|name|id)\s*[=:]\s*\\*[\"']?)[a-z0-9_.-]*?{_WORDS}\\*[\"']?(?:\s|\\n|,)+(?:default_?)?\\*[\"']?value\\*[\"']?\s*[=:]\s*\\*[\"']?(?P<w>[^\s\"'<>\\]{{4,}})"
)
_BEFORE = re.compile(r"(?:[a-z0-9]+[_.-])*\Z")
_ASSIGN_GATES = ("pass", "pwd", "secret", "auth", "credential")
_KEY_GATE = re.compile(r"(?:api|access|account|signing|encryption|master|private|session|hmac|shared|storage|admin|service)[_-]?key")
_TOKEN_GATE = re.compile(r"token\\*[\"']?\]?\s*[:=]")
_VARIABLE = re.compile(r"variable\s+\\*\"[^\"\n]*(?:pass|secret|token|key)[^\"\n]*\"\s*\{|\}", re.I)
_DEFAULT = re.compile(r"default\s*=\s*\\*\"(?P<v>[^\"\\\n]{4,})", re.I)
_SPOKEN = [
    ("login_password", ("-u", "--user"), re.compile(r"(?<!\S)(?:-u|--user)[ =]\\*[\"']?[\w.-]+:(?P<v>[^\s\"'\\]{4,})")),
    ("netrc_password", ("machine",), re.compile(r"\bmachine\s+\S+\s+login\s+\S+\s+password\s+(?P<v>\S{4,})")),
    ("basic_auth", ("Basic ", "basic "), re.compile(r"\b[Bb]asic\s+(?P<v>[A-Za-z0-9+/_-]{8,}={0,2})")),
    ("bearer_token", ("Bearer ", "bearer "), re.compile(r"\b[Bb]earer\s+(?P<v>[A-Za-z0-9._~+/-]{16,}=*)")),
    ("url_password", ("://",), re.compile(r"(?<=[A-Za-z0-9])://[^\s/:@\"']*:(?P<v>[^\s/@\"']{4,})@[\w.-]")),
    ("piped_password", ("|",), re.compile(r"\b(?:echo|printf)\s+(?:-n\s+|-e\s+)?\\*[\"']?(?P<v>[^\s|\"'\\]{4,})\\*[\"']?\s*\|\s*[^\n|]{0,200}?(?:\blogin\b|--password-stdin|--passphrase-fd|\bsudo\s+-S|\bchpasswd|htpasswd\s+-i)")),
    ("option_password", ("--pass", "--pwd", "--token", "--secret", "--api", "--auth", "--access", "sshpass"), re.compile(r"(?:(?<!\S)--(?:pass(?:word|wd|phrase)?|pwd|token|secret(?:-key)?|api-(?:key|token)|auth-token|access-(?:key|token))[ =]+|\bsshpass\s+-p\s*)\\*[\"']?(?P<v>[^\s\"'\\|;&-][^\s\"'\\|;&]{5,})")),
    ("sql_password", ("IDENTIFIED", "identified", "PASSWORD", "password", "Password"), re.compile(r"\b(?:identified\s+(?:with\s+\S+\s+)?by|password)\s+\\*[\"'](?P<v>[^\"'\\\s]{4,})\\*[\"']", re.I)),
    ("config_password", ("requirepass", "masterauth"), re.compile(r"\b(?:requirepass|masterauth)\s+\\*[\"']?(?P<v>[^\s\"'\\]{4,})")),
    ("pair_password", ("auth", "login("), re.compile(r"(?:\bauth\s*=\s*\(|\.login\()\s*\\*[\"'][^\"'\\\n]{1,80}\\*[\"']\s*,\s*\\*[\"'](?P<v>[^\"'\\\n]{4,})\\*[\"']")),
    ("pgpass_password", (":5432:", ":*:", ":3306:", ":1433:"), re.compile(r"(?m)^[ \t]*[\w.*-]+:(?:\d+|\*):[\w*-]+:[\w*.-]+:(?P<v>[^\s:\"']{4,})[ \t]*$")),
    ("spoken_password", ("assword", "assphrase", "ecret"), re.compile(r"\b(?:password|passphrase|secret)(?: (?:for|of) [\w .@-]{1,40}?)?\s+(?:is|was|to)\s*:?\s+\\*[\"'`]?(?P<v>[^\s\"'`\\]{6,})", re.I)),
    ("putty_key", ("Private-Lines:",), re.compile(r"Private-Lines: *\d+(?:\\r)?(?:\\n|\s)+(?P<v>[A-Za-z0-9+/=]{40,}(?:(?:\\r)?(?:\\n|\s)+[A-Za-z0-9+/=]{8,})*)")),
    ("private_jwk", ("kty",), re.compile(r"\\*[\"'](?:d|p|q|dp|dq|qi|k)\\*[\"']\s*:\s*\\*[\"'](?P<v>[A-Za-z0-9_-]{20,})")),
]
_CLIENT, _CLIENT_PART, _CLIENT_PASSWORD = re.compile(r"\b(?:mysql|mysqldump|mysqladmin|mariadb)\b"), re.compile(r"[^\n|;&]+"), re.compile(r"\s(?:-p|--password=)(?P<v>[^\s\"'\\-][^\s\"'\\]{3,})")
_JOINED = re.compile(r"(?P<q>\\*[\"'])(?P<a>[^\"'\\\n]*)(?P=q)(?:\s*(?:\\+\s*)?\+\s*(?:\\+\s*)?(?P=q)[^\"'\\\n]*(?P=q))+")

_HOLLOW = re.compile(
    r"^(?:your|my|the|an?|some|insert|enter|put|change|replace|example|sample|dummy|fake|placeholder|redacted|removed|hidden|masked|none|null|nil|true|false|undefined|todo|tbd|secret|password|passwd|token|string|str|bytes|int|xxx+|\.{3,}|-{3,}|_{3,}|foo|bar)(?:$|[\W_])|^your|^changeme|^xxx|^example"
    r"|^[<\[{(%$@#&*]|[*•]{4,}|\$\{|\{\{|^\$|<[^>]*>|\.\.\.$|^(?:os|sys|env|process|config|settings|secrets?|vault|self|this|args|params|options|getpass|keyring|ssm|conf|cfg|app)\b[.\[(]|^[\w.]+\(|\[[\"'\\]|environ|getenv|^ref\+|^vault:|^arn:|^op://|^file:|^secretsmanager|_here$",
    re.I,
)
_UUID = re.compile(r"^[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12}$", re.I)
_STRONG = re.compile(r"pass|pwd|secret|api[_-]?key|access[_-]?key|signing|encryption|private|hmac", re.I)


def is_real(value: str, name: str = "password", bare: bool = False) -> bool:
    """Whether a value stands for itself: no reference, placeholder or mask."""
    v = value.strip()
    if len(v) < 4 or _HOLLOW.search(v) or len(set(v)) < 4 or re.search(r"(.)\1{7}", v):
        return False
    if re.search(r"x{8,}", v, re.I) or _UUID.match(v) or re.fullmatch(r"[A-Z][A-Z0-9_]*", v) and "_" in v:
        return False
    if re.match(r"(?:~|\.{1,2})?/[\w.-]+(?:/[\w.-]+)*$", v) and not re.fullmatch(r"[A-Za-z0-9+/]{40}={0,2}", v):
        return False  # a path
    digit, special = re.search(r"\d", v), re.search(r"[^\w.\s]", v)
    if bare and (re.fullmatch(r"[A-Za-z_][\w]*(?:\.[A-Za-z_]\w*)+", v) and not digit or re.fullmatch(r"[A-Za-z_]+", v) or re.fullmatch(r"[\d.]+", v)):
        return False
    if _STRONG.search(name):
        return not v.isdigit() and " " not in v and len(v) >= 6 and (not v.isalpha() or not v.islower() and not v.isupper() and not v.istitle() or len(v) >= 20)
    return len(v) >= 12 and " " not in v and bool(digit or special) and any(c.isalpha() for c in v) and not re.fullmatch(r"[\w.-]+\.(?:\w{1,4})", v)


def _der(data: bytes, at: int = 0) -> tuple[int, int, int] | None:
    """(tag, start, end) of the value at a position, or None."""
    if at + 2 > len(data):
        return None
    tag, n = data[at], data[at + 1]
    at += 2
    if n & 0x80:
        k = n & 0x7F
        if not 1 <= k <= 4 or at + k > len(data):
            return None
        n = int.from_bytes(data[at : at + k], "big")
        at += k
    return (tag, at, at + n) if at + n <= len(data) else None


def _children(data: bytes, at: int, end: int, most: int = 12) -> list[tuple[int, int, int]] | None:
    """The values within a structure, or None where it is no whole number of them."""
    out = []
    while at < end and len(out) < most:
        kid = _der(data, at)
        if not kid or kid[2] > end:
            return None
        out.append(kid)
        at = kid[2]
    return out


def _oid(data: bytes, node: tuple[int, int, int]) -> bytes | None:
    """The object identifier that a SEQUENCE begins with, as its bytes."""
    if node[0] != 0x30:
        return None
    kids = _children(data, node[1], node[2])
    return data[kids[0][1] : kids[0][2]] if kids and kids[0][0] == 0x06 else None


# Object identifiers (fixed values): password-based encryption of PKCS#5 and PKCS#12, and content types of PKCS#7.
_ENCRYPTIONS = (b"\x2a\x86\x48\x86\xf7\x0d\x01\x05", b"\x2a\x86\x48\x86\xf7\x0d\x01\x0c\x01")
_CONTENTS = b"\x2a\x86\x48\x86\xf7\x0d\x01\x07"


def _der_kind(data: bytes) -> str | None:
    top = _der(data)
    if not top or top[0] != 0x30 or data[top[2] :].strip(b"\r\n\0"):
        return None
    kids = _children(data, top[1], top[2])
    if not kids:
        return None
    tags = [k[0] for k in kids]
    first = int.from_bytes(data[kids[0][1] : kids[0][2]], "big") if tags[0] == 0x02 and kids[0][2] - kids[0][1] <= 2 else None
    size = lambda i: kids[i][2] - kids[i][1]
    if tags[:2] == [0x02, 0x30] and first in (0, 1) and tags[2:3] == [0x04] and _oid(data, kids[1]) and size(2) >= 16:
        return "private"  # PKCS#8
    if tags[:2] == [0x02, 0x04] and first == 1 and 16 <= size(1) <= 72 and set(tags[2:]) <= {0xA0, 0xA1}:
        return "private"  # SEC1
    if set(tags) == {0x02} and first in (0, 1) and (len(tags) == 9 and size(1) > size(4) >= 8 and size(1) >= 32 or len(tags) == 6 and size(1) >= 32 and size(5) >= 16):
        return "private"  # PKCS#1, DSA
    if set(tags[:9]) == {0x02} and first == 1 and tags[9:] == [0x30]:
        return "private"  # PKCS#1 with more than two primes
    if tags == [0x30, 0x04]:
        oid = _oid(data, kids[0])
        return "private" if oid and oid.startswith(_ENCRYPTIONS) and size(1) >= 16 else None  # encrypted PKCS#8; else a digest
    if tags[:2] == [0x02, 0x30] and first == 3 and (_oid(data, kids[1]) or b"").startswith(_CONTENTS) and tags[2:] in ([], [0x30]):
        return "private"  # PKCS#12
    if tags == [0x30, 0x03] and _oid(data, kids[0]) or tags == [0x30, 0x30, 0x03] and _oid(data, kids[1]) or tags == [0x02, 0x02]:
        return "public"
    return None


def _openssh(data: bytes) -> bool:
    """Whether the fields of an OpenSSH key follow each other to the private part."""
    at = 15

    def field() -> bytes | None:
        nonlocal at
        n = int.from_bytes(data[at : at + 4], "big")
        if at + 4 > len(data) or at + 4 + n > len(data):
            return None
        at += 4 + n
        return data[at - n : at]

    cipher, kdf, options = field(), field(), field()
    if not cipher or not kdf or options is None or not cipher.isascii() or not kdf.isascii():
        return False
    keys, at = int.from_bytes(data[at : at + 4], "big"), at + 4
    return 1 <= keys <= 16 and all(field() for _ in range(keys)) and len(data) > at + 8


def _pgp_secret(data: bytes) -> bool:
    """Whether an OpenPGP secret-key packet begins here."""
    head = data[0]
    if head & 0xC0 == 0xC0:
        tag, n = head & 0x3F, data[1]
        skip, n = (2, n) if n < 192 else (3, ((n - 192) << 8) + data[2] + 192) if n < 224 else (6, int.from_bytes(data[2:6], "big")) if n == 255 else (0, 0)
    else:
        tag, kind = (head >> 2) & 0x0F, head & 3
        skip, n = (0, 0) if kind == 3 else (2 + (1 << kind) - 1, int.from_bytes(data[1 : 1 + (1 << kind)], "big"))
    body = data[skip : skip + n]
    algorithm = {3: 7, 4: 5, 5: 5, 6: 5}.get(body[0] if body else 0)
    return tag in (5, 7) and skip > 0 and 24 <= n <= len(data) - skip and algorithm is not None and body[algorithm] in (1, 2, 3, 16, 17, 18, 19, 22, 25, 26, 27, 28)


def key_kind(data: bytes) -> str | None:
    """private, public or None, by the binary grammar of key containers."""
    if len(data) < 40:
        return None
    if data.startswith(b"openssh-key-v1\x00"):
        return "private" if _openssh(data) else None
    if data[0] == 0x30:
        return _der_kind(data)
    return "private" if data[0] & 0x80 and _pgp_secret(data) else None


_SIGN = re.compile(
    r"(?:%(?:25)*[0-9A-Fa-f]{2})+|(?:\\+(?:x5[cC]\\*|u005[cC]\\*)*(?:x[0-9A-Fa-f]{2}|u[0-9A-Fa-f]{4}|u\{[0-9A-Fa-f]{1,6}\}|[0-3][0-7]{2}))+|(?:&(?:#38;|#[xX]26;|amp;)*#(?:\d{2,7}|[xX][0-9A-Fa-f]{2,6});)+"
)
_ONE_SIGN = re.compile(r"\\+(?:x5[cC]\\*|u005[cC]\\*)*(?:[xu]\{?([0-9A-Fa-f]+)\}?|([0-7]{3}))|&(?:#38;|#[xX]26;|amp;)*#(?:[xX]([0-9A-Fa-f]+)|(\d+));")
_B64 = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
_HEX = re.compile(r"(?:0[xX])?((?:[0-9a-fA-F]{2}){12,})")
#: Base64 over several lines of equal width, and lists of bytes.
_WRAPPED = re.compile(r"[A-Za-z0-9+/]{40,80}(?:(?:\\r)?\\n|\r?\n)[ \t]*(?:[A-Za-z0-9+/]{40,80}(?:(?:\\r)?\\n|\r?\n)[ \t]*)*[A-Za-z0-9+/]{1,80}={0,2}")
_BREAKS = re.compile(r"\\r|\\n|\s+")
_BYTES = re.compile(r"(?:0[xX][0-9a-fA-F]{1,2}[,\s]{1,4}){7,}0[xX][0-9a-fA-F]{1,2}|(?<![0-9a-fA-F:])(?:[0-9a-fA-F]{2}[: ]){11,}[0-9a-fA-F]{2}")
_BYTE = re.compile(r"(?:0[xX])?([0-9a-fA-F]{1,2})")


def _printable(b: bytes) -> str | None:
    if len(b) >= 16 and not any(b[1::2]) and all(b[::2]):
        b = b[::2]  # two bytes a sign
    try:
        s = b.decode()
    except UnicodeDecodeError:
        return None
    return s if s and sum(c.isprintable() or c in "\n\r\t" for c in s) >= 0.97 * len(s) else None


def _decode(kind: str, run: str) -> tuple[str | None, str | None]:
    """(text, kind of key) that an encoded run holds."""
    try:
        if kind == "bytes":
            b = bytes(int(m[1], 16) for m in _BYTE.finditer(run))
        else:
            if kind == "wrapped":
                run = _BREAKS.sub("", run)
            h = _HEX.fullmatch(run)
            if h:
                b = bytes.fromhex(h[1])
            else:
                b = base64.b64decode(run.rstrip("=").translate(_URLSAFE) + "=" * (-len(run.rstrip("=")) % 4))
    except (ValueError, binascii.Error):
        return None, None
    return _printable(b), key_kind(b)


def _sign(m: re.Match) -> str:
    try:
        return chr(int(m[2], 8) if m[2] else int(m[4]) if m[4] else int(m[1] or m[3], 16))
    except (ValueError, OverflowError):
        return m.group()


def unescape(text: str) -> tuple[str, list[tuple[int, int, int, int]]] | None:
    """The text with its escape sequences read, and (start, end, start and end before) of each stretch that was read;
    None where there are none. A sign that was escaped many times is read at once."""
    out, stretches, at, n = [], [], 0, 0
    for m in _SIGN.finditer(text):
        run = m.group()
        said = bytes(int(x[-2:], 16) for x in run.split("%")[1:]).decode("utf-8", "replace") if run[0] == "%" else _ONE_SIGN.sub(_sign, run)
        if len(said) >= len(run):
            continue
        out += [text[at : m.start()], said]
        n += m.start() - at
        stretches.append((n, n + len(said), m.start(), m.end()))
        n += len(said)
        at = m.end()
    return ("".join(out) + text[at:], stretches) if stretches else None


def _before(spans: list[tuple[int, int, str]], stretches: list[tuple[int, int, int, int]]) -> list[tuple[int, int, str]]:
    """Spans of an unescaped text as spans of the text before; a stretch counts whole."""
    starts = [x[0] for x in stretches]

    def at(place: int, side: int) -> int:
        i = bisect_right(starts, place) - 1
        if i < 0:
            return place + side
        _, end, old, old_end = stretches[i]
        return (old_end if side else old) if place < end else old_end + place - end + side

    return [(at(a, 0), at(b - 1, 1), k) for a, b, k in spans]


_URLSAFE = str.maketrans("-_", "+/")


def _lower(text: str) -> str:
    """ASCII lower case, with every place kept."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if c < "\x80" else c for c in text)


_TEXT_GATES = [*(g for gs in _FORM_GATES.values() for g in gs), *(g for _, gs, _ in _SPOKEN for g in gs), "-----BEGIN", "variable"]


def _may_assign(low: str) -> bool:
    return any(map(low.__contains__, _ASSIGN_GATES)) or "token" in low and bool(_TOKEN_GATE.search(low)) or "key" in low and bool(_KEY_GATE.search(low))


def _runs(text: str) -> Iterator[tuple[str, int, int]]:
    """(kind, start, end) of what may be encoded."""
    if "0x" in text or "0X" in text or ":" in text:
        for m in _BYTES.finditer(text):
            yield "bytes", *m.span()
    long = False
    for m in _B64.finditer(text):
        long |= m.end() - m.start() >= 40
        if not _UUID.match(m.group()):
            yield "b64", *m.span()
    if long:
        for m in _WRAPPED.finditer(text):
            yield "wrapped", *m.span()


def _spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the credentials of a text that is no JSON; they may overlap."""
    out, layers = _direct(text), []
    while ("%" in text or "\\" in text or "&" in text) and (read := unescape(text)):
        text = read[0]
        layers.append(read[1])
        found = _direct(text)
        for stretches in reversed(layers if found else []):
            found = _before(found, stretches)
        out += found
    return out


def _direct(text: str) -> list[tuple[int, int, str]]:
    out: list[tuple[int, int, str]] = []
    low = _lower(text)
    assigns, forms = _may_assign(low), any(map(text.__contains__, _TEXT_GATES))
    runs = list(_runs(text))
    if not (assigns or forms or runs):
        return out
    shut = [m.span() for m in _PUBLIC.finditer(text)] if "-----" in text or "base64," in text or "ssh-" in text or "sha" in text else []
    ends = [e for _, e in shut]

    def free(a: int, b: int) -> bool:
        i = bisect_right(ends, a)
        return i == len(shut) or shut[i][0] >= b

    if "-----BEGIN" in text:
        out += [(m.start(), m.end(), "private_key") for m in _PEM.finditer(text) if len(re.findall(r"[A-Za-z0-9+/]", m["body"])) >= 40]
    for kind, p in _FORM if forms else ():
        if any(g in text for g in _FORM_GATES[kind]):
            out += [(m.start(), m.end(), kind) for m in p.finditer(text) if is_real(m.group().split("_", 1)[-1].removeprefix("sk-").removeprefix("proj-"), "token")]
    if assigns:
        for m in _ASSIGN.finditer(low):
            before = low[m.start() - 1] if m.start() else " "
            if before.isalpha():
                continue
            g = "v" if m["v"] is not None else "bare"
            a, b = m.span(g)
            name = _BEFORE.search(low, max(0, m.start() - 40), m.start()).group() + low[m.start() : a]
            if is_real(text[a:b], name, bare=g == "bare") and free(a, b):
                out.append((a, b, "secret"))
        for m in _ELEMENT.finditer(low) if "<" in low or "value" in low else ():
            g = "v" if m["v"] is not None else "w"
            a, b = m.span(g)
            if is_real(text[a:b], low[m.start() : a], bare=g == "w") and free(a, b):
                out.append((a, b, "secret"))
    if "variable" in text:
        marks = [m.span() for m in _VARIABLE.finditer(text)]
        for (a, b), (c, _) in zip(marks, [*marks[1:], (len(text), 0)], strict=True):
            m = _DEFAULT.search(text, b, c) if b - a > 1 else None
            if m and is_real(m["v"]):
                out.append((*m.span("v"), "secret"))
    if "mysql" in text or "mariadb" in text:
        for part in _CLIENT_PART.finditer(text):
            m = _CLIENT.search(text, *part.span())
            for v in _CLIENT_PASSWORD.finditer(text, m.end(), part.end()) if m else ():
                if is_real(v["v"]):
                    out.append((*v.span("v"), "client_password"))
    for kind, gates, p in _SPOKEN if forms else ():
        if not any(g in text for g in gates):
            continue
        for m in p.finditer(text):
            v = m["v"]
            if kind == "putty_key":
                out.append((*m.span("v"), kind))
            elif kind == "basic_auth":
                s = _decode("b64", v)[0]
                if s and ":" in s and is_real(s.split(":", 1)[1]):
                    out.append((*m.span("v"), kind))
            elif kind in ("spoken_password", "option_password", "piped_password") and not (re.search(r"\d", v) and re.search(r"[^\W\d]", v)):
                continue  # a plain word or number after such a word may be anything
            elif is_real(v.rstrip(".,;:!?)") if kind == "spoken_password" else v, "token" if kind == "bearer_token" else "password"):
                out.append((*m.span("v"), kind))
    if "+" in text and ('" + ' in text or "' + " in text or "+ \"" in text or "+ '" in text or "+ \\" in text):
        for m in _JOINED.finditer(text):
            parts = [(p.start(2) + m.start(), p.end(2) + m.start()) for p in re.finditer(r"(\\*[\"'])([^\"'\\\n]*)\1", m.group())]
            whole = "".join(text[a:b] for a, b in parts)
            if any(p.search(whole) for _, p in _FORM) and is_real(whole.split("_", 1)[-1], "token"):
                out += [(a, b, "split_token") for a, b in parts if b > a]
    for kind, a, b in runs:
        if not free(a, b):
            continue
        s, key = _decode(kind, text[a:b])
        if key == "private" or s is not None and len(s) >= 8 and redact(s)[1]:
            out.append((a, b, "encoded"))
    return out


def _plain(text: str) -> tuple[str, int]:
    spans = sorted(_spans(text))
    if not spans:
        return text, 0
    merged = [list(spans[0])]
    for a, b, k in spans[1:]:
        if a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b, k])
    out, at = [], 0
    for a, b, k in merged:
        out += [text[at:a], MARK.format(k)]
        at = b
    return "".join(out) + text[at:], len(merged)


_LITERAL = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*"(?P<key>\s*:)?', re.S)
_parse = json.JSONDecoder(strict=False).decode
_JWK = ("d", "p", "q", "dp", "dq", "qi", "k")
_KEYED = re.compile(rf"(?:[a-z0-9]+[_.-])*{_WORDS}\Z")


def redact(text: str) -> tuple[str, int]:
    """(text without its credentials, number of finds)."""
    head = text.lstrip()[:1]
    if head in ("{", "["):
        try:
            _parse(text)
        except (ValueError, RecursionError):
            return _plain(text)
        out, at, found, key, jwk = [], 0, 0, "", '"kty"' in text
        for m in _LITERAL.finditer(text):
            lit = m.group()[: -len(m["key"])] if m["key"] else m.group()
            if m["key"]:
                key = lit[1:-1]
                continue
            name, key = key, ""
            if len(lit) < 8 or len(lit) == 38 and _UUID.match(lit[1:-1]):
                continue
            s = _parse(lit) if "\\" in lit else lit[1:-1]
            new, n = redact(s)
            if not n and (_KEYED.match(name.lower()) and is_real(s, name) or jwk and name in _JWK and len(s) >= 20):
                new, n = MARK.format("secret"), 1
            if n:
                out += [text[at : m.start()], json.dumps(new, ensure_ascii=lit.isascii())]
                at, found = m.start() + len(lit), found + n
        return ("".join(out) + text[at:], found) if found else (text, 0)
    return _plain(text)


def redact_column(df: DataFrame, key_cols: list[str], text_col: str) -> DataFrame:
    """(*keys, text, n_found): the records with a credential, redacted, one row per key; all others are as they are."""
    src = df.filter(F.col(text_col).isNotNull()).select(*key_cols, F.col(text_col).alias("text"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in src.schema.fields[:-1])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            done = [redact(t) for t in b["text"]]
            if not any(n for _, n in done):
                continue
            keys = {c: [v for v, (_, n) in zip(b[c].tolist(), done, strict=True) if n] for c in key_cols}
            yield pd.DataFrame({**keys, "text": [t for t, n in done if n], "n_found": [n for _, n in done if n]})

    return src.mapInPandas(run, f"{kinds}, text string, n_found int").dropDuplicates(key_cols)
