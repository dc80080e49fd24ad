"""Secrets in texts: plain patterns, and candidates that are reported only when their structure can be parsed.

Base kinds are patterns alone: `assign`, `access` and `hex`. The others are decoded first. `jwt`: three base64url parts,
the first a JSON header that names an algorithm. `pem`: an armoured private key whose body is DER or an OpenSSH key.
`key`: a base64 or hex run that decodes to such a key, or to its armour. Base64 may be wrapped: line ends, blanks, their
escaped forms and the joints of string literals may stand anywhere in it; hex also be joined by colons. Where a key ends
follows from the lengths that it states. DER is parsed to the end: every nested length must fill its parent. A run is read
once, however many keys may begin in it, and lengths are read where they stand, so time is linear in the text.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.tasks import map_rows

# The base patterns and the order of the kinds.
KINDS = ("assign", "access", "hex", "jwt", "pem", "key")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # the same matches as runs of one or more, less those that are too short

# Where a token may begin: two characters that decode to a brace or a blank, behind no letter or digit, or behind an escaped
# line end, tab or equals sign.
_JWT_START = re.compile(
    r"(?:(?<![A-Za-z0-9])|(?<=\\[nrt])|(?<=u003[dD])|(?<=%3[dD]))(?:e[w-z0-9_-]|I[A-P]|C[Q-Za-v]|D[Q-Za-f])")
_SEGMENT = re.compile(r"[A-Za-z0-9_-]+")
_GAP = r"""\s|\\+(?:[nrt]|\r?\n|u00(?:0[9aAdD]|20))|\\*["']\s*+(?:[+,.]\s*+)?\\*["']"""
_WRITTEN = r"\\+(?:/|u00(?:2[bBdDfF]|3[dD]|5[fF]))"  # characters of base64 that are written as escapes
_PEM = re.compile(rf"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----((?:[A-Za-z0-9+/=]|{_GAP}|{_WRITTEN})++)-----END \1-----")
_PIECE = re.compile(rf"((?:[A-Za-z0-9+/_-]|(?!\\+u003[dD]){_WRITTEN})++)|(?:{_GAP})++")
_PADDING = re.compile(r"(?:=|\\+u003[dD]){0,2}")
_KEY_START = re.compile(r"(?:(?<![A-Za-z0-9+/])|(?<=\\[nrt]))(?:M(?=[A-P\s\\\"'])|b(?=3|[\s\\\"']))")  # a DER sequence, OpenSSH
_HEX_GAP = r"(?:[:\s]|\\+(?:[nrtx]|\r?\n)|0x)*+"
_HEX_RUN = re.compile(rf"(?<![0-9a-fA-F])(?:[0-9a-fA-F]{{2}}{_HEX_GAP}){{20,}}+")
_HEX_PAIR = re.compile(r"(?!0x)[0-9a-fA-F]{2}")
_OPENSSH = b"openssh-key-v1\0"


def _encoded_armour() -> list[tuple[str, re.Pattern]]:
    """For each place in a group of three bytes: what stands before the sure characters of an encoded `-----BEGIN `, and these."""
    made = []
    for before, first in ((0, 0), (1, 2), (2, 3)):
        text = base64.b64encode(b"\0" * before + b"-----BEGIN ").decode()
        sure = text[first:(before + 11) * 8 // 6]
        made.append((text[:first], re.compile(f"(?:{_GAP})*+".join(sure))))
    return made


_ENCODED_ARMOUR = _encoded_armour()


def spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, place of the kind in KINDS, end) of every secret in code points, by start and then by kind."""
    if not text:
        return []
    found = [(s, k, e) for s, k, e in _base(text)]
    found += _decoded(text)
    return sorted(found)


def _base(text: str) -> Iterator[tuple[int, int, int]]:
    lower = text.lower()
    if any(w in lower for w in _WORDS):
        yield from ((m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6)
    if "AKIA" in text:
        yield from ((m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20)
    yield from ((m.start(), 2, m.end()) for m in _HEX.finditer(text))


def _decoded(text: str) -> Iterator[tuple[int, int, int]]:
    if "." in text:
        yield from ((start, 3, end) for start, end in _tokens(text))
    armoured = []
    if "PRIVATE KEY-----" in text:
        for m in _PEM.finditer(text):
            if private_key(_from_base64(_plain(m[2]))):
                armoured.append(m.span())
                yield m.start(), 4, m.end()
    for start, end in _encoded_pems(text):
        armoured.append((start, end))
        yield start, 5, end
    armoured.sort()
    run, inside = None, -1
    for m in _KEY_START.finditer(text):
        start = m.start()
        while armoured and armoured[0][0] <= start:
            inside = max(inside, armoured.pop(0)[1])
        if start < inside:
            continue
        if run is None or not run.reaches(start):
            run = _Run(text, start)
        if end := _key_end(run, start):
            yield start, 5, end
    yield from ((start, 5, end) for start, end in _hex_keys(text))


def _tokens(text: str) -> Iterator[tuple[int, int]]:
    """Signed tokens; the ends of a run's segments are looked up once."""
    at = stop = -1
    parts = None
    for m in _JWT_START.finditer(text):
        start = m.start()
        if start < at:
            continue
        if start >= stop:
            stop = _SEGMENT.match(text, start).end()
            parts = _after(text, stop)
        if parts and _opens_object(text[start:min(start + 64, stop)]):
            payload, end = parts
            if signed_token(text[start:stop], text[stop + 1:payload], text[payload + 1:end]):
                yield start, end
                at = end


def _after(text: str, stop: int) -> tuple[int, int] | None:
    """Ends of the second and the third segment behind a first that ends at `stop`."""
    second = _SEGMENT.match(text, stop + 1) if text[stop:stop + 1] == "." else None
    if not second or text[second.end():second.end() + 1] != ".":
        return None
    third = _SEGMENT.match(text, second.end() + 1)
    return second.end(), third.end() if third else second.end() + 1


def _opens_object(head: str) -> bool:
    """Whether base64 begins a JSON object, as far as its first characters tell."""
    head = head[:len(head) // 4 * 4] if len(head) >= 64 else head
    data = base64.urlsafe_b64decode(head + "A" * (-len(head) % 4))[:len(head) * 6 // 8].lstrip(b" \t\r\n")
    if not data:
        return True
    try:
        plain = data[:-4].decode() if len(data) > 8 else ""
    except UnicodeDecodeError as e:
        return data[:1] == b"{" and e.start >= len(data) - 7
    return data[:1] == b"{" and all(c >= " " or c in "\t\r\n" for c in plain)


def _hex_keys(text: str) -> Iterator[tuple[int, int]]:
    """Keys and armoured keys written in hex, which may be wrapped or joined by colons."""
    for m in _HEX_RUN.finditer(text):
        low = m[0].lower()
        if "30" not in low and "6f" not in low and "2d" not in low:
            continue
        places = [p.start() for p in _HEX_PAIR.finditer(text, m.start(), m.end())]
        data = bytes(int(text[p:p + 2], 16) for p in places)
        at = 0
        for i, byte in enumerate(data):
            if i < at or byte not in b"\x30\x6f\x2d" or i and places[i] == places[i - 1] + 2:  # only where a group begins
                continue
            size = _stated_size(lambda a, b, i=i: data[i + a:i + b] if i + b <= len(data) else None, len(data))
            end = i + size if size else None
            if data.startswith(b"-----BEGIN ", i) and (found := _PEM.match(data[i:].decode("latin-1"))):
                end = i + found.end() if private_key(_from_base64(_plain(found[2]))) else None
            elif not end or end > len(data) or not private_key(data[i:end]):
                continue
            if end and not re.match("[0-9a-fA-F]", text[places[end - 1] + 2:places[end - 1] + 3]):
                yield places[i], places[end - 1] + 2
                at = end


_ESCAPE = re.compile(r"\\+u([0-9a-fA-F]{4})|\\+(/)")
_GAPS = re.compile(_GAP)


def _plain(body: str) -> str:
    """Base64 without gaps, escapes written out."""
    return _ESCAPE.sub(lambda m: m[2] or chr(int(m[1], 16)), _GAPS.sub("", body))


class _Run:
    """Base64 of one run of a text without its gaps, read once however many keys may begin in it."""

    def __init__(self, text: str, start: int):
        self.text, self.at, self.open = text, start, True
        self.chars = bytearray()
        self.starts: list[int] = []  # of pieces in the text
        self.before: list[int] = []  # characters in front of each piece
        self.ends: dict[int, int] = {}  # characters up to the end of a piece -> its end in the text

    def more(self) -> bool:
        while self.open:
            m = _PIECE.match(self.text, self.at)
            if not m or m[0].startswith("-----"):
                self.open = False
                return False
            self.at = m.end()
            if m[1]:
                self.starts.append(m.start())
                self.before.append(len(self.chars))
                self.chars += (_plain(m[1]) if "\\" in m[1] else m[1]).encode().translate(_STANDARD)
                self.ends[len(self.chars)] = self.at
                return True
        return False

    def reaches(self, place: int) -> bool:
        while self.at <= place and self.more():
            pass
        return self.at > place

    def index(self, place: int) -> int:
        """Characters in front of a place of the text."""
        i = bisect_right(self.starts, place) - 1
        part = self.text[self.starts[i]:place]
        return self.before[i] + len(_plain(part) if "\\" in part else part)

    def holds(self, chars: int) -> bool:
        while len(self.chars) < chars and self.more():
            pass
        return len(self.chars) >= chars

    def bytes(self, index: int, a: int, b: int) -> bytes | None:
        """Bytes a to b of what is written from `index` on; None where the run is too short."""
        if not self.holds(index + -(-b * 8 // 6)):
            return None
        first = a // 3 * 4
        text = bytes(self.chars[index + first:index + -(-b // 3) * 4])
        return base64.b64decode(text + b"A" * (-len(text) % 4))[a - a // 3 * 3:b - a // 3 * 3]


_STANDARD = bytes.maketrans(b"-_", b"+/")
_MOST_PARTS = 16


def _key_end(run: _Run, start: int) -> int | None:
    """Where the key that begins at `start` ends, by the lengths it states; None if there is none.

    Lengths are read where they stand, so a start that leads nowhere costs the same however much it claims.
    """
    if not run.reaches(start):
        return None
    index = run.index(start)
    size = _stated_size(lambda a, b: run.bytes(index, a, b), len(run.text))
    if size is None:
        return None
    last = index + -(-size * 8 // 6)
    if not run.holds(last) or last not in run.ends or not private_key(_from_base64(run.chars[index:last].decode())):
        return None
    return _PADDING.match(run.text, run.ends[last]).end()


def _stated_size(read: Callable[[int, int], bytes | None], most: int) -> int | None:
    """How many bytes a key takes, by the lengths that `read(from, to)` shows; None if it is no key or larger than `most`.

    A key has few parts: those of a DER sequence must fill it, and OpenSSH files hold one key.
    """
    head = read(0, len(_OPENSSH))
    if head == _OPENSSH:
        at, left, counted = len(_OPENSSH), 3, False
        while left or not counted:
            stated = read(at, at + 4)
            if stated is None or at > most:
                return None
            size = int.from_bytes(stated, "big")
            at += 4
            if left:
                at, left = at + size, left - 1
            elif size > _MOST_PARTS:
                return None
            else:  # the number of keys: a public part for each, then the private parts
                counted, left = True, size + 1
        return at if at <= most else None
    if not head or head[0] != 0x30 or (outer := _part(head)) is None or sum(outer) > most:
        return None
    at, end = outer[0], sum(outer)
    if head[at] not in (0x02, 0x30):  # a version, or the algorithm of an encrypted key
        return None
    for _ in range(_MOST_PARTS):
        part = _part(read(at, min(at + 6, end)) or b"")
        if part is None or at + sum(part) > end:
            return None
        at += sum(part)
        if at == end:
            return end
    return None


def _part(data: bytes) -> tuple[int, int] | None:
    """Bytes of an element's tag and length, and of its content."""
    if len(data) < 2:
        return None
    width = data[1] & 0x7F if data[1] & 0x80 else 0
    if width > 4 or len(data) < 2 + width:
        return None
    return 2 + width, int.from_bytes(data[2:2 + width], "big") if width else data[1]


def _encoded_pems(text: str) -> Iterator[tuple[int, int]]:
    """Spans of base64 that decodes to an armoured private key."""
    for before, sure in _ENCODED_ARMOUR:
        run = None
        for m in sure.finditer(text):
            if run is None or not run.reaches(m.start()):
                run = _Run(text, m.start())
            if run.reaches(m.start()) and (end := _encoded_pem_end(run, m.start(), before)):
                start = m.start()
                while start > max(0, m.start() - len(before)) and _PIECE.match(text, start - 1, start):
                    start -= 1
                yield start, end


def _encoded_pem_end(run: _Run, start: int, before: str) -> int | None:
    """Read block by block up to the first dash behind the label; `before` stands for what is in front of the sure characters."""
    index, lead = run.index(start), len(before)

    def read(a: int, b: int) -> bytes:
        run.holds(index - lead + -(-b * 8 // 6))
        b = min(b, (lead + len(run.chars) - index) * 6 // 8)
        if a >= b:
            return b""
        first, last = a // 3 * 4, -(-b // 3) * 4
        code = (before.encode() if first < lead else b"") + bytes(run.chars[index + max(first - lead, 0):index + last - lead])
        return base64.b64decode(code + b"A" * (-len(code) % 4))[a - a // 3 * 3:b - a // 3 * 3]

    first = lead * 6 // 8
    body = first + len(b"-----BEGIN ")
    label, dashes, _ = read(body, body + _LABEL).partition(b"-----")
    if not dashes or not re.fullmatch(rb"(?:[A-Z0-9 ]* )?PRIVATE KEY", label):
        return None
    closing = b"-----END " + label + b"-----"
    at = body + len(label) + len(dashes)
    while (place := (block := read(at, at + _BLOCK)).find(b"-")) < 0:
        if len(block) < _BLOCK or not block.isascii():
            return None
        at += len(block)
    last = at + place + len(closing)
    if read(at + place, last) != closing:
        return None
    found = _PEM.fullmatch(read(first, last).decode("ascii", "replace"))
    if not found or not private_key(_from_base64(_plain(found[2]))):
        return None
    chars = index - lead + -(-last * 8 // 6)
    end = next(e for size, e in run.ends.items() if size >= chars)
    return _PADDING.match(run.text, end).end()


_BLOCK = 4096
_LABEL = 96  # bytes of an armour's label, more than any has


def _from_base64(text: str) -> bytes | None:
    """The decoded bytes, in either alphabet; None if the length or the unused bits are wrong."""
    text = text.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        data = base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None
    return data if base64.b64encode(data).decode().rstrip("=") == text else None


def signed_token(header: str, payload: str, signature: str) -> bool:
    """Whether the header is a JSON object with an algorithm, the payload a JSON object, and the signature fits."""
    try:
        head, body = (json.loads(_from_base64(part) or b"") for part in (header, payload))
    except (ValueError, RecursionError):
        return False
    if not isinstance(head, dict) or not isinstance(body, dict) or not isinstance(head.get("alg"), str):
        return False
    return not signature if head["alg"].lower() == "none" else bool(_from_base64(signature))


def elements(data: bytes, depth: int = 0) -> list[tuple[int, bytes]] | None:
    """(tag, content) of DER elements that fill `data`, None if lengths are not minimal or do not nest."""
    found, at = [], 0
    while at < len(data):
        if depth > 16 or at + 2 > len(data):
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size >= 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or at + width > len(data):
                return None
            size = int.from_bytes(data[at:at + width], "big")
            if size < 0x80 or size >> 8 * (width - 1) == 0:
                return None
            at += width
        if at + size > len(data) or tag & 0x1F == 0x1F:
            return None
        content = data[at:at + size]
        if tag & 0x20 and elements(content, depth + 1) is None:
            return None
        found.append((tag, content))
        at += size
    return found


def private_key(data: bytes | None) -> bool:
    """Whether the bytes are a private key: PKCS #1, PKCS #8, SEC 1, encrypted PKCS #8, DSA or OpenSSH."""
    if not data:
        return False
    if data.startswith(_OPENSSH):
        return _openssh(data[len(_OPENSSH):])
    outer = elements(data)
    if outer is None or len(outer) != 1 or outer[0][0] != 0x30:
        return False
    inner = elements(outer[0][1]) or []
    tags = [t for t, _ in inner]
    numbers = [len(c) for t, c in inner if t == 0x02]
    if tags and tags[0] == 0x02 and len(inner[0][1]) == 1 and inner[0][1][0] <= 3:
        if tags[1:3] == [0x30, 0x04]:
            return (elements(inner[1][1]) or [(0, b"")])[0][0] == 0x06
        if tags[1:2] == [0x04]:
            return len(inner[1][1]) >= 16
        return len(tags) >= 6 and len(numbers) >= 6 and set(tags) <= {0x02, 0x30} and max(numbers) >= 32
    if tags == [0x30, 0x04]:
        return (elements(inner[0][1]) or [(0, b"")])[0][0] == 0x06 and len(inner[1][1]) >= 32
    return False


def _openssh(data: bytes) -> bool:
    """Length-prefixed strings: cipher, derivation, its options, then the number of keys, public and private parts."""
    at, strings = 0, []
    while at + 4 <= len(data):
        if len(strings) == 3:
            strings.append(data[at:at + 4])
            at += 4
            continue
        size = int.from_bytes(data[at:at + 4], "big")
        if at + 4 + size > len(data):
            return False
        strings.append(data[at + 4:at + 4 + size])
        at += 4 + size
    return at == len(data) and len(strings) >= 6


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_decoded long"


def _listed(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in found)


def find_secrets(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: counts by base kind, SHA-256 of the list of base spans, the list of all spans.

    A span is kind:start:end in code points; spans may overlap. A null or empty text has none. Rows with a null or repeated
    doc_id each give a row; extra columns are ignored. Texts are searched whole, in one pass without a shuffle.
    """
    def scan(doc_ids, texts):
        for doc_id, text in zip(doc_ids, texts, strict=True):
            found = spans(text)
            base = [x for x in found if x[1] < 3]
            counts = [sum(k == n for _, k, _ in base) for n in range(3)]
            yield doc_id, *counts, hashlib.sha256(_listed(base).encode()).hexdigest(), _listed(found), len(found) - len(base)

    return map_rows(docs, ["doc_id", "text"], SCHEMA, lambda: scan)


MASK = "[secret]"


def without_secrets(docs: DataFrame) -> DataFrame:
    """`docs` with each secret in `text` replaced; where spans overlap, their union is. Other columns stay as they are."""
    def mask(text: str | None) -> str | None:
        out, at = [], 0
        for start, _, end in spans(text):
            if start >= at:
                out += [text[at:start], MASK]
            at = max(at, end)
        return "".join([*out, text[at:]]) if out else text

    masked = F.udf(mask, "string", useArrow=True)
    return docs.withColumn("text", masked("text"))
