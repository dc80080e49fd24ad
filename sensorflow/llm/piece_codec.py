"""SentencePiece encoding that keeps source offsets, and decoding.

A text is normalised by the longest prefixes of the model's compiled character map. Each normalised character remembers the
byte of the source it came from, so every piece has a span of source bytes. The pieces themselves are merged as the model's
scores ask for, on units of the normalised text that no merge can reach across; a worker keeps the pieces of units it has seen.
"""

from __future__ import annotations

import hashlib
import re
import struct
from array import array
from collections.abc import Callable
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import pairwise
from typing import NamedTuple

import numpy as np
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2

from sensorflow.llm.tasks import map_rows

MODEL = "piece_bpe_32k.model"
SPACE = "▁"  # fixed value: how such models write a blank
KEPT_UNITS = 500_000
KEPT_CHARS = 64
SHORT = 64  # characters of a unit merged without a heap
NEVER = float("inf")
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_bytes long, spanned_bytes long"
PIECES = "doc_id long, ids array<long>, begins array<long>, ends array<long>, decoded string"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def encode_documents(docs: DataFrame, path: str | None = None, digests: bool = False, bos: bool = True, eos: bool = True) -> DataFrame:
    """Pieces of every whole text: doc_id, ids, the source bytes [begin, end) of each piece, and the decoded text.

    With `digests`: doc_id, n_tokens, SHA-256 of the ids (little-endian, 32 bits) and of the decoded text (UTF-8), bytes of
    the text and bytes that spans cover. Begin and end ids have empty spans. A null text counts as empty: only begin and end
    ids. Rows with a null or repeated doc_id each give a row of their own; extra columns are left out; an empty table gives
    none. A text of any length is encoded whole; units are short wherever the text has a blank or a character that no
    longer piece contains, otherwise memory is linear in the unit. No shuffle.
    """
    path = path or default_path()
    return map_rows(docs, ["doc_id", "text"], DIGESTS if digests else PIECES, lambda: _encoder(path, digests, bos, eos))


def _encoder(path: str, digests: bool, bos: bool, eos: bool):
    m = model(path)

    def step(doc_ids, texts):
        for doc_id, text in zip(doc_ids, texts, strict=True):
            text = text or ""
            found = m.encode(text, bos, eos)
            ids = found.ids.tolist()
            decoded = m.library.decode(ids)
            if digests:
                yield (doc_id, len(ids), hashlib.sha256(found.ids.astype("<u4").tobytes()).hexdigest(),
                       hashlib.sha256(decoded.encode()).hexdigest(), len(text.encode()), int((found.ends - found.begins).sum()))
            else:
                yield doc_id, ids, found.begins.tolist(), found.ends.tolist(), decoded

    return step


class Encoding(NamedTuple):
    ids: np.ndarray
    begins: np.ndarray
    ends: np.ndarray


class CharacterMap:
    """The compiled map: a double-array trie over UTF-8 keys, then the zero-terminated replacements its values point to."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = array("I", np.frombuffer(blob, "<u4", size // 4, 4).tolist()) if blob else array("I")
        self.texts = blob[4 + size:]

    def __bool__(self) -> bool:
        return len(self.units) > 0

    def longest(self, data: bytes, at: int) -> tuple[int, str] | None:
        """Length of the longest key that begins at this byte, and what replaces it."""
        units, found, length = self.units, None, 0
        node = _offset(units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            unit = units[node] if node < len(units) else 0
            if unit & 0x800000FF != data[i]:
                break
            node ^= _offset(unit)
            if unit >> 8 & 1:
                found, length = units[node] & 0x7FFFFFFF, i + 1 - at
        if found is None:
            return None
        return length, self.texts[found:self.texts.index(b"\0", found)].decode()


def _offset(unit: int) -> int:
    return unit >> 10 << ((unit & 0x200) >> 6)


class Model:
    """A byte-pair model file with byte fallback. Other kinds are refused, not encoded wrongly."""

    def __init__(self, path: str):
        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        kinds = {p.piece: p.type for p in proto.pieces}
        piece = sentencepiece_model_pb2.ModelProto.SentencePiece
        trained, rules = proto.trainer_spec, proto.normalizer_spec
        if (trained.model_type != 2 or not trained.byte_fallback or trained.treat_whitespace_as_suffix
                or {piece.UNUSED, piece.USER_DEFINED} & set(kinds.values())):
            raise ValueError("a byte-pair model with byte fallback, without unused or user-defined pieces, is needed")
        self.library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        self.normalizer = Normalizer(CharacterMap(rules.precompiled_charsmap), rules.add_dummy_prefix, rules.remove_extra_whitespaces,
                                     rules.escape_whitespaces)
        ordered = [(p.score, i, p.piece) for i, p in enumerate(proto.pieces) if p.type == piece.NORMAL]
        self.ids = {p: i for _, i, p in ordered}
        self.score = {p: -s for s, _, p in ordered}
        self.bytes = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.begin, self.end = trained.bos_id, trained.eos_id
        self.units = Units(self)
        self._cut = _cutter(self.ids)

    def encode(self, text: str, bos: bool = False, eos: bool = False) -> Encoding:
        """Ids as the library gives them, and the source bytes [begin, end) of each."""
        plain, source = self.normalizer.normalize(text)
        made = np.frombuffer(b"".join(map(self.units.__getitem__, self._cut(plain))), "<u4")
        ids, ends = made[::2], np.cumsum(made[1::2], dtype=np.int64)
        places = source[np.concatenate([[0], ends])]
        begins, ends = places[:-1], places[1:]
        last = len(text.encode())
        head, tail = ([self.begin] if bos and self.begin >= 0 else []), ([self.end] if eos and self.end >= 0 else [])
        return Encoding(np.concatenate([head, ids, tail]).astype("<u4"),
                        np.concatenate([np.zeros(len(head), np.int64), begins, np.full(len(tail), last)]).astype(np.int64),
                        np.concatenate([np.zeros(len(head), np.int64), ends, np.full(len(tail), last)]).astype(np.int64))

    def merged(self, unit: str) -> list[str]:
        """The best-scored neighbours merge first, equal ones from the left."""
        return self._merged_short(unit) if len(unit) <= SHORT else self._merged_long(unit)

    def _merged_short(self, unit: str) -> list[str]:
        """By a look at all pairs for each merge."""
        pieces, score = list(unit), self.score.get
        ranks = [score(a + b, NEVER) for a, b in pairwise(unit)]
        while ranks and (best := min(ranks)) != NEVER:
            i = ranks.index(best)
            pieces[i] += pieces.pop(i + 1)
            del ranks[i]
            if i:
                ranks[i - 1] = score(pieces[i - 1] + pieces[i], NEVER)
            if i < len(ranks):
                ranks[i] = score(pieces[i] + pieces[i + 1], NEVER)
        return pieces

    def _merged_long(self, unit: str) -> list[str]:
        """By a heap over a linked list of strings, in n log n."""
        n, score = len(unit), self.score
        pieces: list[str] = list(unit)
        heap = [(score[p], i, 2) for i, p in enumerate(map("".join, pairwise(unit))) if p in score]
        if not heap:
            return pieces
        heapify(heap)
        after, before = array("q", range(1, n + 1)), array("q", range(-1, n - 1))
        while heap:
            _, place, size = heappop(heap)
            right = after[place]
            if not pieces[place] or right >= n or len(pieces[place]) + len(pieces[right]) != size:
                continue
            made = pieces[place] + pieces[right]
            if made not in score:
                continue
            pieces[place], pieces[right] = made, ""
            follower = after[place] = after[right]
            if follower < n:
                before[follower] = place
                joined = made + pieces[follower]
                if joined in score:
                    heappush(heap, (score[joined], place, len(joined)))
            previous = before[place]
            if previous >= 0:
                joined = pieces[previous] + made
                if joined in score:
                    heappush(heap, (score[joined], previous, len(joined)))
        return [p for p in pieces if p]


class Normalizer:
    """Longest-prefix replacement with a source byte for each character of the result, and one for its end."""

    def __init__(self, characters: CharacterMap, prefix: bool, squeeze: bool, escape: bool):
        self.characters, self.prefix, self.squeeze = characters, prefix, squeeze
        self.blank = SPACE if escape else " "

    def normalize(self, text: str) -> tuple[str, np.ndarray]:
        if not text:
            return "", np.zeros(1, np.int64)
        if not self.characters and not self.squeeze:
            head = self.blank if self.prefix else ""
            code = np.frombuffer(text.encode("utf-32-le"), "<u4")
            widths = 1 + (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF)
            return head + text.replace(" ", self.blank), np.concatenate([[0] * len(head), [0], np.cumsum(widths)]).astype(np.int64)
        return self._mapped(text.encode())

    def _prefix(self, data: bytes, at: int) -> tuple[int, str]:
        found = self.characters.longest(data, at) if self.characters else None
        if found:
            return found
        first = data[at]
        width = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
        return width, data[at:at + width].decode()

    def _mapped(self, data: bytes) -> tuple[str, np.ndarray]:
        made: list[str] = []
        source = array("q")
        at, blank_before = 0, self.squeeze  # leading blanks go
        if self.squeeze:
            while at < len(data) and (step := self._prefix(data, at))[1] == " ":
                at += step[0]
            if at == len(data):
                return "", np.zeros(1, np.int64)
        if self.prefix:
            made.append(" ")
            source.append(at)
        while at < len(data):
            width, text = self._prefix(data, at)
            if self.squeeze and blank_before:
                text = text.lstrip(" ")
            if text:
                made.append(text)
                source.extend([at] * len(text))
                blank_before = text.endswith(" ")
            at += width
        plain = "".join(made)
        if self.squeeze:
            short = plain.rstrip(" ")
            at = source[len(short)] if len(short) < len(plain) else at
            plain = short
            del source[len(short):]
        source.append(at)
        return plain.replace(" ", self.blank), np.frombuffer(source, np.int64)


def _cutter(ids: dict[str, int]) -> Callable[[str], list[str]]:
    """Cuts a normalised text where no piece reaches across, so units merge alike on their own.

    A merge across two characters needs a piece that holds them side by side. Blanks are cut from what is before them, and
    line ends and tabs from both sides, where the pieces of the model allow it.
    """
    longer = [p for p in ids if len(p) > 1]
    if any(SPACE in p.lstrip(SPACE) for p in longer):
        return lambda text: [text]
    lone = [c for c in "\n\t\r" if not any(c in p for p in longer)]
    find = re.compile(f"{SPACE}*[^{SPACE}{''.join(map(re.escape, lone))}]+|{SPACE}+" + (f"|[{''.join(map(re.escape, lone))}]" if lone else "")).findall

    def cut(text: str) -> list[str]:
        if SPACE * 2 in text or "\0" in text:
            return find(text)
        text = text.replace(SPACE, "\0" + SPACE)  # the same cuts, quicker; may leave empty units
        for c in lone:
            if c in text:
                text = text.replace(c, f"\0{c}\0")
        return text.split("\0")

    return cut


class Units(dict):
    """unit -> its ids, each with the characters it takes, as little-endian 32-bit integers; bounded."""

    def __init__(self, owner: Model):
        super().__init__()
        self.owner = owner

    def __missing__(self, unit: str) -> bytes:
        pairs: list[int] = []
        known, fallback = self.owner.ids.get, self.owner.bytes
        for piece in self.owner.merged(unit):
            if (i := known(piece)) is not None:
                pairs += (i, len(piece))
            else:  # the bytes of one character: the last one has its span
                for b in piece.encode():
                    pairs += (fallback[b], 0)
                pairs[-1] = 1
        made = struct.pack(f"<{len(pairs)}I", *pairs)
        if len(unit) <= KEPT_CHARS:
            if len(self) >= KEPT_UNITS:
                self.clear()
            self[unit] = made
        return made


@lru_cache(maxsize=2)
def model(path: str) -> Model:
    """Loaded once per Python worker."""
    return Model(path)
