"""Pre-tokens and merge ranks of a `tokenizers` BPE file with word ends.

White space never is part of a token of such a file, so the text between two white spaces is tokenized on its own. Each
such word is normalized and split by the library once and kept; `Words` holds what `solve` makes of its parts.
"""

from __future__ import annotations

import json
import posixpath
import re
from collections.abc import Callable
from functools import lru_cache
from typing import Any

import regex
from tokenizers import Tokenizer

from sensorflow.llm.merging import Merges

TOKENIZER = "word_bpe_49k.json"
KEPT_WORDS = 500_000
KEPT_CHARS = 64

# Up to U+024F, normal form C and lower case of a text can be taken before it is split. U+0130 grows a combining dot.
_SIMPLE = re.compile("[İɐ-\U0010ffff]")
# Fixed value: the split pattern of the vocabulary file.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PARTS = regex.compile(_PATTERN)
# All of these are white space for the library too. Others stay inside a word and are left to the library.
_BLANK = re.compile("[ \t\n\r\x0b\x0c]+")
# str.split also cuts at these, which the library does not count as white space.
_NO_BLANKS = "\x1c\x1d\x1e\x1f"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


class Vocabulary:
    """What the operators need of a vocabulary file: parts of a word, merge ranks, ids and token strings."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("unk_token") or not model.get("end_of_word_suffix"):
            raise ValueError("a BPE file with word ends and without an unknown token is needed")
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.end = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.merges = Merges([tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]], self.ids)
        self.strings = {i: s for s, i in {**self.ids, **self.specials}.items()}
        self.simple = any(s.get("pattern") == {"Regex": _PATTERN} for s in spec["pre_tokenizer"].get("pretokenizers", []))
        self._marker = posixpath.commonprefix(list(self.specials)).lower()
        self._special = re.compile("|".join(map(re.escape, self.specials))) if self.specials else None
        self._bytes = _byte_letters()

    def spelled(self, part: str) -> str:
        """The bytes of a part as the letters the merges are written in."""
        return part if part.isascii() and part.isprintable() else "".join(self._bytes[b] for b in part.encode())

    def parts(self, word: str, lowered: bool) -> list[str | int]:
        """Spelled parts of a word, and the ids of special strings inside it."""
        if not lowered and self._special and self._special.search(word):
            found: list[str | int] = []
            at = 0
            for m in self._special.finditer(word):
                found += self.parts(word[at:m.start()], lowered) if m.start() > at else []
                found.append(self.specials[m.group()])
                at = m.end()
            return found + (self.parts(word[at:], lowered) if at < len(word) else [])
        if lowered and self.simple:
            return [self.spelled(p) for p in _PARTS.findall(word)]
        return [p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(word))]

    def symbols(self, spelled: str) -> list[int]:
        """One symbol per byte, the last with the mark of a word's end. Like the library, leaves out unknown ones."""
        known = self.ids.get
        made = [known(c) for c in spelled[:-1]]
        made.append(known(spelled[-1] + self.end))
        return made if None not in made else [s for s in made if s is not None]

    def words(self, text: str) -> tuple[list[str], bool]:
        """The words of a text, and whether they are lower-cased already, which is done where it changes nothing else.

        Special strings are found before lower-casing, so a text that may hold one in some case is left as it is.
        """
        simple = self.simple and (text.isascii() or not _SIMPLE.search(text))
        if simple:
            lower = text.lower()
            simple = not self.specials or self._marker not in lower
            text = lower if simple else text
        return (_BLANK.split(text) if any(c in text for c in _NO_BLANKS) else text.split()), simple


def _byte_letters() -> dict[int, str]:
    """Printable bytes stand for themselves, the others for the letters from U+0100 on: the public byte-level alphabet."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """Loaded once per Python worker."""
    return Vocabulary(path)


class Words(dict):
    """word -> what `solve` makes of its parts; bounded, so a worker's memory does not grow with its input."""

    def __init__(self, solve: Callable[[str, bool], Any]):
        super().__init__()
        self.solve = solve
        self.lowered = False

    def __missing__(self, word: str) -> Any:
        made = self.solve(word, self.lowered)
        if len(word) <= KEPT_CHARS:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = made
        return made
