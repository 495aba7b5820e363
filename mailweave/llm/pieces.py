"""Token ids of texts by a file of the ``tokenizers`` library, each cut encoded once.

A byte-level tokenizer first cuts the text by a pattern and then encodes every
cut by itself, so the ids of a cut are the same in every text. A worker keeps
the ids of the cuts it has met.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Sequence

import numpy as np
import regex

from mailweave.llm.common import claim

#: Cuts a worker remembers, about 150 bytes each: the first ones met, which are the
#: frequent ones, and none over `LONGEST` characters.
REMEMBERED = 300_000
LONGEST = 64

# The usual pattern of byte-level tokenizers, and what it comes to in texts
# of ASCII and Latin letters alone, where classes can be listed and need no Unicode tables.
_USUAL = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
_LETTERS, _SPACES = "A-Za-zÀ-ÖØ-öø-ſ", "\t-\r "
_OTHER = re.compile(f"[^{_SPACES}!-~À-ÖØ-öø-ſ]").search
_LATIN = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^{_SPACES}0-9{_LETTERS}]+"
    f"|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+"
).findall


def cutter(pattern: str) -> Callable[[str], list[str]]:
    """The function that cuts a text by ``pattern``."""
    general = regex.compile(pattern).findall
    if pattern != _USUAL:
        return general
    return lambda text: general(text) if _OTHER(text) else _LATIN(text)


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Known(dict):
    """Cut -> its ids as bytes; unknown cuts are encoded when they are looked up."""

    def __init__(self, model):
        super().__init__()
        self._model, self._letters = model, _byte_letters()

    def __missing__(self, cut: str) -> bytes:
        text = cut.encode().decode("latin-1").translate(self._letters)
        ids = np.array([token.id for token in self._model.tokenize(text)], "<u4").tobytes()
        if len(self) < REMEMBERED and len(cut) <= LONGEST:
            self[cut] = ids
        return ids


class CutIds:
    """Encoder of one byte-level tokenizer file. Special tokens in a text are ordinary text, or
    with ``added`` the tokens that the file adds, as the library has it by default."""

    def __init__(self, content: str, pattern: str, added: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._cut = cutter(pattern)
        self._ids = _Known(Tokenizer.from_str(content).model).__getitem__
        tokens = json.loads(content).get("added_tokens", []) if added else []
        self._added = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in tokens}
        longest = sorted(map(re.escape, self._added), key=len, reverse=True)
        self._parts = re.compile(f"({'|'.join(longest)})").split if longest else None

    def _encoded(self, text: str) -> bytes:
        return b"".join(map(self._ids, self._cut(text)))

    def _with_added(self, text: str) -> bytes:
        """What stands between added tokens is cut by itself."""
        parts = self._parts(text)
        return b"".join(self._added[x] if i % 2 else self._encoded(x) for i, x in enumerate(parts))

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        return list(map(self._with_added if self._parts else self._encoded, texts))


_encoders: dict[int, CutIds] = {}


def encoder(content: str, pattern: str, added: bool = False) -> CutIds:
    """The encoder of this worker; it is built once."""
    claim("pieces", _encoders.clear)
    key = hash((content, pattern, added))
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = CutIds(content, pattern, added)
    return _encoders[key]


def file_content(path: str) -> str:
    """A tokenizer file, read on the driver; a vocabulary has a fixed size."""
    with open(path, encoding="utf-8") as file:
        return file.read()
