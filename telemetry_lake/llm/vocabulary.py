"""Token ids of whole texts by the tokenizers library, with bounded caches of what it gave before.

A tokenizer works pre-token by pre-token, so the ids of a text are those of its pre-tokens in a row. Texts of plain
characters are cut into pre-tokens by the vocabulary's own rule (lower-cased ones at white space first), and each
distinct pre-token is given to the library's model once. Texts with any other character, or with what may be a special
string, go to the library whole.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable, Sequence

import numpy as np

# Latin letters whose case, composition and class are the same in every Unicode version.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
NOT_PLAIN = re.compile(rf"[^ -~\n{LETTERS}]")
ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"

# The pre-token rules of the two vocabularies, for plain characters.
WITH_SPACE = re.compile(rf"{ENDINGS}| ?[{LETTERS}]+| ?[0-9]+| ?[^\s0-9{LETTERS}]+|\s+(?!\S)|\s+")
LOWERED = re.compile(rf"{ENDINGS}|[{LETTERS}]+|[0-9]|[^\s0-9{LETTERS}]+")


def byte_letters() -> dict[int, str]:
    """The printable stand-in of every byte in byte-level vocabularies: itself where printable, else 256 and up."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class Recent(dict):
    """Results of a function for the keys met of late: a full table becomes the old one, which is asked before making."""

    def __init__(self, make: Callable[[str], bytes], limit: int):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key: str) -> bytes:
        found = self.old.pop(key, None)
        if found is None:
            found = self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = found
        return found


class Vocabulary:
    """A tokenizer file of the tokenizers library; ``encode`` gives ids without special tokens being added.

    ``limit`` bounds the entries of each cache; it changes no result.
    """

    def __init__(self, path: str, limit: int = 200_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.stand_in = byte_letters()
        self.marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        rule, changed = self.tokenizer.pre_tokenizer, self.tokenizer.normalizer
        self.lowers = isinstance(changed, normalizers.Sequence) and isinstance(rule, pre_tokenizers.Sequence)
        self.cuts = self.lowers or (changed is None and isinstance(rule, pre_tokenizers.ByteLevel))
        self.tokens = Recent(self._token, 2 * limit)
        self.chunks = Recent(self._cut, limit)

    def _token(self, token: str) -> bytes:
        spelled = token.encode().decode("latin-1").translate(self.stand_in)
        ids = [t.id for t in self.model.tokenize(spelled)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _cut(self, text: str) -> bytes:
        return b"".join(map(self.tokens.__getitem__, (LOWERED if self.lowers else WITH_SPACE).findall(text)))

    def encode(self, text: str) -> np.ndarray:
        """Ids of one text, unsigned 32-bit."""
        if not self.cuts or NOT_PLAIN.search(text) or any(m in text for m in self.marks):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        if self.lowers:
            found = b"".join(map(self.chunks.__getitem__, text.lower().split()))
        else:
            found = self._cut(text)
        return np.frombuffer(found, "<u4")

    def encode_all(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        return [self.encode(t or "") for t in texts]


_LOADED: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, loaded once per Python worker; a worker holds one at a time."""
    if path not in _LOADED:
        release()
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


def release() -> None:
    """Drop the vocabulary that this Python worker holds, with its caches of some 150 MB.

    Workers outlive a stage, so tasks that need memory and no vocabulary call this first.
    """
    _LOADED.clear()
