"""Token ids of texts by a vocabulary file of the ``tokenizers`` library, with a bounded cache of words.

``Tokenizer.encode`` spends most of its time on normalising and splitting. For texts of ASCII and Latin letters both
are one pass of a regular expression here, and each distinct word goes through the vocabulary's model once while it
stays in the cache. Any other text, and any text in which a special token could be spelled, is encoded by the library.
The shortcut is taken only for a vocabulary whose normaliser and splitter are the ones it stands for.
"""

from __future__ import annotations

import json
import re

import numpy as np
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

_LATIN = "".join(chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7))
_PLAIN = ("\n\t\r" + "".join(map(chr, range(0x20, 0x7F))) + _LATIN).encode("latin-1")
_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[a-z{_LATIN}]+|[0-9]|[^\sa-z{_LATIN}0-9]+")
#: How byte-level vocabularies spell the letters beyond ASCII.
_SPELLED = {ord(c): ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(c)[0][0] for c in _LATIN}

# The normaliser and splitter that the shortcut stands for.
_NORMALISERS = ["NFC", ("Replace", r"\s+", " "), "Lowercase"]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

CACHE_WORDS = 400_000


class Encoder:
    """Ids of a text as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.cache: dict[str, bytes] = {}
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        steps = [
            s["type"] if s["type"] != "Replace" else ("Replace", s["pattern"].get("Regex"), s["content"])
            for s in (spec.get("normalizer") or {}).get("normalizers", [])
        ]
        first, *rest = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        self.shortcut = (
            steps == _NORMALISERS
            and first.get("pattern") == {"Regex": _SPLIT}
            and [r["type"] for r in rest] == ["ByteLevel"]
            and not rest[0]["add_prefix_space"]
        )
        # A special token is spelled only where all its characters are; its first two are tested.
        self.special = {t["content"][:2] for t in spec.get("added_tokens", [])}

    def _word(self, word: str) -> bytes:
        spelled = word if word.isascii() else word.translate(_SPELLED)
        ids = np.array([t.id for t in self.model.tokenize(spelled)], "<u4").tobytes()
        if len(self.cache) >= CACHE_WORDS:
            self.cache.clear()
        self.cache[word] = ids
        return ids

    def __call__(self, text: str) -> bytes:
        if self.shortcut and not any(s in text for s in self.special):
            try:
                plain = not text.encode("latin-1").translate(None, _PLAIN)
            except UnicodeEncodeError:
                plain = False
            if plain:
                known, word = self.cache.get, self._word
                return b"".join([known(w) or word(w) for w in _WORDS.findall(text.lower())])
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker and vocabulary."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
