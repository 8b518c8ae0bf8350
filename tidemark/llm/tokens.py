"""Token ids of whole texts by a given tokenizer file, encoded word by word with a memo.

The pre-tokenizers of the supported files never join characters over white space, so the ids of a
text are the ids of its white-space separated units in a row. Words repeat: a unit is encoded by the
library once per worker and looked up afterwards. A plain word goes straight to the library's model.
The memo is cleared at a fixed size. Texts are split at the file's added tokens first, as the library does.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache

from tokenizers import Tokenizer

#: White space as the tokenizers' patterns see it (the Unicode property White_Space).
SPACE = "\t-\r \x85\xa0  -     　"
MEMO_UNITS, LONGEST_UNIT = 1_000_000, 40


#: Letters and punctuation of plain words: the tokenizers' patterns never split the one and always split
#: between the two, and normalisers change nothing but the case.
LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
PUNCTUATION = r"!-/:-@\[-`{-~"


def _byte_letters() -> dict[int, str]:
    """The character that byte-level vocabularies write for each byte: itself if it is printable."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class _Memo(dict):
    """Ids by unit; a unit that is missing is encoded."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, unit: str) -> bytes:
        ids = self.encode(unit)
        if len(unit) <= LONGEST_UNIT:
            self[unit] = ids
        return ids


class Encoder:
    """Texts to token ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        keeps_space = (file.get("pre_tokenizer") or {}).get("type") == "ByteLevel"
        self.tokenizer = Tokenizer.from_file(path)
        added = file.get("added_tokens") or []
        if any(x[k] for x in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"{path}: an added token that depends on the text around it or is normalised")
        self.added = {x["content"]: array("I", [x["id"]]).tobytes() for x in added}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.at_added = re.compile(f"({'|'.join(map(re.escape, longest_first))})").split
        self.model, self.lower, self.letters = self.tokenizer.model, not keeps_space, _byte_letters()
        lead, any_space = (" ?", f"[{SPACE}]*") if keeps_space else ("", "")
        after = f"(?=[{SPACE}{PUNCTUATION}]|\\Z)"
        # A word, the punctuation that ends it, or whatever else stands between white space.
        self.units = re.compile(
            f"{lead}[{LETTER}]+{after}|(?<=[{LETTER}])[{PUNCTUATION}]+(?=[{SPACE}]|\\Z)|{any_space}[^{SPACE}]+" + (f"|[{SPACE}]+" if keeps_space else "")
        ).findall
        self.plain = re.compile(f"{lead}[{LETTER}]+|[{PUNCTUATION}]+").fullmatch
        self.memo, self.chunks = _Memo(self._encode), _Memo(self._encode_chunk)
        self.odd = re.compile("[\x1c-\x1f]").search  # white space to str.split alone

    def _encode(self, unit: str) -> bytes:
        if self.plain(unit) and "'" not in unit:  # one word of the vocabulary's own alphabet
            unit = unit.lower() if self.lower else unit
            if unit.isascii():  # only the space is written otherwise
                unit = unit.replace(" ", self.letters[32])
            else:
                unit = unit.encode().decode("latin-1").translate(self.letters)
            found = self.model.tokenize(unit)
            return array("I", [x.id for x in found]).tobytes()
        return array("I", self.tokenizer.encode(unit, add_special_tokens=False).ids).tobytes()

    def _encode_chunk(self, chunk: str) -> bytes:
        """Ids of what stands between white space, for vocabularies that don't keep it."""
        units = self.units(chunk)
        return self._encode(chunk) if len(units) == 1 else b"".join(map(self.chunks.__getitem__, units))

    def _ids(self, text: str) -> bytes:
        if self.odd(text) or not self.lower:
            return b"".join(map(self.memo.__getitem__, self.units(text)))
        return b"".join(map(self.chunks.__getitem__, text.split()))

    def _parts(self, text: str) -> bytes:
        """Ids of a text that may hold added tokens: what stands between them is encoded on its own."""
        if not any(x in text for x in self.added):
            return self._ids(text)
        return b"".join(self.added[x] if i % 2 else self._ids(x) for i, x in enumerate(self.at_added(text)) if x)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        out = [self._parts(x) for x in texts]
        if len(self.memo) + len(self.chunks) > MEMO_UNITS:
            self.memo.clear()
            self.chunks.clear()
        return out


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per worker and file."""
    return Encoder(path)


@lru_cache(maxsize=4)
def vocabulary_size(path: str) -> int:
    """One more than the largest id of the file."""
    return max(Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values()) + 1
