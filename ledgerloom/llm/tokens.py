"""Token ids of whole texts with a public tokenizer file, each distinct word encoded once per worker.

A byte pair encoder never merges across a change from a visible character to white space: such a
place ends a pre-token whatever stands around it. So a text is cut there, and the ids of each piece
come out of a bounded table; only new pieces go through the tokenizers library's model, those of
byte-level files part by part, as a new piece often is a known word beside a comma or a line end. Special
tokens of the file that stand in a text get their own ids, as in the library, unless
``special_as_text`` asks for the ids of their letters.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

# Pre-token patterns of the two supported kinds of file (fixed values).
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Pieces of text that start where white space follows a visible character.
PIECES = re.compile(r"\s*\S+|\s+")

#: White space for Python, but not for the library's patterns.
_ODD = ("\x1c", "\x1d", "\x1e", "\x1f")

#: Beyond the Latin letters character classes depend on the Unicode version, so the library splits the piece itself.
_LATIN = "\u024f"

CACHED_PIECES = 1_000_000


def _latin_byte_pattern() -> str:
    """BYTE_PATTERN for texts up to the last Latin letter, its classes written out: ``re`` is faster than ``regex``."""
    upto = [chr(code) for code in range(ord(_LATIN) + 1)]
    letters, numbers = ("".join(c for c in upto if unicodedata.category(c)[0] == kind) for kind in "LN")
    apart = BYTE_PATTERN.replace(r"[^\s\p{L}\p{N}]", rf"[^\s{letters}{numbers}]")
    return apart.replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{numbers}]")


def _byte_letters() -> dict[int, str]:
    """The visible character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class _NeedsWholeText(Exception):
    pass


class _Pieces(dict):
    """Ids of pieces as bytes, filled on first use and emptied when full."""

    def __init__(self, encode, prefix: str, strict: bool, most: int):
        self._encode, self._prefix, self._strict, self._most = encode, prefix, strict, most

    def __missing__(self, piece: str) -> bytes:
        if self._strict and (not piece or piece[-1].isspace()):
            raise _NeedsWholeText
        ids = self._encode(self._prefix + piece)
        if len(piece) <= 64:
            if len(self) >= self._most:
                self.clear()
            self[piece] = ids
        return ids


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit numbers, equal to the library's on the whole text."""

    def __init__(self, path: str, cached_pieces: int = CACHED_PIECES, special_as_text: bool = False):
        self._whole = Tokenizer.from_file(path)
        self._whole.encode_special_tokens = special_as_text
        self._model = self._whole.model
        self._letters = _byte_letters()
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        added = described.get("added_tokens") or []
        special = [] if special_as_text else [re.escape(token["content"]) for token in added]
        self._special = re.compile("|".join(special) or r"(?!)").search
        # Only tokens without white space, found letter by letter, lie within a piece.
        plain = all(
            not re.search(r"\s", token["content"]) and not any(token[k] for k in ("single_word", "lstrip", "rstrip", "normalized"))
            for token in added
        )
        split = described.get("pre_tokenizer") or {}
        normal = described.get("normalizer")
        steps = [s.get("type") for s in split.get("pretokenizers", [])]
        normals = [s.get("type") for s in (normal or {}).get("normalizers", [])]
        if not plain:
            self.kind, self._pattern = "other", None
        elif split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space") and normal is None:
            self.kind, self._pattern = "bytes", re.compile(_latin_byte_pattern())
        elif (
            steps == ["Split", "ByteLevel"]
            and normals == ["NFC", "Replace", "Lowercase"]
            and split["pretokenizers"][0]["pattern"].get("Regex") == WORD_PATTERN
        ):
            self.kind, self._pattern = "words", regex.compile(WORD_PATTERN)
        else:
            self.kind, self._pattern = "other", None
        self._spaced = _Pieces(self._encode_piece, " ", True, cached_pieces)
        self._plain = _Pieces(self._encode_piece, "", False, cached_pieces)

    def _encode_piece(self, piece: str) -> bytes:
        if (not piece.isascii() and max(piece) > _LATIN) or self._special(piece):
            return self._encode_whole(piece)
        if self.kind == "words":
            return b"".join(map(self._encode_part, self._pattern.findall(unicodedata.normalize("NFC", piece).lower())))
        parts = self._pattern.findall(piece)
        if len(parts) == 1:
            return self._encode_part(piece)
        spaced, plain = self._spaced, self._plain
        return b"".join([spaced[part[1:]] if part[0] == " " and not part.isspace() else plain[part] for part in parts])

    def _encode_part(self, part: str) -> bytes:
        if part.isascii() and part.isprintable():  # only the space has another letter
            letters = part.replace(" ", self._letters[0x20])
        else:
            letters = part.encode().decode("latin-1").translate(self._letters)
        return b"".join([token.id.to_bytes(4, "little") for token in self._model.tokenize(letters)])

    def _encode_whole(self, text: str) -> bytes:
        return np.asarray(self._whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode_bytes(self, text: str) -> bytes:
        if not text:
            return b""
        if self.kind == "other" or any(c in text for c in _ODD):
            return self._encode_whole(text)
        if self.kind == "words":
            return b"".join(map(self._plain.__getitem__, text.split()))
        first, *rest = text.split(" ")
        if first and not first[-1].isspace():
            try:
                return self._plain[first] + b"".join(map(self._spaced.__getitem__, rest))
            except _NeedsWholeText:
                pass
        return b"".join(map(self._plain.__getitem__, PIECES.findall(text)))

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """``encode_bytes`` of each text; each distinct piece of all texts is looked up once for byte-level files.

        Arrow holds the texts twice and tells their pieces apart, so give some MB of texts at once.
        """
        done: list[bytes | None] = [None] * len(texts)
        places, firsts, rests = [], [], []
        if self.kind == "bytes":
            for place, text in enumerate(texts):
                first, blank, rest = text.partition(" ")
                if blank and not any(c in text for c in _ODD):
                    places.append(place)
                    firsts.append(first)
                    rests.append(rest)
        if places:
            split = pc.split_pattern(pa.array(rests, pa.large_string()), " ")
            coded = split.values.dictionary_encode()
            pieces = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
            ids, odd = np.empty(len(pieces), object), np.zeros(len(pieces), bool)
            for number, piece in enumerate(pieces):
                try:
                    ids[number] = self._spaced[piece]
                except _NeedsWholeText:
                    odd[number] = True
            codes, edges = coded.indices.to_numpy(), split.offsets.to_numpy()
            with_odd = np.logical_or.reduceat(odd[codes], edges[:-1]).tolist()
            edges = edges.tolist()
            for place, first, low, high, some_odd in zip(places, firsts, edges, edges[1:], with_odd, strict=False):
                if first and not first[-1].isspace() and not some_odd:
                    done[place] = self._plain[first] + b"".join(ids[codes[low:high]].tolist())
                else:
                    done[place] = b"".join(self._joined(first, codes[low:high].tolist(), pieces, ids))
        return [self.encode_bytes(text) if data is None else data for text, data in zip(texts, done, strict=True)]

    def _joined(self, first: str, codes: list[int], pieces: list[str], ids: np.ndarray) -> Iterator[bytes]:
        """Ids of a text's pieces; one that ends in white space (no ids) is encoded with those up to the next visible end."""
        waiting: list[str] = [first]
        if first and not first[-1].isspace():
            yield self._plain[first]
            waiting = []
        for code in codes:
            if ids[code] is None:
                waiting.append(" " + pieces[code])
            elif waiting:
                yield self._plain["".join([*waiting, " ", pieces[code]])]
                waiting = []
            else:
                yield ids[code]
        if waiting:
            yield self._plain["".join(waiting)]

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encode_bytes(text), "<u4")

    def count(self, text: str) -> int:
        return len(self.encode_bytes(text)) // 4


@lru_cache(maxsize=4)
def encoder(path: str, cached_pieces: int = CACHED_PIECES, special_as_text: bool = False) -> Encoder:
    """One encoder per worker process and file."""
    return Encoder(path, cached_pieces, special_as_text)
