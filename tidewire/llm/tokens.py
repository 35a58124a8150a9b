"""Byte-level BPE over whole texts with a bounded cache of chunks.

A chunk starts at a blank or newline that follows a non-space character. No match of the splitting pattern spans such a
place, and merges stay inside matches, so chunks encoded one by one give the ids of the whole text.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import public_tokenizers

#: Chunks kept by a task before it starts over with those that come again, and their longest length; longer ones are
#: encoded each time.
CACHE_CHUNKS, CACHE_CHARS = 300_000, 40
#: Characters encoded in one call when a text has other spaces than blanks and newlines.
PIECE = 1 << 16

# A chunk may also end between a letter and a punctuation mark: there the pattern changes class.
_CHUNKS = re.compile(r"[ \n]*[A-Za-zÀ-ÖØ-öø-ÿ]++(?=[.,;:!?])|[ \n]*[^ \n]+|[ \n]+$").findall
_OTHER_SPACE = re.compile(r"[^\S \n]").search
_CUT = re.compile(r"(?<=\S)[ \n]")


def chunks(text: str) -> list[str]:
    """Parts of a text that encode independently; joined they are the text."""
    if not _OTHER_SPACE(text):
        return _CHUNKS(text)
    out, start = [], 0
    while start < len(text):
        cut = _CUT.search(text, start + PIECE)
        end = cut.start() if cut else len(text)
        out.append(text[start:end])
        start = end
    return out


class ChunkEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes.

    ``encode`` gives the ids of one text and ``sizes`` the bytes of each id. New chunks are encoded joined: each starts with
    a space after a non-space, where the text could be cut, so the ids fall apart at the chunks' ends.
    """

    def __init__(self, encode: Callable[[str], list[int]], sizes: np.ndarray):
        self._encode, self._sizes = encode, sizes
        self._cache: dict[str, bytes] = {}
        self._before: dict[str, bytes] = {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        parts = [chunks(t) for t in texts]
        if len(self._cache) > CACHE_CHUNKS:
            self._before, self._cache = self._cache, {}
        cache, before = self._cache, self._before
        missing = set().union(*parts) - cache.keys()
        if before:
            again = missing & before.keys()
            cache.update({c: before[c] for c in again})
            missing -= again
        extra: dict[str, bytes] = {}
        joined: list[str] = []
        size = 0
        for chunk in missing:
            if len(chunk) > CACHE_CHARS:
                extra[chunk] = self._one(chunk)
            elif chunk[0] in " \n" and not chunk[-1].isspace():
                joined.append(chunk)
                size += len(chunk)
                if size > PIECE:
                    self._many(joined, cache)
                    joined, size = [], 0
            else:
                cache[chunk] = self._one(chunk)
        self._many(joined, cache)
        if not extra:
            return [b"".join(map(cache.__getitem__, p)) for p in parts]
        return [b"".join([cache[c] if c in cache else extra[c] for c in p]) for p in parts]

    def _one(self, text: str) -> bytes:
        return np.asarray(self._encode(text), "<u4").tobytes()

    def _many(self, some: list[str], cache: dict[str, bytes]) -> None:
        if not some:
            return
        ids = np.asarray(self._encode("".join(some)), "<u4")
        raw, ends = ids.tobytes(), np.cumsum(self._sizes[ids])
        at = 4 * (np.searchsorted(ends, np.cumsum([len(c.encode()) for c in some])) + 1)
        start = 0
        for chunk, end in zip(some, at.tolist(), strict=True):
            cache[chunk] = raw[start:end]
            start = end


@lru_cache(1)
def byte_characters() -> tuple[str, ...]:
    """The character that stands for each byte: itself if printable, else one from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return tuple(chr(b if b in shown else next(spare)) for b in range(256))


@lru_cache(2)
def file_ranks(path: str) -> dict[bytes, int]:
    """Bytes and ids of the entries of a byte-level BPE file of the tokenizers library, without its added tokens."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    back = {character: byte for byte, character in enumerate(byte_characters())}
    merged = {"".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]}
    return {bytes(back[c] for c in token): i for token, i in model["vocab"].items() if len(token) == 1 or token in merged}


@lru_cache(2)
def file_encoder(path: str) -> Callable[[str], list[int]]:
    """Ids of a text by such a file, special tokens as plain text.

    The file numbers its bytes and merges in the order of their ranks, which is all that tiktoken's encoder needs; it
    gives the same ids in a third of the time (tests compare them).
    """
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=file_ranks(path), special_tokens={}).encode_ordinary
