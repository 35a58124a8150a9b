"""Byte-level BPE with a rank file: the tokenizers library on Arrow batches, there and back again.

The library works on characters, so each byte has a printable stand-in. A rank file names no merge pairs; every way to
split a token into two tokens is one, in the order of the ranks and for equal ranks the shorter left part first.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import mapped
from tidewire.llm.tokens import ChunkEncoder, byte_characters

#: Texts encoded together.
BATCH = 256


@lru_cache(4)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


@lru_cache(4)
def tokenizer(path: str, pattern: str):
    """The library's tokenizer for a rank file and a splitting pattern, without special tokens."""
    from tokenizers import Regex, Tokenizer, decoders, models, pre_tokenizers

    table, shown = ranks(path), byte_characters()

    def seen(token: bytes) -> str:
        return "".join(shown[b] for b in token)

    merges = [
        (seen(token[:i]), seen(token[i:]))
        for token in sorted(table, key=table.get)
        for i in range(1, len(token))
        if token[:i] in table and token[i:] in table
    ]
    made = Tokenizer(models.BPE(vocab={seen(t): r for t, r in table.items()}, merges=merges, ignore_merges=True))
    made.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
    )
    made.decoder = decoders.ByteLevel()
    return made


@lru_cache(4)
def _encoder(path: str, pattern: str) -> ChunkEncoder:
    made = tokenizer(path, pattern)
    sizes = np.array([len(token) for token in _decoding(path)], np.int64)
    return ChunkEncoder(lambda text: made.encode(text, add_special_tokens=False).ids, sizes)


@lru_cache(4)
def _decoding(path: str) -> list[bytes]:
    """Bytes of each id: the library's characters through the reversed byte table."""
    table = ranks(path)
    back = {character: byte for byte, character in enumerate(byte_characters())}
    out = [b""] * (max(table.values(), default=-1) + 1)
    for token, rank in table.items():
        out[rank] = bytes(back[c] for c in "".join(byte_characters()[b] for b in token))
    return out


def decode_bytes(ids: np.ndarray, path: str) -> bytes:
    """All bytes of the ids, also where a character is split between tokens or cut off."""
    return b"".join(map(_decoding(path).__getitem__, ids.tolist()))


def decode_pieces(ids: np.ndarray, path: str) -> list[str]:
    """Text each id completes: a character split over ids belongs to the last of them; broken bytes become U+FFFD."""
    reader = codecs.getincrementaldecoder("utf-8")("replace")
    out = [reader.decode(_decoding(path)[i]) for i in ids.tolist()]
    if (rest := reader.decode(b"", True)) and out:
        out[-1] += rest
    return out


def token_offsets(ids: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of each token in the UTF-8 text."""
    ends = np.cumsum([len(_decoding(path)[i]) for i in ids.tolist()], dtype=np.int64)
    return np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends, ends


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))


def encode(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids of each whole text and the byte offsets of its tokens: (key, ids, starts, ends).

    A null text is empty and has no ids; repeated rows come out as often as they go in; other columns are not carried.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = _encoder(path, pattern)
        for batch in batches:
            for i in range(0, batch.num_rows, BATCH):
                part = batch.slice(i, BATCH)
                ids = [np.frombuffer(b, "<u4").astype(np.int32) for b in made(part.column(1).to_pylist())]
                spans = [token_offsets(x, path) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.list_(pa.int32())), *(pa.array([s[j] for s in spans], pa.list_(pa.int64())) for j in (0, 1))],
                    names=[key, "ids", "starts", "ends"],
                )

    return mapped(_texts(docs, key, text), run, f"{key} long, ids array<int>, starts array<long>, ends array<long>")


def decode(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Bytes and text of each list of ids; null ids are none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [decode_bytes(np.asarray(x or [], np.int64), path) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(raw, pa.binary()), pa.array([r.decode("utf-8", "replace") for r in raw])], names=[key, "bytes", "text"]
            )

    return mapped(encoded.select(key, ids), run, f"{key} long, bytes binary, text string")


def round_trip(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encodes and decodes each text in one pass and keeps the digests: (key, n_tokens, ids_sha256, decoded_sha256).

    One row out for each row in: a null text is empty and has no tokens, texts of any length are encoded whole, repeated rows
    come out as often. There are no ties. An empty table gives no rows; other columns are not carried.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = _encoder(path, pattern)
        for batch in batches:
            for i in range(0, batch.num_rows, BATCH):
                part = batch.slice(i, BATCH)
                ids = made(part.column(1).to_pylist())
                back = [decode_bytes(np.frombuffer(b, "<u4"), path) for b in ids]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(b) // 4 for b in ids], pa.int64()),
                        pa.array([hashlib.sha256(b).hexdigest() for b in ids], pa.string()),
                        pa.array([hashlib.sha256(b).hexdigest() for b in back], pa.string()),
                    ],
                    names=[key, "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return mapped(_texts(docs, key, text), run, f"{key} long, n_tokens long, ids_sha256 string, decoded_sha256 string")
