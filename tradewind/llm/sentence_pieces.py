"""SentencePiece encoding and decoding by a table of distinct chunks.

A chunk is a run of whitespace markers with what follows up to the next marker. If no piece has a marker after another character,
no merge crosses from one chunk to the next, so a text's ids are its chunks' ids in sequence, and every distinct chunk is segmented once.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from sentencepiece import SentencePieceProcessor

from tradewind.llm import word_table
from tradewind.llm.word_table import Codec, Result

MARKER = "▁"
_CHUNKS = re.compile(f"{MARKER}+[^{MARKER}]*|[^{MARKER}]+")
_CROSSING = re.compile(f"[^{MARKER}]{MARKER}")


def _model(path: str) -> SentencePieceProcessor:
    return SentencePieceProcessor(model_file=path)


def pieces(model: SentencePieceProcessor) -> list[tuple[int, bytes]]:
    """Ids with the bytes that they stand for: a marker is a space, a byte piece its byte; control pieces stand for nothing."""
    def of(i: int) -> bytes:
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            return bytes([int(piece[3:-1], 16)])
        if model.is_control(i):
            return b""
        return model.decode([i]).encode() if model.is_unknown(i) else piece.replace(MARKER, " ").encode()

    return [(i, of(i)) for i in range(model.get_piece_size())]


def _prefixed(model: SentencePieceProcessor) -> bool:
    """Whether a marker is put before a text."""
    if model.normalize("a") not in ("a", f"{MARKER}a"):
        raise ValueError("only models with markers before words are supported")
    return model.normalize("a") != "a"


def codec(path: str) -> Codec:
    """A model whose pieces cross no marker; another one is refused."""
    model = _model(path)
    if any(_CROSSING.search(model.id_to_piece(i)) for i in range(model.get_piece_size())):
        raise ValueError("a piece of this model crosses a whitespace marker")
    prefixed = _prefixed(model)

    def splitter() -> Callable[[str], list[str]]:
        normalize, find = _model(path).normalize, _CHUNKS.findall
        return lambda text: find(normalize(text))

    def encoder() -> Callable[[list[str]], list[list[int]]]:
        model = _model(path)
        # A marker with nothing behind it can't be given to the model alone, as it is put before any text.
        lone = model.encode("a ")[len(model.encode("a")):]

        def encode(chunks: list[str]) -> list[list[int]]:
            texts = [(c[1:] if prefixed else c).replace(MARKER, " ") for c in chunks]
            if any(n != c for n, c in zip(model.normalize(texts), chunks) if c != MARKER):
                raise ValueError("a chunk of a normalized text changes when normalized again")
            return [lone if c == MARKER else ids for c, ids in zip(chunks, model.encode(texts, num_threads=1))]

        return encode

    def text(data: bytes) -> str:
        whole = data.decode("utf-8", "replace")
        return whole[1:] if prefixed and whole.startswith(" ") else whole

    return Codec(splitter, encoder, pieces(model), text)


def digests() -> Result:
    def make(ends: np.ndarray, ids: np.ndarray, texts: list[str]) -> list[pa.Array]:
        listed = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        return [pa.array(np.diff(ends), pa.int64()), pa.array([hashlib.sha256(x.encode()).hexdigest() for x in listed], pa.string()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string())]

    return Result("n_tokens bigint, ids_sha256 string, decoded_sha256 string", make)


def tokenize(docs: DataFrame, path: str, result: Result | None = None, chars: int = word_table.BLOCK_CHARS, buckets: int | None = None) -> DataFrame:
    """``doc_id``, ``ids`` and ``decoded`` of each document, or the columns of ``result`` (``digests()``).

    ``docs`` needs ``doc_id`` and ``text``; other columns, whatever their names, are left out. Ids are those of the sentencepiece
    library for the model at ``path`` (which every executor must have), without begin and end ids and without sampling; ``decoded`` is
    what they stand for. A null or empty text has no ids and decodes to an empty text. A text of any length is encoded whole. Repeated
    rows, also with one id or none, stay rows of their own; an empty table gives no rows.
    """
    return word_table.tokenize(docs, codec(path), result, chars, buckets)
