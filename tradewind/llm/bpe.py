"""Byte-level BPE by a table of distinct words: every distinct word is encoded once, ids are joined back by position, and decoded
through a join of ids and pieces."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from tradewind.llm import word_table
from tradewind.llm.word_table import BLOCK_CHARS, Codec, Result

#: Fixed value: the pattern at which this family of tokenizers splits a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=2)
def _file(path: str) -> dict:
    with open(path, encoding="utf-8") as source:
        return json.load(source)


def special_tokens(path: str) -> dict[str, int]:
    """Added tokens; they are found in a text before it is split into words. The longest is tried first."""
    added = _file(path)["added_tokens"]
    plain = {"single_word": False, "lstrip": False, "rstrip": False, "normalized": False}
    if any(a[k] != v for a in added for k, v in plain.items()):
        raise ValueError("only added tokens that match as they stand are supported")
    return {a["content"]: a["id"] for a in sorted(added, key=lambda a: -len(a["content"]))}


def pieces(path: str) -> list[tuple[int, bytes]]:
    """Ids with the bytes that they stand for: the vocabulary's size, so safe to broadcast."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    byte_of = {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(rest)}
    special = {i: s.encode() for s, i in special_tokens(path).items()}
    own = {i: bytes(byte_of[c] for c in s) for s, i in _file(path)["model"]["vocab"].items() if i not in special}
    return sorted({**own, **special}.items())


def _word_encoder(path: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    # A word comes alone, so it isn't split again.
    tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return tokenizer


def splitter(special: list[str]) -> Callable[[str], list[str]]:
    """Words of a text, whose concatenation is the text; special tokens are words of their own."""
    find = regex.compile(WORDS).findall
    if not special:
        return find
    at = regex.compile("(" + "|".join(map(regex.escape, special)) + ")")

    def split(text: str) -> list[str]:
        parts = at.split(text)
        if len(parts) == 1:
            return find(text)
        return [w for n, part in enumerate(parts) for w in ([part] if n % 2 else find(part))]

    return split


def codec(path: str) -> Codec:
    special = special_tokens(path)

    def encoder() -> Callable[[list[str]], list[list[int]]]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode = _word_encoder(path).encode_batch_fast

        def ids(words: list[str]) -> list[list[int]]:
            return [[special[w]] if w in special else e.ids for w, e in zip(words, encode(words, add_special_tokens=False))]

        return ids

    return Codec(lambda: splitter(list(special)), encoder, pieces(path), lambda data: data.decode("utf-8", "replace"))


def digests() -> Result:
    def make(ends: np.ndarray, ids: np.ndarray, texts: list[str]) -> list[pa.Array]:
        raw = ids.astype("<u4").tobytes()
        return [pa.array(np.diff(ends), pa.int64()),
                pa.array([hashlib.sha256(raw[4 * a:4 * b]).hexdigest() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())], pa.string()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string())]

    return Result("n_tokens bigint, ids_sha256 string, decoded_sha256 string", make)


def tokenize(docs: DataFrame, path: str, chars: int = BLOCK_CHARS, buckets: int | None = None, result: Result | None = None) -> DataFrame:
    """``doc_id``, ``ids`` and ``decoded`` of each document, or the columns of ``result`` (``digests()``).

    ``docs`` needs ``doc_id`` and ``text``; other columns are left out. Ids are those of the tokenizers library for the file at ``path``
    (which every executor must have) without added special tokens, truncation or padding, and ``decoded`` is what they stand for,
    invalid UTF-8 replaced. A null or empty text has no ids, and a text of any length is encoded whole. Repeated rows, also with one id
    or none, stay rows of their own; an empty table gives no rows. How it runs: ``word_table``.
    """
    return word_table.tokenize(docs, codec(path), result, chars, buckets)


def _text(data: Column) -> Column:
    """UTF-8 with replacements. Spark's own functions reject invalid bytes or keep them, so those few go through Python."""
    @F.pandas_udf("string")
    def replaced(values: pd.Series) -> pd.Series:
        return values.map(lambda b: b.decode("utf-8", "replace"), na_action="ignore")

    return F.when(F.is_valid_utf8(data.cast("string")), data.cast("string")).otherwise(replaced(data))


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """``tokens`` (any columns, and ``ids``) with ``decoded``, by a join of ids and pieces.

    Each distinct list of ids is decoded once. A null list stays null, an empty one gives an empty text; an id that the vocabulary
    lacks gives nothing; invalid UTF-8 is replaced.
    """
    vocabulary = F.broadcast(tokens.sparkSession.createDataFrame(pieces(path), "id int, piece binary"))
    each = tokens.select("ids").distinct().select("ids", F.posexplode("ids").alias("at", "id")).join(vocabulary, "id", "left")
    texts = each.groupBy("ids").agg(F.array_sort(F.collect_list(F.struct("at", F.hex("piece").alias("piece")))).alias("p"))
    joined = F.array_join(F.transform("p", lambda p: F.coalesce(p["piece"], F.lit(""))), "")
    texts = texts.select("ids", _text(F.unhex(joined)).alias("_decoded"))
    found = tokens.drop("decoded").join(texts, "ids", "left")
    empty = F.when(F.col("ids").isNotNull(), F.lit(""))
    return found.withColumn("decoded", F.coalesce("_decoded", empty)).drop("_decoded")
