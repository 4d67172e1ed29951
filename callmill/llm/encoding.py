"""Encoding of the whole corpus with a public tokenizer (problem 7).

A byte-level BPE from a local rank file. Long texts are first cut where no token can cross, since the tokenizer's own
split of a text into words ends there: before a space between other characters, between a letter, a digit and any other
mark (but for an apostrophe and what a space binds), and before white space that follows a mark. Each stretch is encoded
on its own, so the ids are those of the whole text and memory and time stay in proportion wherever words end, whatever the script. Decoding goes through raw bytes, since a token may end inside a character.

Defined results: null and empty texts give an empty list; special tokens' strings are ordinary text; equal texts give
equal ids; lone surrogates can't occur in Spark strings. Empty tables give no rows.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callmill.common import read
from callmill.llm.common import map_texts

#: Where the vocabulary files lie on every machine.
FOLDER = "/opt/tokenizers"
FILE = "byte_bpe_50k.tiktoken"
# Fixed value: how this vocabulary's tokenizer splits a text into words.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters up to which a text is encoded in one call.
STRETCH = 20_000
# Characters that are letters, digits and other marks in every version of Unicode, the apostrophe left out.
_LETTER, _DIGIT = "A-Za-zÀ-ÖØ-öø-ɏΆ-ώА-яЁёא-תء-غف-يअ-हก-ะา-ำぁ-ゖァ-ヺ一-龥가-힣", "0-9٠-٩०-९๐-๙"
_MARK = "!-&(-/:-@\\[-`{-~«»–-”†-…。、，．！？：；「」『』（）・ัิ-ฺ็-๎़ा-्"
#: A place where one word of PATTERN ends and the next begins, whatever else stands around.
_SAFE = re.compile(rf"(?<=\S)(?= \S)|(?<=\S)(?=[\n\t\r])|(?<=[{_LETTER}])(?=[{_DIGIT}{_MARK}])|(?<=[{_DIGIT}])(?=[{_LETTER}{_MARK}])|(?<=[{_MARK}])(?=[{_LETTER}{_DIGIT}])")


@lru_cache
def encoder(folder: str = FOLDER, file: str = FILE) -> tiktoken.Encoding:
    with open(f"{folder}/{file}", "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(file, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def stretches(text: str, size: int = STRETCH) -> list[str]:
    """The text in parts of about `size` characters that no token crosses; a part without a safe cut stays whole."""
    parts, start = [], 0
    while len(text) - start > size:
        safe = _SAFE.search(text, start + size)
        if not safe:
            break
        parts.append(text[start : safe.start()])
        start = safe.start()
    return [*parts, text[start:]]


def encode(text: str | None, folder: str = FOLDER, file: str = FILE) -> list[int]:
    e = encoder(folder, file)
    return [i for part in stretches(text) for i in e.encode_ordinary(part)] if text else []


def decode(ids: list[int], folder: str = FOLDER, file: str = FILE) -> str:
    """The text of ids; bytes that are no whole character become U+FFFD."""
    return encoder(folder, file).decode_bytes(ids).decode("utf-8", errors="replace")


def encode_texts(df: DataFrame, key: str, text: str, folder: str = FOLDER, file: str = FILE, count_only: bool = False) -> DataFrame:
    """key with ids array<int>, or with n_tokens int where only their number is asked."""
    name, kind, arrow = ("n_tokens", "int", pa.int32()) if count_only else ("ids", "array<int>", pa.list_(pa.int32()))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = (encode(t, folder, file) for t in batch.column("_text").to_pylist())
        made = pa.array([len(x) for x in ids] if count_only else list(ids), arrow)
        return pa.record_batch([batch.column(key).cast(pa.int64()), made], names=[key, name])

    return map_texts(df.select(F.col(key).cast("bigint").alias(key), F.col(text).alias("_text")), "_text", f"`{key}` bigint, {name} {kind}", run)


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of each document by byte_bpe_50k."""
    return encode_texts(read(spark, sf_dir, "documents"), "doc_id", "text")
