"""Byte-level BPE with tiktoken and a rank file: encode, decode, and cut long texts safely.

Ranks are read once on the driver and broadcast (a vocabulary is bounded); each Python worker builds
its encoder once. Texts longer than `LONG` characters are encoded in pieces that end after a character
that is not white space and before an ASCII white space one: no match of the splitting pattern spans
such a place (white space only ever opens a match of other characters), so the ids are those of the
whole text. A run of at least `LONG_SPACE` white-space characters is one match, less its last character
where more text follows, and is given to the library as such, without a search that would run deep.
Cuts are made for `SPLIT` only, the pattern they are proven for; with any other one texts are encoded
whole. Ids come back as raw bytes of their tokens.

Defined results: a null text counts as the empty text and has no ids; every row gives one row, in
place, so repeated rows and ids do not matter; an empty table gives no rows.
"""

import base64
import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import whole_text

LONG = 1 << 16
LONG_SPACE = 1 << 12
# fixed values: the pattern of the rank files, and what its \\s stands for
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_WHITE = "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_CUT_BEFORE = " \n\t\r"


def read_ranks(path: str) -> dict:
    """Token bytes to rank from a file of lines `base64 rank`."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def encoder(ranks: dict, pattern: str, name: str = "ranks"):
    import tiktoken

    return tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_pieces(text: str, most: int = LONG):
    """Pieces of about `most` characters or more, cut only where no match can span."""
    start, n = 0, len(text)
    while n - start > most:
        at = start + most
        while at < n and not (text[at] in _CUT_BEFORE and not text[at - 1].isspace() and text[at - 1].isprintable()):
            at += 1
        yield text[start:at]
        start = at
    yield text[start:]


def space_runs(text: str, least: int = LONG_SPACE):
    """(start, end) of the long white-space runs of a text that are matches of `SPLIT`."""
    for run in re.finditer(f"{_WHITE}{{{least},}}", text):
        yield run.start(), run.end() if run.end() == len(text) else run.end() - 1


def encode_text(tokenizer, text: str, most: int = LONG, least_space: int = LONG_SPACE) -> np.ndarray:
    if tokenizer._pat_str != SPLIT:
        return np.asarray(tokenizer.encode_ordinary(text), dtype=np.uint32)
    parts, at = [], 0
    for start, end in [*(space_runs(text, least_space) if len(text) >= least_space else ()), (len(text), len(text))]:
        parts += [tokenizer.encode_ordinary(piece) for piece in safe_pieces(text[at:start], most)]
        if start < end:
            parts.append(tokenizer._encode_single_piece(text[start:end]))
        at = end
    return np.concatenate([np.asarray(part, dtype=np.uint32) for part in parts])


def decode_ids(tokenizer, ids) -> bytes:
    return tokenizer.decode_bytes(np.asarray(ids).tolist())


def ids_digest(ids) -> str:
    """SHA-256 of ids as little-endian unsigned 32-bit integers."""
    return hashlib.sha256(np.asarray(ids).astype("<u4").tobytes()).hexdigest()


def _here(shared):
    """The worker's encoder for a broadcast (ranks, pattern), kept on it: a worker has one of each
    broadcast through all of its tasks, while this module's own names come anew with every task."""
    if not hasattr(shared, "encoder"):
        shared.encoder = encoder(*shared.value)
    return shared.encoder


class Codec:
    """Encode and decode columns with one rank file."""

    def __init__(self, spark, rank_path: str, pattern: str):
        self._shared = spark.sparkContext.broadcast((read_ranks(rank_path), pattern))

    def ids(self, column) -> Column:
        """The ids as an array of integers."""
        shared = self._shared

        @F.pandas_udf("array<int>")
        def encoded(texts: pd.Series) -> pd.Series:
            tokenizer = _here(shared)
            return texts.map(lambda text: encode_text(tokenizer, text).astype(np.int32))

        return encoded(whole_text(column))

    def decoded(self, column) -> Column:
        """The bytes the ids stand for: not text, since a cut sequence of ids may not be valid UTF-8."""
        shared = self._shared

        @F.pandas_udf("binary")
        def raw(ids: pd.Series) -> pd.Series:
            tokenizer = _here(shared)
            return ids.map(lambda some: decode_ids(tokenizer, some))

        return raw(F.coalesce(F.col(column) if isinstance(column, str) else column, F.array().cast("array<int>")))

    def round_trip(self, column) -> Column:
        """n_tokens, ids_sha256 and decoded_sha256 of each text, encoded and decoded again.

        One text at a time in one worker: neither ids nor decoded bytes of a batch are held or moved.
        """
        shared = self._shared

        @F.pandas_udf("n_tokens bigint, ids_sha256 string, decoded_sha256 string")
        def reported(texts: pd.Series) -> pd.DataFrame:
            tokenizer, rows = _here(shared), []
            for text in texts:
                ids = encode_text(tokenizer, text)
                rows.append((len(ids), ids_digest(ids), hashlib.sha256(decode_ids(tokenizer, ids)).hexdigest()))
            return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

        return reported(whole_text(column))


def encode(docs: DataFrame, codec: Codec, id_col="doc_id", text_col="text") -> DataFrame:
    """(doc_id, ids) for every row of `docs`."""
    return docs.select(F.col(id_col).alias("doc_id"), codec.ids(text_col).alias("ids"))


def decode(encoded: DataFrame, codec: Codec, ids_col="ids") -> DataFrame:
    """`encoded` with the decoded bytes."""
    return encoded.withColumn("decoded", codec.decoded(ids_col))
