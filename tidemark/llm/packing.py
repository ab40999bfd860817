"""Packing tokenised documents into sequences: first-fit decreasing over a tournament tree of bin capacities.

A document's ids are those of its text and one end id. Whole stretches of
``LENGTH`` ids fill a sequence each; the rest of each document is packed with
the rests of its group. Groups are random (a hash deals them out) and hold about
``GROUP`` documents, so packing is independent, and bounded, in each. In a
group the longest rest goes first, into the leftmost bin that has room, which
the tree finds in logarithmic time.

A null text is empty: its one id is the end id. Rows of one doc_id are separate
documents with equal pieces. An empty table gives no rows; extra columns are
ignored. Sequence ids are unique, not dense: the group's number in the upper
half, the bin's number in the lower.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.common import map_batches, prepare, stage

LENGTH = 4096
END_ID = 2
GROUP = 2048


# Fixed value: the tokenizer's own split pattern, written out for lower-case Latin-1 letters and numerals.
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼-¾]|[^\sa-zªµºß-öø-ÿ0-9²³¹¼-¾]+")
#: The visible character that stands for each byte in a byte-level vocabulary: printable bytes are themselves.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_CHARACTERS = {b: b for b in _PRINTABLE} | {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


class _Pieces(dict):
    """Ids (little-endian unsigned 32-bit bytes) by piece of a chunk."""

    def __init__(self, tokenizer: Tokenizer):
        self.model = tokenizer.model

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= 2 * ChunkEncoder.LIMIT:
            self.clear()
        visible = piece.encode().decode("latin-1").translate(BYTE_CHARACTERS)
        ids = self[piece] = np.array([t.id for t in self.model.tokenize(visible)], "<u4").tobytes()
        return ids


class _Chunks(dict):
    """Ids by chunk between white space, put together from the ids of its pieces."""

    def __init__(self, tokenizer: Tokenizer):
        self.pieces = _Pieces(tokenizer)

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= ChunkEncoder.LIMIT:
            self.clear()
        ids = self[chunk] = b"".join(map(self.pieces.__getitem__, PIECES.findall(chunk)))
        return ids


class ChunkEncoder:
    """Ids of a text as little-endian unsigned 32-bit bytes.

    Most of a tokenizer's time goes into words it has met before, so ids are
    kept by chunk. That is right for tokenizers that lower-case, drop white
    space and split by ``PIECES`` before merging, and for Latin-1 texts, which
    normalisation leaves alone. Other texts, those with a special token's
    opening and those with separators that Python takes for white space and the
    tokenizer doesn't, go to the tokenizer whole.
    """

    LIMIT = 500_000  #: chunks kept before a new start, and twice as many pieces
    ODD = ("<|", "\x1c", "\x1d", "\x1e", "\x1f")

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.chunks = _Chunks(self.tokenizer)

    def __call__(self, text: str) -> bytes:
        try:
            text.encode("latin-1")
            plain = not any(o in text for o in self.ODD)
        except UnicodeEncodeError:
            plain = False
        if plain:
            return b"".join(map(self.chunks.__getitem__, text.lower().split()))
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@cache
def encoder(path: str) -> ChunkEncoder:
    """The encoder of a file; a Python worker keeps it from task to task."""
    return ChunkEncoder(path)


def _pieces_setup(path: str, length: int, end_id: int) -> Callable:
    encode = encoder(path)
    end = np.array([end_id], "<u4").tobytes()

    def pieces(ids, texts):
        out = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")}
        for doc_id, text in zip(ids, texts, strict=True):
            data = memoryview(encode(text or "") + end)
            n = len(data) // 4
            for start in range(0, n, length):
                part = data[4 * start : 4 * (start + length)]
                for k, v in zip(out, (doc_id, start, len(part) // 4, zlib.crc32(part), n), strict=True):
                    out[k].append(v)
        return out

    return pieces


def tokenised_pieces(docs: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): stretches of at most ``length`` ids of each row."""
    ddl = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    return map_batches(docs, ["doc_id", "text"], lambda: _pieces_setup(path, length, end_id), ddl)


def first_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each item, dealt in the order given to the leftmost bin with room.

    The tree's leaves are the room left in each bin, its inner nodes the larger
    of two; the way down prefers the left whenever it has room.
    """
    n = len(lengths)
    leaves = 1 << max(0, int(n - 1).bit_length())
    tree = [capacity] * (2 * leaves)
    bins, offsets = np.empty(n, np.int64), np.empty(n, np.int64)
    for item, length in enumerate(lengths.tolist()):
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] < length:
                node += 1
        bins[item], offsets[item] = node - leaves, capacity - tree[node]
        tree[node] -= length
        node //= 2
        while node:
            tree[node] = max(tree[2 * node], tree[2 * node + 1])
            node //= 2
    return bins, offsets


def pack(docs: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID, group: int = GROUP) -> DataFrame:
    """Pieces of all rows of ``docs`` (doc_id, text) with their sequence and offset.

    (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)
    """
    prepare(docs.sparkSession)
    # Staging fixes the places of the rows, by which pieces repeated more than ``group`` times are dealt.
    pieces = stage(tokenised_pieces(docs, path, length, end_id).withColumn("_place", F.monotonically_increasing_id()), "pieces")
    groups = max(1, -(-docs.count() // group))
    own = F.xxhash64("doc_id", "start", "ids_crc32", F.lit(5))
    repeated = pieces.groupBy(own.alias("_own")).agg(F.count("*").alias("n")).filter(F.col("n") > group).select("_own", F.lit(True).alias("_repeated"))
    dealt = pieces.withColumn("_own", own).join(F.broadcast(repeated), "_own", "left")
    dealt = dealt.withColumn("_group", F.pmod(F.when(F.col("_repeated"), F.xxhash64("_own", "_place")).otherwise(F.col("_own")), F.lit(groups)))
    dealt = dealt.drop("_own", "_repeated", "_place")
    ddl = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"

    def packed(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        bins, offsets = first_fit(part["length"].to_numpy(), length)
        part["sequence_id"], part["offset"] = (int(part["_group"].iloc[0]) << 32) + bins, offsets
        return part.drop(columns="_group")

    return dealt.groupBy("_group").applyInPandas(packed, ddl)
