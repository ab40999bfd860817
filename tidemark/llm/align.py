"""Cross-tokenizer alignment: counts of linked id pairs under a minimal perfect hash of the distinct pairs.

Tokenizer A (byte-level BPE) and B (BPE with byte fallback) encode a space and the text. Two
token occurrences are linked if their byte ranges overlap; offsets at which tokens of both end cut
them into groups. Neither tokenizer ever merges over a single space between a character
that is no space and one that is no white space, so a text is cut there into
chunks, each encoded and aligned once for as long as a Python worker remembers it.

1. First pass: each task counts its pairs and hands them on, a row for each distinct
   pair it met since it last forgot its chunks.
2. The distinct pairs are dealt by their hash into buckets of about ``BUCKET``,
   and each bucket gets a minimal perfect hash of its own: levels of bits, in which a
   key that is alone at its place is settled and the others go on to the next level. A
   key's slot is the rank of its bit. Keys are kept by slot, so that foreign ones are
   refused (``PairTable.slots``).
3. The first pass' counts are added up in dense vectors by slot, one for each leaf
   (as many as the cluster has cores), and these are summed in a tree, ``FAN`` at a time,
   in blocks of ``BLOCK`` slots.
4. Second pass: documents are aligned again and each link's count is looked up by its slot.

There are at most 1.6 thousand million pairs (the product of both vocabularies),
far fewer in practice. Driver and tasks hold a part of the table, at most
about ``SLOTS`` of them (13 bytes each); where there are more, the documents are
gone through once for each part and their sums are added.

Texts that are null, empty or that B doesn't give back (those with U+2581) have no
tokens: zeros, an empty digest, and no part in the counts. Rows of one doc_id are
documents of their own. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from collections.abc import Iterator, Sequence
from functools import cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Tokenizer

from tidemark.llm.common import as_schema, mix, prepare, stage
from tidemark.llm.packing import BYTE_CHARACTERS

B_BITS = 15  #: bits of a B id within a pair's key
MARK = "▁"  #: stands for a space in the pieces of B
BUCKET = 1 << 16  #: pairs of one hash function, about
SLOTS = 1 << 22  #: pairs of one part of the table, about
BLOCK = 1 << 16  #: slots of one vector that is sent
FAN = 16
CHUNKS, LINKS = 600_000, 6_000_000  #: what a Python worker remembers at most before it starts anew
JOINED = 4096  #: chunks that are encoded as one text

COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links")
RESULT = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"

#: A space that ends what may be one piece: no space before it, no white space after it.
_CUT = re.compile(r"(?<! )(?= \S)")
_ODD = re.compile(r" (?!\S)")
_NONE = np.zeros(0, np.int64)


def chunks(text: str) -> list[str]:
    """The chunks of a space and the text, each without its first space."""
    if not _ODD.search(f" {text}"):
        return text.split(" ")
    return [c[1:] for c in _CUT.split(f" {text}") if c]


class Encoders:
    """Both tokenizers, with the bytes of every id."""

    def __init__(self, a_path: str, b_path: str):
        with open(a_path, encoding="utf-8") as file:
            model = json.load(file)["model"]["vocab"]
        byte = {c: b for b, c in BYTE_CHARACTERS.items()}
        tokenizer = Tokenizer.from_file(a_path)
        special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
        self.a_bytes = [b""] * (1 + max(model.values()))
        for token, i in model.items():
            if token not in special:
                self.a_bytes[i] = bytes(byte[ord(c)] for c in token)
        tokenizer.encode_special_tokens = True
        self.tokenizer = tokenizer
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=b_path)
        of = self.pieces
        self.b_bytes = [bytes([int(of.id_to_piece(i)[3:5], 16)]) if of.is_byte(i) else of.id_to_piece(i).replace(MARK, " ").encode() for i in range(of.get_piece_size())]
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in of_ids], np.int64) for of_ids in (self.a_bytes, self.b_bytes))
        # Each id as text with each sign that may follow it.
        self.words = [b"%d%s" % (i, sign) for i in range(len(self.a_bytes)) for sign in (b",", b"|")] + [b"%d%s" % (i, sign) for i in range(len(self.b_bytes)) for sign in (b",", b";", b"\n")]

    def a_ids(self, texts: Sequence[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)]

    def b_ids(self, texts: Sequence[str]) -> list[list[int]]:
        """Ids of a space, which B itself adds, and each text."""
        return self.pieces.encode(list(texts), num_threads=1)


class RankEncoders(Encoders):
    """A by its ranks: the same ids as from its vocabulary file, three times as fast."""

    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed value: the tokenizer's own

    def __init__(self, a_path: str, b_path: str, ranks: str):
        super().__init__(a_path, b_path)
        with open(ranks, "rb") as file:
            table = {base64.b64decode(t): int(i) for t, i in map(bytes.split, file)}
        self.ranked = tiktoken.Encoding("a", pat_str=self.PATTERN, mergeable_ranks=table, special_tokens={})

    def a_ids(self, texts: Sequence[str]) -> list[list[int]]:
        return list(map(self.ranked.encode_ordinary, texts))


@cache
def encoders(a_path: str, b_path: str, ranks: str | None) -> Encoders:
    """The encoders of a Python worker, kept from task to task."""
    return RankEncoders(a_path, b_path, ranks) if ranks else Encoders(a_path, b_path)


class _Numbers(dict):
    def __init__(self):
        self.fresh: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self.fresh.append(chunk)
        number = self[chunk] = len(self)
        return number


class ChunkMemory:
    """Chunks by number, with their tokens, groups and links; ``forget`` bounds it."""

    def __init__(self, of: Encoders, texts: bool):
        """``texts``: whether the groups are wanted as text."""
        self.of, self.texts = of, texts
        self.forget()

    def forget(self) -> None:
        self.numbers = _Numbers()
        self.shape = np.zeros((0, 4), np.int64)  # tokens of A and B, groups, links; no tokens: none given back
        self.groups: list[bytes] = []
        self.links = np.zeros(0, np.int64)

    @property
    def full(self) -> bool:
        return len(self.numbers) > CHUNKS or len(self.links) > LINKS

    def read(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(chunk numbers of all texts, how many each has); a text that has no tokens has no chunks."""
        of_texts = [np.fromiter(map(self.numbers.__getitem__, own := chunks(t)), np.int64, len(own)) if t and MARK not in t else _NONE for t in texts]
        self._learn()
        numbers = np.concatenate([_NONE, *of_texts])
        sizes = np.fromiter(map(len, of_texts), np.int64, len(of_texts))
        bad = self.shape[numbers, 0] == 0
        if bad.any():
            owner = np.repeat(np.arange(len(sizes)), sizes)
            refused = np.bincount(owner[bad], minlength=len(sizes)) > 0
            numbers, sizes = numbers[~refused[owner]], np.where(refused, 0, sizes)
        return numbers, sizes

    def _learn(self) -> None:
        """Encode and align the chunks that are new; most of them joined again, which is faster than one by one."""
        fresh, self.numbers.fresh = self.numbers.fresh, []
        found, block = [], []
        for chunk in fresh:
            plain = chunk and chunk[-1] != " " and not chunk[0].isspace()
            if block and (not plain or len(block) == JOINED):
                found += self._aligned(block)
                block = []
            if plain:
                block.append(chunk)
            else:
                found += self._aligned([chunk])
        if block:
            found += self._aligned(block)
        if fresh:
            self.shape = np.concatenate([self.shape, *[f[0] for f in found]])
            self.links = np.concatenate([self.links, *[f[1] for f in found]])
            for f in found:
                self.groups += f[2]

    def _aligned(self, block: list[str]) -> list[tuple[np.ndarray, np.ndarray, list[bytes]]]:
        """(shape, links, groups) of chunks, in one or more parts."""
        of, text = self.of, " ".join(block)
        data = f" {text}".encode()
        a, b = of.a_ids([f" {text}"])[0], of.b_ids([text])[0]
        same = b"".join(map(of.a_bytes.__getitem__, a)) == data == b"".join(map(of.b_bytes.__getitem__, b))
        if not same:
            if len(block) == 1:
                return [(np.zeros((1, 4), np.int64), _NONE, [b""])]
            return [part for chunk in block for part in self._aligned([chunk])]
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        ends_a, ends_b = np.cumsum(of.a_sizes[a]), np.cumsum(of.b_sizes[b])
        ends = np.cumsum([len(c.encode()) + 1 for c in block])
        either, both = np.union1d(ends_a, ends_b), np.intersect1d(ends_a, ends_b, assume_unique=True)
        # Between two neighbouring ends lies one token of A and one of B: a link.
        links = a[np.searchsorted(ends_a, either)] << B_BITS | b[np.searchsorted(ends_b, either)]
        shape = np.diff(np.column_stack([np.searchsorted(e, ends, side="right") for e in (ends_a, ends_b, both, either)]), axis=0, prepend=0)
        return [(shape, links, self._texts(a, b, ends_a, ends_b, both, ends) if self.texts else [])]

    def _texts(self, a, b, ends_a, ends_b, both, ends) -> list[bytes]:
        """The groups of each chunk: each id's text with what follows it, in order of group, A before B."""
        of = self.of
        group_a, group_b = np.searchsorted(both, ends_a), np.searchsorted(both, ends_b)
        last_a, last_b = both[group_a] == ends_a, both[group_b] == ends_b
        closes = last_b & (ends[np.minimum(np.searchsorted(ends, ends_b), len(ends) - 1)] == ends_b)
        words = np.concatenate([2 * a + last_a, 2 * len(of.a_bytes) + 3 * b + last_b + closes])
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        return b"".join(map(of.words.__getitem__, words[order].tolist())).split(b"\n")[:-1]

    def pair_counts(self, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(key, count) of all links of the chunks, each as often as given."""
        keys, at = np.unique(self.links, return_inverse=True)
        weight = np.repeat(times, self.shape[:, 3])
        counts = np.zeros(len(keys), np.int64)
        np.add.at(counts, at, weight)
        return keys[counts > 0], counts[counts > 0]


def dealt(keys: np.ndarray) -> np.ndarray:
    """31 bits of a key's hash, which say what bucket it belongs to."""
    return (mix(keys.astype(np.uint64) + np.uint64(1)) >> np.uint64(33)).astype(np.int64)


@cache
def memories(make: Sequence, texts: bool) -> ChunkMemory:
    """A Python worker's memory, kept from task to task: most words of a task are in the next one too."""
    return ChunkMemory(encoders(*make), texts)


def pair_counts(docs: DataFrame, make: Sequence) -> DataFrame:
    """(key, h, n): counts of pairs, several rows for a pair that several tasks met."""
    schema = as_schema("key bigint, h bigint, n bigint")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, times = memories(make, False), np.zeros(0, np.int64)

        def told() -> pa.RecordBatch:
            keys, counts = memory.pair_counts(np.pad(times, (0, len(memory.numbers) - len(times))))
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(dealt(keys)), pa.array(counts)], schema=to_arrow_schema(schema))

        for batch in batches:
            numbers, _ = memory.read(batch.column("text").to_pylist())
            own = np.bincount(numbers, minlength=len(memory.numbers))
            own[: len(times)] += times
            times = own
            if memory.full:
                yield told()
                memory.forget()
                times = np.zeros(0, np.int64)
        yield told()

    return docs.select("text").mapInArrow(count, schema)


# --- minimal perfect hash ------------------------------------------------------------


def _spot(keys: np.ndarray, level, size) -> np.ndarray:
    """A key's place among ``size`` bits of a level."""
    salt = np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    return (mix(keys.astype(np.uint64) + salt) % size.astype(np.uint64)).astype(np.int64)


def hash_levels(keys: np.ndarray) -> tuple[np.ndarray, list[int], np.ndarray]:
    """(bits of all levels as 64-bit words, bits of each level, keys by slot) of distinct keys."""
    words, sizes, by_slot = [np.zeros(0, np.uint64)], [], [np.zeros(0, np.int64)]
    left = np.sort(keys)
    while len(left):
        size = -(-2 * len(left) // 64) * 64
        spot = _spot(left, len(sizes), np.full(len(left), size))
        alone = np.bincount(spot, minlength=size) == 1
        settled = alone[spot]
        words.append(np.packbits(alone, bitorder="little").view("<u8"))
        by_slot.append(left[settled][np.argsort(spot[settled])])
        sizes.append(size)
        left = left[~settled]
    return np.concatenate(words), sizes, np.concatenate(by_slot)


class PairTable:
    """Slots of the pairs of some buckets: levels of bits, the rank before each word, and the keys by slot."""

    def __init__(self, rows: Sequence[tuple[int, bytes, list[int], bytes]], first: int, last: int, buckets: int):
        """Rows (bucket, words, sizes, keys) of the buckets from ``first`` to before ``last``, of ``buckets`` in all."""
        self.first, self.last, self.buckets = first, last, buckets
        words, keys, depth = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)], max((len(r[2]) for r in rows), default=0)
        self.sizes, self.starts = np.zeros((2, last - first, depth), np.int64)
        at = 0
        for bucket, own, sizes, of in sorted(rows):
            words.append(np.frombuffer(own, "<u8"))
            keys.append(np.frombuffer(of, "<i4"))
            n = len(sizes)
            self.sizes[bucket - first, :n] = sizes
            self.starts[bucket - first, :n] = at + np.cumsum([0, *sizes[:-1]])
            at += sum(sizes)
        self.words, self.keys = np.concatenate(words), np.concatenate(keys)
        bits = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(bits) - bits
        self.counts = np.zeros(len(self.keys), np.int64)
        self.best = np.zeros(len(self.keys), bool)

    def __len__(self) -> int:
        return len(self.keys)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for those that are not in this part, or in no part."""
        out = np.full(len(keys), -1, np.int64)
        bucket = (dealt(keys) * self.buckets) >> 31
        left = np.flatnonzero((bucket >= self.first) & (bucket < self.last))
        for level in range(self.sizes.shape[1]):
            own = bucket[left] - self.first
            size = self.sizes[own, level]
            left, own, size = left[size > 0], own[size > 0], size[size > 0]
            bit = self.starts[own, level] + _spot(keys[left], level, size)
            word, place = self.words[bit >> 6], (bit & 63).astype(np.uint64)
            hit = (word >> place) & np.uint64(1) == 1
            rank = self.before[bit >> 6] + np.bitwise_count(word & ((np.uint64(1) << place) - np.uint64(1)))
            out[left[hit]] = rank[hit]
            left = left[~hit]
        found = np.flatnonzero(out >= 0)
        out[found[self.keys[out[found]] != keys[found]]] = -1
        return out


def hash_functions(pairs: DataFrame, buckets: int) -> DataFrame:
    """(bucket, words, sizes, keys) of each bucket of the distinct pairs (key, h)."""

    def build(part: pd.DataFrame) -> pd.DataFrame:
        words, sizes, keys = hash_levels(part["key"].to_numpy())
        return pd.DataFrame({"bucket": part["bucket"].iloc[:1], "words": [words.tobytes()], "sizes": [sizes], "keys": [keys.astype("<i4").tobytes()]})

    bucket = F.shiftright(F.col("h") * F.lit(buckets), 31).cast("int").alias("bucket")
    return pairs.select("key", bucket).groupBy("bucket").applyInPandas(build, "bucket int, words binary, sizes array<bigint>, keys binary")


def summed_vectors(counts: DataFrame, table: PairTable) -> DataFrame:
    """(block, vector): counts (key, n) of a part of the table, added up by slot in a tree of dense vectors."""
    spark = counts.sparkSession
    leaves = max(1, spark.sparkContext.defaultParallelism)
    ddl = "block int, leaf int, vector binary"
    schema = as_schema(ddl)
    shared = spark.sparkContext.broadcast(table)

    def leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, own = shared.value, TaskContext.get().partitionId()
        vector = np.zeros(len(part), np.int64)
        for batch in batches:
            slot = part.slots(batch.column("key").to_numpy())
            if (slot < 0).any():
                raise ValueError("a pair is missing from the table of distinct pairs")
            np.add.at(vector, slot, batch.column("n").to_numpy())
        for block, at in enumerate(range(0, len(vector), BLOCK)):
            piece = vector[at : at + BLOCK]
            if piece.any():
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([own], pa.int32()), pa.array([piece.tobytes()], pa.binary())], schema=to_arrow_schema(schema))

    def added(rows: pd.DataFrame) -> pd.DataFrame:
        total = reduce(np.add, (np.frombuffer(v, "<i8") for v in rows["vector"]))
        return pd.DataFrame({"block": rows["block"].iloc[:1], "leaf": rows["leaf"].iloc[:1], "vector": [total.tobytes()]})

    out = counts.select("key", "n").coalesce(leaves).mapInArrow(leaf, schema)
    while leaves > 1:
        leaves = -(-leaves // FAN)
        out = out.withColumn("leaf", F.expr(f"cast(leaf div {FAN} as int)")).groupBy("block", "leaf").applyInPandas(added, ddl)
    return out.select("block", "vector")


def with_counts(table: PairTable, vectors: DataFrame) -> PairTable:
    for r in vectors.collect():  # a part of the table: at most about SLOTS numbers
        piece = np.frombuffer(r["vector"], "<i8")
        table.counts[r["block"] * BLOCK : r["block"] * BLOCK + len(piece)] = piece
    return table


# --- documents ---------------------------------------------------------------------


def looked_up(docs: DataFrame, table: PairTable, make: Sequence) -> DataFrame:
    """The alignment of every row and the sums over its links in a part of the table, with extra columns of ``docs`` kept."""
    kept = [f for f in docs.schema if f.name != "text"]
    schema = as_schema(", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + RESULT.removeprefix("doc_id bigint"))
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, part, sums = memories(make, True), shared.value, np.zeros((0, 2), np.int64)
        for batch in batches:
            numbers, sizes = memory.read(batch.column("text").to_pylist())
            fresh = memory.links[memory.shape[: len(sums), 3].sum() :]
            slot = part.slots(fresh)
            of_link = np.where(slot[:, None] < 0, 0, np.column_stack([part.best[slot], part.counts[slot]])) if len(part) else np.zeros((len(fresh), 2), np.int64)
            ends = np.cumsum(memory.shape[len(sums) :, 3])
            total = np.concatenate([np.zeros((1, 2), np.int64), np.cumsum(of_link, axis=0, dtype=np.int64)])
            sums = np.concatenate([sums, np.diff(total[np.concatenate([[0], ends])], axis=0)])
            each = np.concatenate([memory.shape, sums], axis=1)[numbers]
            running = np.concatenate([np.zeros((1, 6), np.int64), np.cumsum(each, axis=0)])
            ends = np.concatenate([[0], np.cumsum(sizes)])
            of_doc = np.diff(running[ends], axis=0)
            groups = list(map(memory.groups.__getitem__, numbers.tolist()))
            digests = [hashlib.sha256(b";".join(groups[x:y])).hexdigest() if y > x else "" for x, y in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            columns = [*(batch.column(f.name) for f in kept), *map(pa.array, of_doc.T), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, schema=to_arrow_schema(schema))
            if memory.full:
                memory.forget()
                sums = np.zeros((0, 2), np.int64)

    return docs.mapInArrow(look, schema)


def align_tokens(docs: DataFrame, a_path: str, b_path: str, ranks: str | None = None, slots: int = SLOTS, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of ``docs`` (doc_id, text)."""
    prepare(docs.sparkSession)
    make = (a_path, b_path, ranks)
    rows = docs.select("doc_id", "text")
    counts = stage(pair_counts(rows, make), "pair-counts")
    pairs = stage(counts.select("key", "h").distinct(), "pairs")
    buckets = max(1, -(-pairs.count() // bucket))
    functions = stage(hash_functions(pairs, buckets), "hash-functions")
    step = max(1, slots // bucket)
    parts = [(x, min(buckets, x + step)) for x in range(0, buckets, step)]
    own = F.shiftright(F.col("h") * F.lit(buckets), 31)

    def table(first: int, last: int) -> PairTable:
        found = functions.filter(F.col("bucket").between(first, last - 1)).collect()
        return PairTable([(r["bucket"], bytes(r["words"]), r["sizes"], bytes(r["keys"])) for r in found], first, last, buckets)

    best, vectors, held = np.zeros(1 << B_BITS, np.int64), [], None
    for first, last in parts:
        held = table(first, last)
        vectors.append(stage(summed_vectors(counts.filter(own.between(first, last - 1)), held), "pair-vectors"))
        held = with_counts(held, vectors[-1])
        np.maximum.at(best, held.keys & ((1 << B_BITS) - 1), held.counts)

    def ready(part: PairTable) -> PairTable:
        part.best = part.counts == best[part.keys & ((1 << B_BITS) - 1)]
        return part

    if len(parts) == 1:
        return looked_up(rows, ready(held), make)
    # Sums over several parts meet by the row's place, which staging fixes.
    placed = stage(rows.withColumn("_place", F.monotonically_increasing_id()), "placed")
    each = [looked_up(placed, ready(with_counts(table(*p), v)), make) for p, v in zip(parts, vectors, strict=True)]
    same = [F.first(c).alias(c) for c in (*COLUMNS, "groups_sha256")]
    total = reduce(DataFrame.unionByName, each).groupBy("_place").agg(*same, F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return total.select(*[f.name for f in as_schema(RESULT)])
