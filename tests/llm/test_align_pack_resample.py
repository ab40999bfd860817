"""Alignment, best-fit packing and resampling against brute force, and their edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
from tidemark.llm import align, bestfit, queries, resample

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string"
ODD = [
    (1, None), (2, ""), (3, " "), (4, "<|endoftext|> <s> </s>"), (5, "x" * 3000), (6, "  two  gaps  "), (7, "▁ mark"), (8, "line\nline \n\n end\x1c z\xa0z"),
    (None, "no id"), (9, "same text here"), (9, "same text here"), (9, "other text"), (10, "é中😀 ́ １٣"), (11, "'s it's  'll\x00 tab\tend "),
]


def documents():
    return duckdb.sql(f"select doc_id, text from '{SF_DIR}/documents.parquet'").fetchall()


def clashing(spark, rows):
    """The rows with columns whose names the operators use themselves."""
    names = ("task", "number", "key", "n", "rank", "score", "_p", "_place", "bucket")
    return spark.createDataFrame(rows, DOCS).withColumns({n: F.lit(7) for n in names})


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


# --- op11 ------------------------------------------------------------------------


def aligned_by_hand(rows):
    a_of = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_of.encode_special_tokens = True
    b_of = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    byte, tokens = {c: b for b, c in align.BYTE_CHARACTERS.items()}, {i: t for t, i in a_of.get_vocab().items()}

    def a_bytes(i):
        return bytes(byte[ord(c)] for c in tokens[i])

    def b_bytes(i):
        return bytes([int(b_of.id_to_piece(i)[3:5], 16)]) if b_of.is_byte(i) else b_of.id_to_piece(i).replace("▁", " ").encode()

    found, counts = [], Counter()
    for doc_id, text in rows:
        a = a_of.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = b_of.encode(text) if text else []
        data = f" {text}".encode()
        if b"".join(map(a_bytes, a)) != data or b"".join(map(b_bytes, b)) != data:
            a = b = []
        spans = []
        for ids, of in ((a, a_bytes), (b, b_bytes)):
            ends = np.cumsum([len(of(i)) for i in ids]).tolist()
            spans.append(list(zip([0, *ends], ends, ids)))  # noqa: B905
        links = [(i, j) for x, y, i in spans[0] for u, v, j in spans[1] if max(x, u) < min(y, v)]
        cuts = sorted({s[1] for s in spans[0]} & {s[1] for s in spans[1]})
        groups = [[[i for x, y, i in s if lo <= x and y <= hi] for s in spans] for lo, hi in zip([0, *cuts], cuts)]  # noqa: B905
        counts.update(links)
        found.append((doc_id, a, b, groups, links))
    best = Counter()
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    digest = lambda groups: hashlib.sha256(";".join("|".join(",".join(map(str, p)) for p in g) for g in groups).encode()).hexdigest() if groups else ""
    return ordered((d, len(a), len(b), len(g), len(x), sum(counts[p] == best[p[1]] for p in x), sum(counts[p] for p in x), digest(g)) for d, a, b, g, x in found)


@pytest.mark.parametrize(("slots", "bucket", "ranks"), [(align.SLOTS, align.BUCKET, queries.RANKS), (2000, 500, None)])
def test_alignment_is_that_of_brute_force(spark, slots, bucket, ranks):
    """Also where the table has many parts, and with either way to the ids of A."""
    pick = random.Random(3)
    noise = [(100 + i, "".join(pick.choice("ab eE\n \t.,'<|>sé▁中😀\x00́ 0١ \r") for _ in range(pick.randint(0, 25)))) for i in range(100)]
    rows = ODD + noise + [r for r in documents() if len(r[1] or "") < 500][:12]
    got = align.align_tokens(clashing(spark, rows), queries.BYTES, queries.PIECES, ranks, slots, bucket)
    assert ordered(got.collect()) == aligned_by_hand(rows)


def test_alignment_forgets_and_goes_on(spark, monkeypatch):
    rows = [(i, f"word{i} and again {i % 7}") for i in range(600)]
    monkeypatch.setattr(align, "CHUNKS", 50)
    memory = align.ChunkMemory(align.encoders(queries.BYTES, queries.PIECES, None), True)
    assert not memory.full and len(memory.read([t for _, t in rows])[1]) == 600 and memory.full
    memory.forget()
    assert len(memory.numbers) == len(memory.links) == 0
    empty = spark.createDataFrame([], DOCS)
    assert align.align_tokens(empty, queries.BYTES, queries.PIECES).count() == 0


def test_hash_is_minimal_and_perfect_and_refuses_foreign_keys():
    keys = np.unique(np.random.default_rng(5).integers(0, 1 << 31, 20_000))
    own, foreign = keys[::2], keys[1::2]
    buckets = 7
    rows = []
    for bucket in range(buckets):
        words, sizes, by_slot = align.hash_levels(own[(align.dealt(own) * buckets) >> 31 == bucket])
        rows.append((bucket, words.tobytes(), sizes, by_slot.astype("<i4").tobytes()))
    table = align.PairTable(rows, 0, buckets, buckets)
    assert sorted(table.slots(own).tolist()) == list(range(len(own)))
    assert (table.slots(foreign) == -1).all()
    half = align.PairTable(rows[:3], 0, 3, buckets)
    assert sorted(s for s in half.slots(own).tolist() if s >= 0) == list(range(len(half)))


# --- op12 ------------------------------------------------------------------------


def packed_by_hand(items, capacity):
    bins, large = [], sorted((x for x in items if 3 * x > capacity), reverse=True)
    while large:
        first = large.pop(0)
        fits = [i for i, x in enumerate(large) if first + x <= capacity]
        bins.append([first, *([large.pop(fits[0])] if fits else [])])
    for item in sorted((x for x in items if 3 * x <= capacity), reverse=True):
        fits = [(capacity - sum(b), i) for i, b in enumerate(bins) if capacity - sum(b) >= item]
        if fits:
            bins[min(fits)[1]].append(item)
        else:
            bins.append([item])
    return bins


def test_patterns_fill_bins_as_item_by_item_packing_does():
    pick = random.Random(11)
    for _ in range(400):
        capacity = pick.choice([7, 12, 20, 50])
        items = [pick.choice([pick.randint(1, capacity), 1, capacity // 3, capacity // 2]) for _ in range(pick.randint(0, 60))]
        counts = Counter(items)
        groups = bestfit.bin_groups(counts, capacity)
        filled = Counter({})
        for bins, content in groups:
            assert sum(n for length, n in content if 3 * length > capacity) <= 2
            filled[sum(length * n for length, n in content)] += bins
        assert filled == Counter(map(sum, packed_by_hand(items, capacity)))


def test_best_fit_packs_every_id_once(spark):
    rows = ODD + documents() + [(500, "long words " * 9000)]
    got = bestfit.pack_best_fit(clashing(spark, rows), queries.TOKENIZER).collect()
    encode = Tokenizer.from_file(queries.TOKENIZER)
    want = []
    for doc_id, text in rows:
        ids = np.array([*encode.encode(text or "", add_special_tokens=False).ids, bestfit.END_ID], "<u4")
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            want.append((doc_id, piece, start, len(part), zlib.crc32(part.tobytes())))
    assert ordered(tuple(r)[:5] for r in got) == ordered(want)
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(bins) == len(packed_by_hand([r["length"] for r in got], 4096))
    assert bestfit.pack_best_fit(spark.createDataFrame([], DOCS), queries.TOKENIZER).count() == 0


# --- op13 ------------------------------------------------------------------------


def resampled_by_hand(rows, target):
    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return len(words), [zlib.crc32(" ".join(words[i : i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(words) - n + 1)]

    own = [(d, *features(t)) for d, t in rows]
    s, t = Counter(b for _, _, f in own for b in f), Counter(b for x in target for b in features(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * (s_all + 10000) / ((s[b] + 1.0) * (t_all + 10000)))) for b in s}
    out, drawn = [], []
    for place, (d, n, f) in enumerate(own):
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([d, len(f), weight, score, None])
        if n >= 20:
            drawn.append((-score, d is None, d or 0, place))
    for rank, key in enumerate(sorted(drawn)[: len(drawn) * 5 // 100], 1):
        out[key[3]][4] = rank
    return ordered(out)


@pytest.mark.parametrize(("base", "run"), [(resample.BASE, resample.RUN), (8, 20)])
def test_resampling_is_that_of_brute_force(spark, base, run, monkeypatch):
    """Ties, repeated rows and ids without value included, from one key a run to all in one."""
    monkeypatch.setattr(resample, "BASE", base)
    monkeypatch.setattr(resample, "RUN", run)
    monkeypatch.setattr(resample, "FAN", 3)
    target = [r[0] for r in duckdb.sql(f"select text from '{SF_DIR}/benchmark.parquet'").fetchall()]
    repeated = [(None, "a b c d e f g h i j k l m n o p q r s t u")] * 30 + [(77, target[0])] * 20
    rows = ODD + documents() + repeated
    frame = clashing(spark, rows).coalesce(1)
    got = resample.resample(frame, spark.createDataFrame([(x,) for x in target], "text string")).collect()
    assert ordered(got) == resampled_by_hand(rows, target)


def test_resampling_of_nothing(spark):
    none, target = spark.createDataFrame([], DOCS), spark.createDataFrame([("x y",)], "text string")
    assert resample.resample(none, target).count() == 0
    few = resample.resample(spark.createDataFrame(ODD, DOCS), target.limit(0)).collect()
    assert len(few) == len(ODD) and all(r["rank"] is None for r in few)


def test_selection_finds_every_place(spark, monkeypatch):
    monkeypatch.setattr(resample, "BASE", 2)
    monkeypatch.setattr(resample, "RUN", 10)
    pick = random.Random(2)
    keys = [(pick.randint(0, 3), pick.randint(0, 3), i) for i in range(150)]
    frame = spark.createDataFrame(keys, "_s bigint, _d bigint, _p bigint").repartition(4)
    for place in (77, 150):
        assert resample.select_key(frame, place) == sorted(keys)[place - 1]
    assert resample.select_key(frame, 0) is None and resample.select_key(frame, 151) is None


def test_registered_query_agrees_with_its_sql(spark):
    for name in ("documents", "benchmark"):
        duckdb.sql(f"create or replace view {name} as select * from '{SF_DIR}/{name}.parquet'")
    want = duckdb.sql(entry.oracle_sql()["op13_resample_to_target"]).fetchall()
    assert ordered(entry.queries()["op13_resample_to_target"](spark, SF_DIR).collect()) == ordered(want)
