"""Target-distribution importance resampling: array-scored weights, then weighted median-of-medians selection.

1. Features of a text are its runs of one to three words (A-Z lower-cased; words
   are runs of a-z, 0-9 and characters beyond ASCII), each dealt to one of
   ``BUCKETS`` by the CRC-32 of its bytes. A task sums the features of all its
   rows in one array, so at most ``BUCKETS`` rows leave it.
2. The gain of a bucket is how much likelier the target texts hold it than all
   documents do. Gains are one array; a document's weight is the sum of the gains
   at its features' buckets. The score adds noise drawn from the id's digest,
   so that the highest scores are a draw without replacement by weight.
3. The draw's last key is found without sorting the documents: runs of at most
   ``RUN`` remaining keys give their median and their number, the weighted median
   of these is the pivot, and all keys on the wrong side of it go. Medians are
   merged in ``FAN`` groups first, so the driver gets at most two rows a group; each
   round still discards an eighth of the remaining keys at least. The last
   ``BASE`` keys are looked at themselves.
4. Only the winners are sorted, by ranges; their ranks are the place in their range and
   the number of winners in the ranges before it.

Keys are (score descending, doc_id ascending, place in the input), so equal rows have an
order too: of repeated rows with one key the first ones win, and their ranks are
consecutive. A null doc_id comes last among equal scores and is hashed as the
empty string. Texts that are null, empty or without a word have no features,
weight 0, and are never drawn. No target text, or none with a word: all gains compare
with an even spread. Empty documents give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.common import as_schema, map_batches, prepare, stage

BUCKETS = 10_000
SCALE = 1000
SEED = 42
PERCENT, WORDS = 5, 20  #: share drawn of the documents with so many words
RUN = 65_536  #: keys whose exact median one step takes
FAN = 256  #: groups in which medians are merged
BASE = 4096  #: remaining keys that are looked at one by one

#: Lower-cases A-Z; what is no part of a word turns into a space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
KEY = ("_s", "_d", "_p")


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def feature_buckets(words: list[bytes]) -> np.ndarray:
    """The bucket of every run of one to three words; a run's checksum goes on from that of the run without its last word."""
    spaced = [b" " + w for w in words]
    one = list(map(crc32, words))
    two = list(map(crc32, spaced[1:], one))
    three = list(map(crc32, spaced[2:], two))
    return np.fromiter(one + two + three, np.uint32, len(one) + len(two) + len(three)) % BUCKETS


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Features of all texts by bucket."""
    schema = as_schema("bucket int, n bigint")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                counts += np.bincount(feature_buckets(words_of(text)), minlength=BUCKETS)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[at])], schema=to_arrow_schema(schema))

    rows = texts.select("text").mapInArrow(count, schema).groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # at most BUCKETS rows
    out = np.zeros(BUCKETS, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The whole-numbered gain of each bucket."""
    s_all, t_all = float(source.sum()) + BUCKETS, float(target.sum()) + BUCKETS
    of = (math.floor(SCALE * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(source.tolist(), target.tolist(), strict=True))
    return np.fromiter(of, np.int64, BUCKETS)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-SCALE * math.log(-math.log((h + 0.5) / 4294967296)))


def _scores(gain: np.ndarray) -> Callable:
    def score(ids, texts):
        out = {"doc_id": ids, "n_words": [], "n_features": [], "weight": [], "score": []}
        for doc_id, text in zip(ids, texts, strict=True):
            words = words_of(text)
            at = feature_buckets(words)
            weight = int(gain[at].sum())
            for k, v in (("n_words", len(words)), ("n_features", len(at)), ("weight", weight), ("score", weight + noise(doc_id))):
                out[k].append(v)
        return out

    return score


def score_documents(docs: DataFrame, target: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row of ``docs`` (doc_id, text) against the texts of ``target``."""
    gain = gains(bucket_counts(docs), bucket_counts(target))
    return map_batches(docs, ["doc_id", "text"], lambda: _scores(gain), "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint")


# --- selection -------------------------------------------------------------------


def weighted_median(keys: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The first row, in order of the columns, at which half of the weight is reached: never the last of several."""
    order = np.lexsort(keys.T[::-1])
    return keys[order[np.searchsorted(2 * np.cumsum(weight[order]), weight.sum())]]


def _up_to(keys: np.ndarray, pivot: tuple) -> np.ndarray:
    s, d, p = keys.T
    return (s < pivot[0]) | (s == pivot[0]) & ((d < pivot[1]) | (d == pivot[1]) & (p <= pivot[2]))


def _run_medians(keys: DataFrame, pivot: tuple | None) -> list[tuple[int, int, tuple]]:
    """(side, weight, median) of merged runs of keys up to (0) and beyond (1) the pivot; all count as 1 without a pivot."""
    schema = as_schema("side int, part int, weight bigint, _s bigint, _d bigint, _p bigint")
    arrow = to_arrow_schema(schema)

    def medians(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held, done = TaskContext.get().partitionId(), [], 0

        def reduced() -> pa.RecordBatch:
            rows = np.concatenate(held)
            low = _up_to(rows, pivot) if pivot else np.zeros(len(rows), bool)
            out = [(side, (task * 31 + done) % FAN, len(k), *weighted_median(k, np.ones(len(k), np.int64)).tolist()) for side, k in enumerate((rows[low], rows[~low])) if len(k)]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)

        for batch in batches:
            held.append(np.column_stack([batch.column(k).to_numpy() for k in KEY]))
            if sum(map(len, held)) >= RUN:
                yield reduced()
                held, done = [], done + 1
        if sum(map(len, held)):
            yield reduced()

    def merged(rows: pd.DataFrame) -> pd.DataFrame:
        weight = rows["weight"].to_numpy()
        middle = weighted_median(rows[list(KEY)].to_numpy(np.int64), weight)
        return pd.DataFrame([[rows["side"].iloc[0], weight.sum(), *middle]], columns=["side", "weight", *KEY])

    runs = keys.mapInArrow(medians, schema).groupBy("side", "part").applyInPandas(merged, "side int, weight bigint, _s bigint, _d bigint, _p bigint")
    return [(r[0], r[1], tuple(r)[2:]) for r in runs.collect()]  # at most 2 * FAN rows


def _literal(key: tuple) -> Column:
    return F.struct(*[F.lit(v).cast("bigint").alias(k) for k, v in zip(KEY, key, strict=True)])


def select_key(keys: DataFrame, place: int) -> tuple | None:
    """The key (three bigints, all keys distinct) that has ``place - 1`` smaller ones in the staged frame; none if there are too few."""
    left, pivot, staged = place, None, None
    while True:
        sides = _run_medians(keys, pivot)
        held = [sum(w for s, w, _ in sides if s == side) for side in (0, 1)]
        if pivot is None and not 0 < left <= held[1]:
            return None
        side = 1 if pivot is None or left > held[0] else 0
        if pivot is not None:
            keys = keys.filter(F.struct(*KEY) <= _literal(pivot) if side == 0 else F.struct(*KEY) > _literal(pivot))
            left -= held[0] if side else 0
        if held[side] <= BASE:
            return sorted(tuple(r) for r in keys.collect())[left - 1]
        if staged is None or 4 * held[side] <= staged:
            keys, staged = (stage(keys, "keys"), held[side]) if staged else (keys, held[side])
        own = [(w, m) for s, w, m in sides if s == side]
        pivot = tuple(weighted_median(np.array([m for _, m in own], np.int64), np.array([w for w, _ in own], np.int64)).tolist())


def ranked(rows: DataFrame, order: list) -> DataFrame:
    """The rows with their ``rank`` (from 1) in an order: sorted by ranges, then numbered within each and shifted by those before it."""
    at = stage(rows.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "winners").withColumn("_part", F.shiftright("_at", 33))
    parts = at.groupBy("_part").agg(F.count("*").alias("_n"))  # a row for each range: as many as shuffle partitions
    before = F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rank = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return at.join(parts.select("_part", before.alias("_before")), "_part").withColumn("rank", rank).drop("_part", "_at", "_before")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of ``docs``; the rank is null where a row is not drawn."""
    prepare(docs.sparkSession)
    # Staging fixes the places, which order rows that are equal otherwise.
    scored = stage(score_documents(docs, target).withColumn("_p", F.monotonically_increasing_id()), "scored")
    keyed = scored.withColumns({"_s": -F.col("score"), "_d": F.coalesce("doc_id", F.lit((1 << 63) - 1))})
    enough = F.col("n_words") >= words
    keys = keyed.filter(enough).select(*KEY)
    last = select_key(keys, keys.count() * percent // 100)
    columns = ["doc_id", "n_features", "weight", "score"]
    if last is None:
        return scored.select(*columns, F.lit(None).cast("bigint").alias("rank"))
    drawn = enough & (F.struct(*KEY) <= _literal(last))
    winners = ranked(keyed.filter(drawn).select(*columns, *KEY), list(KEY))
    return winners.select(*columns, "rank").unionByName(keyed.filter(~drawn).select(*columns, F.lit(None).cast("bigint").alias("rank")))


# The checksum of a text is the exclusive or of what each of its bytes adds, which depends on the byte and
# on how many follow, and of a start value for the length; both come from one recursion over lengths.
ORACLE = """
with recursive bits(b, v, k) as (
  select range::uinteger, range::uinteger, 0 from range(256)
  union all
  select b, case when v & 1 = 1 then xor(v >> 1, 3988292384::uinteger) else v >> 1 end, k + 1 from bits where k < 8),
one as (select b, v from bits where k = 8),
shifts(j, b, v) as (
  select 0, b, v from one
  union all
  select s.j + 1, s.b, xor(s.v >> 8, o.v) from shifts s join one o on o.b = s.v & 255 where s.j < 400),
starts(n, v) as (
  select 0, 4294967295::uinteger
  union all
  select s.n + 1, xor(s.v >> 8, o.v) from starts s join one o on o.b = s.v & 255 where s.n < 400),
texts as (select row_number() over () as r, doc_id, text, true as own from documents union all select row_number() over (), null, text, false from benchmark),
worded as (
  select r, doc_id, own, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from texts),
runs as (
  select r, own, unnest(w) as f from worded
  union all
  select r, own, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) from worded
  union all
  select r, own, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) from worded),
counted as (select r, own, f, count(*) as n from runs group by all),
coded as (select f, hex(encode(f)) as h from (select distinct f from counted)),
bytes as (select f, len(h) // 2 as n, unnest(range(len(h) // 2)) as i, h from coded),
sums as (
  select f, n, bit_xor(s.v) as v from bytes join shifts s on s.j = n - 1 - i and s.b = ('0x' || substr(h, 2 * i + 1, 2))::uinteger group by f, n),
buckets as (select f, xor(xor(sums.v, starts.v), 4294967295::uinteger) % 10000 as bucket from sums join starts using (n)),
found as (select r, own, bucket, sum(n) as n from counted join buckets using (f) group by all),
both_counts as (
  select bucket, coalesce(sum(n) filter (where own), 0)::double as s, coalesce(sum(n) filter (where not own), 0)::double as t from found group by bucket),
totals as (select coalesce(sum(s), 0)::double as s_all, coalesce(sum(t), 0)::double as t_all from both_counts),
gain as (
  select bucket, floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000))))::bigint as gain from both_counts, totals),
weights as (select r, sum(n)::bigint as n_features, sum(n * gain)::bigint as weight from found join gain using (bucket) where own group by r),
scored as (
  select d.r, d.doc_id, len(d.w) as n_words, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(d.doc_id::varchar, '')), 1, 8))::bigint + 0.5::double) / 4294967296)))::bigint as score
  from worded d left join weights using (r) where d.own),
placed as (select r, row_number() over (order by score desc, doc_id, r) as place, count(*) over () as n from scored where n_words >= 20)
select doc_id, n_features::bigint as n_features, weight::bigint as weight, score::bigint as score, case when place <= 5 * n // 100 then place end as rank
from scored left join placed using (r)
"""
