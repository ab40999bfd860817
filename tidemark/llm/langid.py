"""Language identification: bit-sliced Bloom filters over n-grams, whose words are sets of languages.

A slot of the filter is a bitmask of languages. An n-gram has ``PROBES`` slots;
the bitwise and of their masks is the set of all languages that hold the n-gram.
Counted over a text, the masks give a number of hits per language, from which
the false positives expected of that language's filled slots are taken off. The
language with the most corrected hits is the answer.

A language's filter holds the n-grams found in at least ``SHARE`` of its training
documents. At most about ``PER_LANGUAGE`` documents of a language, picked by the
hash of their id and text, train it; each is read whole, and rows that repeat one enter once. N-grams are four characters of
the lower-cased text in which every run of other characters than letters is one
space; the text is framed by spaces.

A null text, or one without a letter, is ``und`` with score 0. Other texts get a
learned language: without any hit, the one with the most training documents
(ties: the first by code point). With nothing learned every text is ``und``, and
``keep_identified`` keeps the texts with a letter, as it does otherwise.
Documents with a null id are learned from. Extra columns are ignored, or kept
by ``keep_identified``. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.common import as_schema, id_remainder, map_batches, prepare, stage

GRAM = 4
PER_LANGUAGE = 4000
SHARE = 0.02
SLOT_BITS = 18
PROBES = 2
UNKNOWN = "und"
FOLDS, HELD_OUT = 3, 1
_CODE = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)

_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    """By code point, whether it is a letter."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def grams(text: str | None) -> np.ndarray:
    """Hashes of a text's n-grams, in order; empty without a letter."""
    if not text:
        return np.empty(0, np.uint64)
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _is_letter()[codes]
    if not letter.any():
        return np.empty(0, np.uint64)
    kept = letter.copy()
    kept[1:] |= letter[:-1]  # the first character after a letter stands for the run
    framed = np.full(int(kept.sum()) + 2, 32, np.uint64)
    framed[1:-1] = np.where(letter, codes, 32)[kept]
    if framed[-2] == 32:
        framed = framed[:-1]
    n = len(framed) - GRAM + 1
    if n <= 0:  # a single letter between two spaces
        framed, n = np.concatenate([framed, np.full(1 - n, 32, np.uint64)]), 1
    out = framed[:n] * _CODE[0]
    for i in range(1, GRAM):
        out += framed[i : i + n] * _CODE[i]
    out ^= out >> np.uint64(31)
    out *= _CODE[1]
    return out


@dataclass
class Filters:
    """The bit-sliced filter: ``slots[s]`` is the set of languages that have slot s, as bits."""

    languages: list[str]
    slots: np.ndarray  # (2 ** SLOT_BITS, words of 16 languages) unsigned 16-bit

    @staticmethod
    def places(hashes: np.ndarray) -> list[np.ndarray]:
        shift = np.uint64(64 - SLOT_BITS)
        return [((hashes * _CODE[1 + p]) >> shift).astype(np.int64) for p in range(PROBES)]

    @classmethod
    def build(cls, languages: list[str], held: dict[str, np.ndarray]) -> Filters:
        slots = np.zeros((1 << SLOT_BITS, -(-max(1, len(languages)) // 16)), np.uint16)
        for i, language in enumerate(languages):
            for place in cls.places(held.get(language, np.empty(0, np.uint64))):
                slots[place, i // 16] |= np.uint16(1 << (i % 16))
        return cls(languages, slots)

    def false_positive(self) -> np.ndarray:
        """By language, the chance that a strange n-gram is found."""
        words = self.slots.shape[1]
        fill = [(self.slots[:, i // 16] >> np.uint16(i % 16) & 1).mean() for i in range(len(self.languages))]
        return np.array(fill) ** PROBES if words else np.zeros(0)

    def hits(self, hashes: np.ndarray) -> np.ndarray:
        """By language, the n-grams whose mask holds it."""
        first, *others = self.places(hashes)
        masks = self.slots[first]
        for place in others:
            masks &= self.slots[place]
        out = np.zeros(16 * self.slots.shape[1])
        for word in range(self.slots.shape[1]):
            counts = np.bincount(masks[:, word], minlength=1 << 16)
            seen = np.flatnonzero(counts)
            for bit in range(16):
                out[16 * word + bit] = counts[seen[(seen >> bit) & 1 == 1]].sum()
        return out[: len(self.languages)]


def _label(filters: Filters, rates: np.ndarray, text: str | None) -> tuple[str, float]:
    hashes = grams(text)
    if not len(hashes) or not filters.languages:
        return UNKNOWN, 0.0
    share = np.clip((filters.hits(hashes) / len(hashes) - rates) / np.maximum(1 - rates, 1e-9), 0, 1)
    best = int(share.argmax())  # languages stand in order of their documents, so ties go to the most frequent
    rival = np.delete(share, best).max(initial=0.0)
    total = share[best] + rival
    return filters.languages[best], float(share[best] / total) if total > 0 else 0.0


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE, share: float = SHARE) -> Filters:
    """Filters from the rows of ``docs`` (doc_id, text, lang) with a language.

    To the driver come a count per language and the n-grams of the filters, whose
    number the share bounds; the sample bounds what is counted.
    """
    prepare(docs.sparkSession)
    known = docs.filter("lang is not null").select("doc_id", "text", "lang")
    totals = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(totals, key=lambda x: (-totals[x], x))
    if not languages:
        return Filters.build([], {})
    place = F.xxhash64("doc_id", "text", F.lit(7))  # the id alone may be one for a third of the rows
    part = F.pmod(place, F.lit(1 << 20)) / float(1 << 20)
    rate = F.element_at(F.create_map(*[F.lit(v) for x in languages for v in (x, min(1.0, per_language / totals[x]))]), F.col("lang"))
    sample = known.filter(part < rate).groupBy("lang", place.alias("place")).agg(F.min("text").alias("text"))
    sample = stage(sample, "language-sample")
    schema = as_schema("language int, gram bigint, n bigint")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {x: i for i, x in enumerate(languages)}
        for batch in batches:
            own: dict[int, list[np.ndarray]] = {}
            for text, language in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                own.setdefault(number[language], []).append(np.unique(grams(text)))
            columns = ([], [], [])
            for language, found in own.items():
                gram, n = np.unique(np.concatenate(found), return_counts=True)
                for c, v in zip(columns, (np.full(len(gram), language, np.int32), gram.view(np.int64), n), strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c) if c else [], f.type) for c, f in zip(columns, to_arrow_schema(schema), strict=True)], schema=to_arrow_schema(schema))

    counts = stage(sample.select("text", "lang").mapInArrow(count, schema), "gram-counts")
    sampled = {r["lang"]: r["n"] for r in sample.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    least = F.element_at(F.create_map(*[F.lit(v) for i, x in enumerate(languages) for v in (i, max(1.0, share * sampled.get(x, 0)))]), F.col("language"))
    rows = counts.groupBy("language", "gram").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select("language", "gram").toPandas()
    held = {languages[i]: part["gram"].to_numpy().view(np.uint64) for i, part in rows.groupby("language")}
    return Filters.build(languages, held)


def predictor(filters: Filters) -> Callable:
    def setup():
        rates = filters.false_positive()

        def predict(ids, texts):
            labels = [_label(filters, rates, t) for t in texts]
            return {"doc_id": ids, "lang_pred": [x for x, _ in labels], "score": [s for _, s in labels]}

        return predict

    return setup


def predict(docs: DataFrame, filters: Filters) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of ``docs`` (doc_id, text)."""
    return map_batches(docs, ["doc_id", "text"], predictor(filters), "doc_id bigint, lang_pred string, score double")


def held_out(column: str = "doc_id", folds: int = FOLDS, fold: int = HELD_OUT) -> Column:
    return F.coalesce(id_remainder(column, folds) == fold, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): filters learned from the rows not held out, applied to all."""
    prepare(docs.sparkSession)
    filters = learn(docs.filter(~held_out()))
    return predict(docs, filters).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows with a language, or with a letter if none was learned, all their columns; texts without a letter go."""
    prepare(docs.sparkSession)
    filters = learn(docs.filter(~held_out()))

    @F.pandas_udf("boolean")
    def known(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        rates = filters.false_positive()
        for part in parts:
            yield pd.Series([_label(filters, rates, t)[0] != UNKNOWN if filters.languages else len(grams(t)) > 0 for t in part], dtype=bool)

    return docs.filter(known(F.col("text")))
