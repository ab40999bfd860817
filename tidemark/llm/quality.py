"""Quality score by compression: dictionaries of good and bad text, and how much better one of them compresses.

Windows of labelled texts make two zstandard dictionaries, one of good and one
of bad documents. A text is compressed with both, in frames of ``FRAME`` bytes: within one
frame a long text would soon be its own dictionary, and both sizes alike. The difference of the
summed sizes, per byte of text, is its margin. On labelled documents that are in neither
dictionary the share of good ones by margin, made monotone (isotonic), calibrates
the score.

Both dictionaries come from at most about ``SAMPLE`` documents of each label,
picked by the hash of their id, one window of at most ``WINDOW`` characters each. A
dictionary has ``DICTIONARY_BYTES``; the longest windows are cut to one length so that all enter (about
700 bytes each when all are long). The calibration uses all labelled documents of which
nothing entered, as a histogram of ``CELLS`` cells. Rows that repeat a labelled document enter once:
one window (the least) per doc_id, one count per doc_id and cell.
Scores are of whole texts. Labels that are null, or contradict each other for one
doc_id, are left out.

A null or empty text has margin 0, and the score that goes with it. Without any label
every score is 0.5; without one of the two labels, near the other. Repeated rows
get equal scores, a null doc_id is never learned from. Extra columns are ignored. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_remainder, map_batches, prepare, stage

FOLDS, HELD_OUT = 5, 0
SAMPLE = 1500
WINDOW = 2000
DICTIONARY_BYTES = 1 << 20
LEVEL = 3
CELLS = 1000
WIDEST = 0.4  #: margins beyond this lie in the last cells
ENOUGH = 0.3  #: score from which on a document is predicted good
FRAME = 1 << 14  #: bytes compressed at a time
OVERHEAD = 16  #: bytes added to a text's length, so that short texts have no wild margins


def sure_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, quality) of documents whose labels agree."""
    agreed = labels.filter("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
    return agreed.filter("quality = other").select("doc_id", "quality")


def held_out(column: str = "doc_id") -> Column:
    return F.coalesce(id_remainder(column, FOLDS) == HELD_OUT, F.lit(False))


def _dictionary(samples: list[str]) -> bytes:
    """Content of a dictionary: all samples, the longest cut to one length so that they fit, the last of them nearest."""
    data = [x.encode("utf-8", "surrogatepass") for x in samples]
    left, most = DICTIONARY_BYTES - len(data), 0
    for k, size in enumerate(sorted(map(len, data))):
        most = min(size, left // (len(data) - k))
        if most < size:
            break
        left -= size
    return b"\n".join(x[:most] for x in data).ljust(16, b"\n")


def _margins(bad: bytes, good: bytes) -> Callable:
    def setup():
        compress = []
        for content in (bad, good):
            held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=LEVEL)
            compress.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False).compress)
        with_bad, with_good = compress

        def margin(text: str | None) -> float:
            data = (text or "").encode("utf-8", "surrogatepass")
            frames = [data[k : k + FRAME] for k in range(0, len(data), FRAME)]
            excess = sum(len(with_bad(f)) - len(with_good(f)) for f in frames)
            return excess / (len(data) + OVERHEAD * len(frames)) if data else 0.0

        return lambda ids, texts: {"doc_id": ids, "margin": [margin(t) for t in texts]}

    return setup


def learn_dictionaries(docs: DataFrame, known: DataFrame, sample: int = SAMPLE) -> tuple[bytes, bytes, Column]:
    """Dictionaries of bad and good text, and which labelled rows (doc_id, quality) they were made of."""
    totals = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    rate = [min(0.5, sample / totals[q]) if totals.get(q) else 0.0 for q in (0, 1)]
    part = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 20)) / float(1 << 20)
    sampled = part < F.when(F.col("quality") == 1, rate[1]).otherwise(rate[0])
    picked = F.broadcast(known.filter(sampled).select(F.col("doc_id").alias("label_id"), "quality"))  # bounded by the sample
    start = (F.pmod(F.xxhash64("doc_id", F.lit(19)), F.greatest(F.lit(1), F.length("text") - WINDOW)) + 1).cast("int")
    rows = docs.select("doc_id", "text").filter("text <> ''").join(picked, F.col("doc_id") == F.col("label_id"))
    windows = rows.groupBy("doc_id", "quality").agg(F.min(F.substring("text", start, F.lit(WINDOW))).alias("text"))
    texts = windows.select("doc_id", "quality", F.xxhash64("doc_id").alias("place"), "text").collect()
    texts.sort(key=lambda r: (r["place"], r["text"]))
    bad, good = (_dictionary([r["text"] for r in texts if r["quality"] == q]) for q in (0, 1))
    return bad, good, F.col("doc_id").isin({r["doc_id"] for r in texts})


def isotonic(good: np.ndarray, total: np.ndarray, prior: float) -> np.ndarray:
    """The monotone share of good ones by cell, with one document of the prior spread over the cells."""
    weight = total + 1 / len(total)
    blocks: list[list[float]] = []
    for share, w in zip((good + prior / len(total)) / weight, weight, strict=True):
        blocks.append([share, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            s2, w2, n2 = blocks.pop()
            s1, w1, n1 = blocks.pop()
            blocks.append([(s1 * w1 + s2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.concatenate([np.full(int(n), s) for s, _, n in blocks])


def _cell() -> Column:
    return F.least(F.lit(CELLS - 1), F.greatest(F.lit(0), F.floor((F.col("margin") / WIDEST + 1) * (CELLS / 2)))).cast("int")


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs`` (doc_id, text), learned from ``labels`` (doc_id, quality)."""
    prepare(docs.sparkSession)
    known = stage(sure_labels(labels).filter(~held_out()), "quality-labels")
    bad, good, used = learn_dictionaries(docs, known)
    rows = stage(map_batches(docs, ["doc_id", "text"], _margins(bad, good), "doc_id bigint, margin double"), "margins")
    others = known.filter(~used).select(F.col("doc_id").alias("label_id"), "quality")
    cells = rows.join(others, F.col("doc_id") == F.col("label_id")).select("doc_id", _cell().alias("cell"), "quality").distinct()
    counts = cells.groupBy("cell", "quality").agg(F.count("*").alias("n")).collect()
    table = np.zeros((2, CELLS))
    for r in counts:
        table[r["quality"], r["cell"]] = r["n"]
    prior = float((table[1].sum() + 0.5) / (table.sum() + 1))
    steps = isotonic(table[1], table.sum(axis=0), prior)
    scores = 0.999 * steps + 0.001 * (np.arange(CELLS) + 0.5) / CELLS  # cells of one step stay in order
    score = F.element_at(F.array(*[F.lit(float(s)) for s in scores]), _cell() + 1)
    out = rows.select("doc_id", held_out().alias("held_out"), score.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= ENOUGH).cast("int"))
