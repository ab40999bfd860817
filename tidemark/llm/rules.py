"""Quality rules whose cutoffs limit the risk of rejecting good documents.

The base rules are fixed: too few words, or too many words in repeated windows.
The method's own rules look at measures of a text (``MEASURES``) that lie on a
fixed grid. Labelled documents are dealt into two halves by a hash of their id:

* the first half proposes, per stratum (language) and rule, the cutoff beyond
  which bad documents outnumber good ones by the most; ``STEPS`` weaker forms
  of the whole rule set follow, each with its cutoffs moved outwards;
* the holdout half certifies: from the weakest form to the strongest, the good
  documents that any rule would reject are counted, and an exact binomial
  (Clopper-Pearson) bound on the rate of false rejection must stay within
  ``RISK``. The first form that fails ends the sequence, so the forms need no
  correction among themselves; the strata share the error level (Bonferroni).

A stratum without enough labelled documents certifies nothing and rejects
nothing beyond the base. Only histograms come to the driver: their size is
bounded by grid, rules and strata.

Words are maximal runs without ASCII white space. A null text has none, and
fails the base. A null language is a stratum of its own. Rows of one doc_id get
results by row. Labels that are null, or contradict each other for one doc_id, count for
neither side. A labelled document counts once in a stratum, however many rows it has
there, with the worst measures among them: repeats would void the exact bound. Extra columns are ignored. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WordHashes, map_batches, prepare, split_words, stage, windows

RISK = 0.01  #: largest rate of good documents that the method's rules may reject, per stratum
ERROR = 0.05  #: chance that the guarantee fails in any stratum
STEPS = 12
GRID = 1000
WINDOW = 8
MIN_WORDS, REPEAT_PERCENT = 20, 30
SYMBOLS = "#*$%&|<>"  # fixed value
#: Measures of a text as shares of its words, characters or lines; a high one is bad.
MEASURES = ("symbols", "capitals", "repeats", "lines", "same_word", "long_words", "no_letters")


def _measure_setup() -> Callable:
    hashes = WordHashes()
    symbol_table = str.maketrans("", "", SYMBOLS)

    def measure(ids, texts, languages):
        out: dict[str, list] = {k: [] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *MEASURES)}
        for text in texts:
            for k, v in counts_of(text or "", hashes, symbol_table).items():
                out[k].append(v)
        return {"doc_id": ids, "lang": languages} | out

    return measure


def repeated(hashes: np.ndarray, width: int = WINDOW) -> int:
    """Words that lie in a window of ``width`` words found twice or more."""
    found = windows(hashes, width)
    if len(found) < 2:
        return 0
    order = np.argsort(found, kind="stable")
    same = found[order[1:]] == found[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(len(found), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(hashes) + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + width, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def counts_of(text: str, hashes: WordHashes, symbol_table: dict | None = None) -> dict[str, float]:
    """Base counts and measures of a text."""
    words = split_words(text)
    n = len(words)
    own = hashes.of(words)
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    n_symbols = len(text) - len(text.translate(symbol_table or str.maketrans("", "", SYMBOLS)))
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    lead = (data & 0xC0) != 0x80  # one byte of each code point
    word_chars = int((lead & ~space).sum())
    n_repeat = repeated(own)
    out: dict[str, float] = {"n_words": n, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": n_repeat}
    if not n:
        return out | dict.fromkeys(MEASURES, 0.0)
    capital = int(((data >= 65) & (data <= 90)).sum())
    small = int(((data >= 97) & (data <= 122)).sum())
    letters = (data | 0x20 >= 97) & (data | 0x20 <= 122) | (data >= 0xC3)
    ends = np.flatnonzero(np.append(~space[:-1] & space[1:], True)) if len(data) else np.empty(0, int)
    letter_sums = np.concatenate([[0], np.cumsum(letters)])
    edges = np.concatenate([[0], ends + 1])
    per_word = letter_sums[edges[1:]] - letter_sums[edges[:-1]]
    _, times = np.unique(own, return_counts=True)
    return out | {
        "symbols": min(1.0, n_symbols / word_chars),
        "capitals": capital / max(1, capital + small),
        "repeats": n_repeat / n,
        "lines": (len(lines) - len(set(lines))) / max(1, len(lines)),
        "same_word": float(times.max()) / n,
        "long_words": max(map(len, words)) / max(40, word_chars),
        "no_letters": float((per_word == 0).sum()) / max(1, len(per_word)),
    }


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, base counts, measures) of every row of ``docs`` (doc_id, text, lang)."""
    ddl = "doc_id bigint, lang string, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    return map_batches(docs, ["doc_id", "text", "lang"], _measure_setup, ddl + ", ".join(f"{m} double" for m in MEASURES))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def upper_bound(rejected: int, total: int, error: float) -> float:
    """The exact (Clopper-Pearson) upper bound of a rate at confidence ``1 - error``."""
    if rejected >= total:
        return 1.0
    low, high = rejected / total, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        if 0 < middle < 1 and at_most(rejected, total, middle) > error:
            low = middle
        else:
            high = middle
    return high


def at_most(rejected: int, total: int, rate: float) -> float:
    """The chance of at most ``rejected`` among ``total`` at a rate: one sum over the terms, each from the one before."""
    k = np.arange(1, rejected + 1, dtype=float)
    steps = np.log((total - k + 1) / k) + np.log(rate) - np.log1p(-rate)
    logs = total * np.log1p(-rate) + np.concatenate([[0.0], np.cumsum(steps)])
    top = logs.max()
    return float(np.exp(top) * np.exp(logs - top).sum())


def certified(rejected: int, total: int, risk: float, error: float) -> bool:
    """Whether ``upper_bound`` is within the risk, decided by one sum at that rate, and none where the share is beyond it."""
    return rejected < total and rejected <= risk * total and at_most(rejected, total, risk) <= error


def propose(good: np.ndarray, bad: np.ndarray) -> int:
    """The grid cell from which rejecting gains most, bad documents less good ones, of those that stay near a rule's share of the risk."""
    tail_good, tail_bad = good[::-1].cumsum()[::-1], bad[::-1].cumsum()[::-1]
    gain = tail_bad - tail_good
    gain = np.where(tail_good <= RISK * good.sum() / len(MEASURES) * 2, gain, -1)
    best = int(gain.argmax())
    return best if gain[best] > 0 else GRID + 1


def _cell(measure: str) -> Column:
    return F.least(F.lit(GRID), F.floor(F.col(measure) * GRID)).cast("int")


def learn_cutoffs(rows: DataFrame, labels: DataFrame) -> dict[str | None, dict[str, int]]:
    """By stratum the certified cutoff cell of each rule; a rule rejects from its cell upwards.

    ``rows`` as made by ``measured``; ``labels`` (doc_id, quality).
    """
    sure = labels.filter("quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
    sure = sure.filter("quality = other and doc_id is not null").select(F.col("doc_id").alias("label_id"), "quality")
    half = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(13)), F.lit(2))
    known = rows.filter(~base_failed()).join(sure, F.col("doc_id") == F.col("label_id"))
    known = known.groupBy("doc_id", "lang", "quality").agg(*[F.max(_cell(m)).alias(m) for m in MEASURES])
    known = stage(known.select("lang", "quality", half.alias("half"), *MEASURES), "labelled-measures")
    first = known.filter("half = 0").select("lang", "quality", F.explode(F.array(*[F.struct(F.lit(m).alias("m"), F.col(m).alias("cell")) for m in MEASURES])).alias("x"))
    table: dict = {}
    for r in first.groupBy("lang", "quality", "x.m", "x.cell").agg(F.count("*").alias("n")).collect():
        table.setdefault((r["lang"], r["m"]), np.zeros((2, GRID + 2)))[r["quality"], r["cell"]] += r["n"]
    proposed: dict = {}
    for (language, m), (bad, good) in table.items():
        proposed.setdefault(language, {})[m] = propose(good, bad)
    forms = {x: [{m: min(GRID + 1, c + round((GRID + 1 - c) * s / STEPS)) for m, c in cells.items()} for s in range(STEPS, -1, -1)] for x, cells in proposed.items()}
    if not forms:
        return {}
    # The strongest form that rejects each good holdout document: it is rejected by that form and all stronger ones.
    good = known.filter("half = 1 and quality = 1")
    per_form = [F.count_if(_rejected(good, {x: f[s] for x, f in forms.items()})).alias(f"f{s}") for s in range(STEPS + 1)]
    out = {}
    for r in good.groupBy("lang").agg(F.count("*").alias("n"), *per_form).collect():
        if r["lang"] not in forms:
            continue
        for s in range(STEPS + 1):
            if not certified(r[f"f{s}"], r["n"], RISK, ERROR / len(forms)):
                break
            out[r["lang"]] = forms[r["lang"]][s]
    return out


def _rejected(rows: DataFrame, cutoffs: dict, cell: Callable[[str], Column] = F.col) -> Column:
    """Whether any rule of a row's stratum rejects it."""
    rejected = F.lit(False)
    for language, cells in cutoffs.items():
        fires = [cell(m) >= c for m, c in cells.items() if c <= GRID]
        any_fires = F.lit(False)
        for f in fires:
            any_fires = any_fires | f
        rejected = rejected | (F.col("lang").eqNullSafe(F.lit(language)) & any_fires)
    return rejected


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Base counts, base_failed and kept of every row of ``docs`` (doc_id, text, lang), by rules certified on ``labels``."""
    prepare(docs.sparkSession)
    rows = stage(measured(docs), "measures")
    cutoffs = learn_cutoffs(rows, labels)
    failed = base_failed()
    kept = ~failed & ~_rejected(rows, cutoffs, _cell)
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), kept.alias("kept"), *MEASURES)
