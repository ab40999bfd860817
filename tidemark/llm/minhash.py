"""Near-duplicate documents: signature-coordinate inverted join, prefix and skip merging, exact confirmation.

1. A document is the set of its distinct five-word shingles (A-Z lower-cased,
   words split at ASCII white space; fewer words: the whole sequence as one;
   none: the empty set, linked with nothing). Equal sets become one class.
2. A class is signed by ``COORDINATES`` 64-bit minima and posted under each
   coordinate-value pair that another class has too.
3. Two classes that agree in at least ``MATCHES`` coordinates share one of the
   ``COORDINATES - MATCHES + 1`` rarest pairs of each. Only these are posted, so
   frequent pairs (passages that many documents hold) are skipped, and a class
   with too few shared pairs is not merged at all. At a similarity of 0.75 a
   pair falls below the threshold with probability 0.00005.
4. Round one merges each list with its most central member only, which is
   linear in the list. Collisions are counted over the whole signatures, pairs that reach
   the threshold are confirmed on full sets, and components follow.
5. Round two takes the lists whose other members still lie in several
   components, those of one pivot together, deals them out in pairs of bounded
   blocks, and confirms the pairs that lie in different components. After it
   every pair of every list is confirmed, refused, or inside one component.

Links are pairs of documents with 100 * intersection >= 75 * union. A null text is
empty. A null doc_id has a null component, is kept, and links with nothing.
Repeated rows get equal results. A component is named by the least doc_id of its
rows. Rows of one doc_id with different texts
are documents of their own: sharing an id links nothing, components that share their least
id have one name, and where a component holds several texts of its least id, those
of the least set hash are its ``first`` ones. Sets are told apart by 64 of their hash's bits in links,
by 128 among exact copies. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.common import WordHashes, as_schema, components, in_blocks, map_batches, mix, prepare, runs, split_words, stage, windows
from tidemark.operators.sizing import broadcast_if_small

COORDINATES = 32
MATCHES = 14
SHINGLE = 5
PERCENT = 75
COLUMNS = 4096  #: shingles of one incidence matrix
BLOCK = 256  #: members of a block of a posting list; members confirmed against one pivot in one task

_RNG = np.random.default_rng(20240611)
_A = _RNG.integers(0, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)


def shingle_set(text: str | None, words: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a text."""
    found = split_words(text)
    if not found:
        return np.empty(0, np.uint64)
    hashes = words.of([w.lower() for w in found])
    return np.unique(windows(hashes, min(SHINGLE, len(hashes))) + np.uint64(min(SHINGLE, len(hashes))))


def set_hash(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that are equal for equal sets."""
    with np.errstate(over="ignore"):
        lo = int(mix(shingles).sum(dtype=np.uint64))
        hi = int(mix(shingles ^ _B[0]).sum(dtype=np.uint64))
    return lo - (1 << 63), hi - (1 << 63)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least hash under each coordinate, mixed with the coordinate's number."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 2048):
        part = shingles[at : at + 2048, None] * _A + _B
        np.minimum(least, part.min(axis=0), out=least)
    return mix(least + np.arange(COORDINATES, dtype=np.uint64)).view(np.int64)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets reach the similarity."""
    least, most = sorted((len(a), len(b)))
    if 100 * least < PERCENT * most:
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= PERCENT * (len(a) + len(b) - shared)


def _sign() -> Callable:
    words = WordHashes()

    def sign(ids, texts, digests):
        out = {"doc_id": ids, "digest": digests, "n_shingles": [], "lo": [], "hi": [], "sig": []}
        for text in texts:
            s = shingle_set(text, words)
            lo, hi = set_hash(s)
            out["n_shingles"].append(len(s))
            out["lo"].append(lo)
            out["hi"].append(hi)
            out["sig"].append(signature(s) if len(s) else None)
        return out

    return sign


def _with_digest(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64("text").alias("digest"))


def _classes(signed: DataFrame) -> DataFrame:
    """(node, hi, doc_id, digest, sig): each distinct set that some document with an id holds; node is its hash.

    ``doc_id`` and ``digest`` are those of its first row: the least id, the least digest under it.
    """
    first = F.min(F.struct("doc_id", "digest")).alias("f")
    sets = signed.filter("n_shingles > 0 and doc_id is not null").groupBy("lo", "hi").agg(first, F.any_value("sig").alias("sig"))
    return sets.select(F.col("lo").alias("node"), "hi", "f.doc_id", "f.digest", "sig")


def _texts(docs: DataFrame, classes: DataFrame, prefixes: DataFrame) -> DataFrame:
    """(node, text): the text of the first row of each posted class.

    The rows meet the posted keys before they are put together, so where these
    keys are few enough to be broadcast, only the texts of candidates move.
    """
    posted = classes.join(prefixes.select("node").distinct(), "node").select("node", "doc_id", "digest")
    posted = broadcast_if_small(stage(posted, "posted"))
    rows = _with_digest(docs).join(posted, ["doc_id", "digest"])
    return rows.groupBy("node").agg(F.any_value("text").alias("text"))


def _prefixes(classes: DataFrame) -> DataFrame:
    """(key, node, weight): the rarest coordinate-value pairs of each class, as many as the threshold needs.

    The weight is the number of collisions of a class over all its pairs: in a
    group of copies the original, whose values most of them kept, has most.
    """
    posted = classes.select("node", F.explode("sig").alias("key"))
    shared = stage(posted.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "pair-counts")
    own = posted.join(shared, "key").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("own"))
    kept = own.filter(F.size("own") >= MATCHES)
    weight = F.aggregate("own", F.lit(0).cast("bigint"), lambda s, x: s + x["n"])
    prefix = F.explode(F.slice("own", F.lit(1), F.size("own") - (MATCHES - 1))).alias("o")
    return kept.select("node", weight.alias("weight"), prefix).select(F.col("o.key").alias("key"), "node", "weight")


def _collide(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures agree in enough coordinates."""
    sig = classes.select("node", "sig")
    both = pairs.join(sig.select(F.col("node").alias("a"), F.col("sig").alias("sa")), "a").join(sig.select(F.col("node").alias("b"), F.col("sig").alias("sb")), "b")
    equal = F.aggregate(F.zip_with("sa", "sb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return both.filter(equal >= MATCHES).select("a", "b")


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) that are links on their full sets; each text moves once per pivot ``b`` that it meets."""
    sizes = pairs.groupBy("b").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    members = pairs.join(sizes, "b").select(F.col("b").alias("pivot"), F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int").alias("part"), F.lit(1).alias("side"), F.col("a").alias("node"))
    pivots = sizes.select(F.col("b").alias("pivot"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("part"), F.lit(0).alias("side"), F.col("b").alias("node"))
    dealt = members.unionByName(pivots).join(texts, "node").select("pivot", "part", "side", "node", "text").repartition("pivot", "part").sortWithinPartitions("pivot", "part", "side")
    schema = as_schema("a bigint, b bigint")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, at, pivot = WordHashes(), None, None
        for batch in batches:
            a, b = [], []
            for p, part, side, node, text in zip(*[batch.column(c).to_pylist() for c in ("pivot", "part", "side", "node", "text")], strict=True):
                s = shingle_set(text, words)
                if side == 0:
                    at, pivot = (p, part), s
                elif at == (p, part) and similar(pivot, s):
                    a.append(node)
                    b.append(p)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=to_arrow_schema(schema))

    return dealt.mapInArrow(confirm, schema).distinct()


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """The number of shingles that each two sets share, by products of incidence matrices."""
    own = np.concatenate([np.full(len(s), i, np.int64) for i, s in enumerate(sets)])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    held = times[column] > 1
    own, column = own[held], np.unique(column[held], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    own, column = own[order], column[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, (at, at + COLUMNS))
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[own[a:b], column[a:b] - at] = 1
        out += part @ part.T
    return out.astype(np.int64)


def forest(a: np.ndarray, b: np.ndarray, component: np.ndarray) -> tuple[list[int], list[int]]:
    """Of the links between rows a and b, those that join what the others and the components have not joined."""
    root = {c: c for c in component.tolist()}

    def find(c):
        while root[c] != c:
            root[c] = c = root[root[c]]
        return c

    kept: tuple[list[int], list[int]] = ([], [])
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = find(int(component[x])), find(int(component[y]))
        if p != q:
            root[max(p, q)] = min(p, q)
            kept[0].append(x)
            kept[1].append(y)
    return kept


def _rest(prefixes: DataFrame, pivots: DataFrame, linked: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) that join components within the lists of a pivot, confirmed on full sets.

    Lists with the same pivot are taken together: their members move once for
    all of them. A task holds two blocks of such a group; it counts shared
    shingles for all pairs at once and returns a spanning forest of the links.
    """
    at = linked.select(F.col("id").alias("node"), "component")
    others = prefixes.join(pivots, "key").filter("node <> pivot").select("pivot", "node").distinct()
    others = stage(others.join(at, "node", "left").withColumn("component", F.coalesce("component", "node")), "others")
    mixed = others.groupBy("pivot").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y").select("pivot")
    open_groups = others.join(stage(mixed, "mixed"), "pivot")
    dealt = in_blocks(open_groups, "pivot", "node", BLOCK).join(texts, "node").select("pivot", "_i", "_j", "_own", "node", "component", "text")
    dealt = dealt.repartition("pivot", "_i", "_j").sortWithinPartitions("pivot", "_i", "_j")
    schema = as_schema("a bigint, b bigint")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for run in runs(batches, ("pivot", "_i", "_j")):
            own, node, component = (run.column(c).to_numpy() for c in ("_own", "node", "component"))
            if (component == component[0]).all():
                continue
            sets = [shingle_set(t.as_py(), words) for t in run.column("text")]
            size = np.array([len(s) for s in sets])
            shared = shared_counts(sets)
            linked = 100 * shared >= PERCENT * (size[:, None] + size[None, :] - shared)
            linked &= component[:, None] != component[None, :]
            linked &= (own[:, None] != own[None, :]) | (run.column("_i")[0] == run.column("_j")[0])
            a, b = forest(*np.nonzero(np.triu(linked, 1)), component)
            a, b = np.maximum(node[a], node[b]), np.minimum(node[a], node[b])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=to_arrow_schema(schema))

    return dealt.mapInArrow(confirm, schema).distinct()


def _judged(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text)."""
    prepare(docs.sparkSession)
    ddl = "doc_id bigint, digest bigint, n_shingles bigint, lo bigint, hi bigint, sig array<bigint>"
    signed = stage(map_batches(_with_digest(docs), ["doc_id", "text", "digest"], _sign, ddl), "signed")
    classes = stage(_classes(signed), "classes")
    prefixes = stage(_prefixes(classes), "prefixes")
    texts = stage(_texts(docs, classes, prefixes), "texts")
    central = F.max(F.struct("weight", "node"))["node"]
    pivots = stage(prefixes.groupBy("key").agg(central.alias("pivot"), F.count("*").alias("n")).filter("n > 1").select("key", "pivot"), "pivots")
    pairs = prefixes.join(pivots, "key").filter("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    pairs = stage(_collide(pairs, classes), "pairs")
    links = stage(_confirmed(pairs, texts), "links")
    linked = stage(components(links), "linked")
    rest = stage(_rest(prefixes, pivots, linked, texts), "rest")
    if not rest.isEmpty():
        linked = components(links.unionByName(rest))
    # The least id of each component, and the set that is kept of those that have it.
    members = linked.withColumnRenamed("id", "node").join(classes.select("node", "doc_id"), "node")
    least = members.groupBy("component").agg(F.min(F.struct("doc_id", "node")).alias("first"))
    named = members.join(least, "component").select("node", F.col("first.doc_id").alias("c"), F.col("first.node").alias("kept_node"))
    of_class = classes.select(F.col("node").alias("lo"), "hi", F.col("doc_id").alias("own")).join(named.withColumnRenamed("node", "lo"), "lo", "left")
    of_class = of_class.select("lo", "hi", F.coalesce("c", "own").alias("c"), F.coalesce("kept_node", "lo").alias("kept_node"))
    out = signed.select("doc_id", "digest", "n_shingles", "lo", "hi").join(of_class, ["lo", "hi"], "left")
    alone = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("c"))
    kept = alone | (F.col("doc_id") == F.col("c")) & (F.col("lo") == F.col("kept_node"))
    return out.select("doc_id", "digest", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, first) of every row of ``docs`` (doc_id, text).

    ``kept`` says that the row's id names its component; ``first``, that
    ``drop_near_duplicates`` keeps the row.
    """
    alone = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return _judged(docs).select("doc_id", "n_shingles", "component_id", alone.alias("kept"), F.col("kept").alias("first"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of one document of each group, the one with the least doc_id; all their columns.

    Texts stay where they are while the list of what goes, 48 bytes a row, is small enough to be broadcast; beyond that they are exchanged once.
    """
    gone = _judged(docs).filter("not kept").select(F.col("doc_id").alias("_gone_id"), F.col("digest").alias("_gone_digest")).distinct()
    return docs.join(broadcast_if_small(stage(gone, "gone")), (docs["doc_id"] == F.col("_gone_id")) & (F.xxhash64(docs["text"]) == F.col("_gone_digest")), "left_anti")


#: Every pair of documents that shares a shingle, counted on full sets, and what each document reaches.
ORACLE = f"""
with recursive d as (
  select row_number() over () as r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w
  from documents
),
s as (
  select r, doc_id, unnest(list_distinct(
    [array_to_string(w[i:i + {SHINGLE - 1}], ' ') for i in range(1, greatest(len(w) - {SHINGLE - 1}, 1) + 1)])) as shingle
  from d where len(w) > 0
),
size as (select r, any_value(doc_id) as doc_id, count(*) as n from s group by r),
shared as (
  select a.r as a, b.r as b, count(*) as n from s a join s b on a.shingle = b.shingle and a.r <> b.r
  where a.doc_id is not null and b.doc_id is not null group by a.r, b.r
),
links as (
  select a, b from shared join size x on x.r = a join size y on y.r = b
  where 100 * shared.n >= {PERCENT} * (x.n + y.n - shared.n)
),
reach as (
  select r, doc_id as id from size where doc_id is not null
  union
  select links.b, reach.id from reach join links on links.a = reach.r
),
component as (select r, min(id) as id from reach group by r)
select d.doc_id, coalesce(size.n, 0) as n_shingles, coalesce(component.id, d.doc_id) as component_id,
  d.doc_id is not distinct from coalesce(component.id, d.doc_id) as kept
from d left join size using (r) left join component using (r)
"""
