"""Near-duplicate vectors: iterative quantisation, multi-index Hamming tables, rerank with the original vectors.

1. Equal vectors of one label are one class.
2. On a bounded sample of unit vectors (``SAMPLE``, picked by hash) their principal
   directions and a rotation are learned that bring the rotated values close to
   their signs. Each class gets these signs as a balanced binary code.
3. A code is cut into parts, one for each table. In each table a class is posted under its
   part and under all parts one bit away, so that two classes whose parts differ in at
   most two bits share a key: with t tables no pair within 3t - 1 bits is missed. Parts
   grow by a bit when the classes double, so that lists of unlike vectors keep their
   length; the number of tables follows from the recall wanted (``Layout``), without a cap. Signs
   are taken around a point between the origin and the sample's mean, so angles are too: near
   the mean codes are balanced but the angles of a link grow with a strong common component, and
   with them the tables; near the origin they do not, but unlike vectors meet more often. The
   point of least cost is taken (``centred_layout``).
4. A pair is judged in one list only: of its first table in which it meets, under
   the least key that both have, and if its codes are within the radius. Lists up to ``BLOCK``
   members give pairs, which are reranked by cosine. Longer lists, such as those
   of a large group of near copies, are dealt out in pairs of blocks, which
   compare the original vectors and return counts and a spanning forest, not pairs.

Links are pairs of one label with a cosine of at least ``COSINE`` in double precision,
found with a recall of about 0.95 at that cosine and of nearly 1 above 0.96. Vectors that are
null, empty, zero or hold null or non-finite values, rows with a null label and
vectors of different lengths link with nothing. A null vec_id has no links and a null
component, and is kept. Rows of one vec_id count as vectors of their own. Extra
columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.common import as_schema, components, in_blocks, map_batches, prepare, runs, stage

COSINE = 0.93
LEAST_WIDTH = 16  #: bits of a part, at least
MISSED = 0.02  #: share of the pairs at ``COSINE`` that may meet in no table, by independent bits
RADIUS_SHARE = 0.2  #: bits of a code that may differ, at least
BEYOND = 0.001  #: share of the pairs at ``COSINE`` that may differ in more bits than the radius
SAMPLE = 20_000
ROUNDS = 50
BLOCK = 256
POSTING = 30  #: what a posting costs, in comparisons of two codes
CENTRES = (1.0, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1, 0.0)  #: shares of the mean that signs may be taken around
POSTED_BYTES = 1 << 23  #: codes of the postings that a task holds at once


def bit_shares(spread: np.ndarray) -> np.ndarray:
    """The chance that a bit of two vectors at ``COSINE`` differs, by their squared distance from the mean."""
    return np.arccos(np.clip(1 - (1 - COSINE) / np.maximum(spread, 1e-9), -1, 1)) / math.pi


def within(bits: int, most: int, p: np.ndarray) -> np.ndarray:
    """The chance that at most ``most`` of ``bits`` differ."""
    return up_to(bits, p)[most]


def up_to(bits: int, p: np.ndarray) -> np.ndarray:
    """(bits + 1, len(p)): the chance that at most so many of ``bits`` differ."""
    p = np.clip(p, 1e-12, 1 - 1e-12)
    k = np.arange(bits + 1)
    ways = np.array([math.lgamma(i + 1) for i in k])
    ways = ways[-1] - ways - ways[::-1]
    return np.exp(ways[:, None] + k[:, None] * np.log(p) + (bits - k)[:, None] * np.log1p(-p)).cumsum(axis=0)


def typical(spread: np.ndarray) -> np.ndarray:
    """A hundred quantiles of the spread."""
    return np.quantile(spread, (np.arange(100) + 0.5) / 100)


@dataclass(frozen=True)
class Layout:
    """How a code is cut: ``tables`` parts of ``width`` bits."""

    width: int
    tables: int

    @classmethod
    def of(cls, classes: int, spread: np.ndarray | None = None) -> Layout:
        """A key for every class or two, and tables enough for the recall.

        A bit differs with the chance of the angle around the centre; parts that differ in up to two bits meet.
        """
        width = max(LEAST_WIDTH, classes.bit_length() + 1)
        apart = 1 - within(width, 2, bit_shares(np.ones(1) if spread is None else typical(spread)))
        most = 1
        while (apart**most).mean() > MISSED:
            most *= 2
            if most > 1 << 20:
                raise ValueError("links around this centre are no closer than other vectors")
        return cls(width, next(t for t in range(most // 2 + 1, most + 1) if (apart**t).mean() <= MISSED))

    @property
    def bits(self) -> int:
        return self.width * self.tables

    @property
    def dtype(self) -> str:
        return "<u4" if self.width <= 32 else "<u8"

    def radius(self, spread: np.ndarray) -> int:
        """Bits that may differ: so many that hardly a pair at ``COSINE`` is beyond."""
        beyond = 1 - up_to(self.bits, bit_shares(typical(spread))).mean(axis=1)
        least = math.ceil(RADIUS_SHARE * self.bits)
        return max(least, int(np.argmax(beyond <= BEYOND)))

    def cost(self, classes: int, unlike: float) -> float:
        """Of a class, in comparisons: its postings, and the unlike classes that it meets.

        ``unlike``: the chance that a bit of two unlike vectors differs.
        """
        return self.tables * ((self.width + 1) * POSTING + classes * float(within(self.width, 2, np.array([unlike]))[0]))


def centred_layout(classes: int, unit: np.ndarray) -> tuple[Layout, float, np.ndarray]:
    """The layout of least cost, the share of the mean that it is centred on, and the spread around that."""
    best = None
    mean = unit.mean(axis=0)
    for share in CENTRES:
        spread = _spread(unit, share)
        common = min((1 - share) ** 2 * float(mean @ mean) / max(float(spread.mean()), 1e-9), 1.0)
        try:
            layout = Layout.of(classes, spread)
        except ValueError:
            continue
        cost = layout.cost(classes, math.acos(common) / math.pi)
        if best is None or cost < best[0]:
            best = cost, layout, share, spread
    return best[1:]


@dataclass
class Quantiser:
    """Codes of unit vectors: the signs of a learned projection, in parts."""

    layout: Layout
    mean: np.ndarray
    projection: np.ndarray  # (dimensions, bits)
    radius: int = 0

    @classmethod
    def learn(cls, unit: np.ndarray, layout: Layout, rounds: int = ROUNDS, share: float = 1.0) -> Quantiser:
        """Principal directions, then the rotation that brings projections close to their signs.

        Codes longer than the vectors go on with random directions, in blocks with a rotation each.
        """
        rng = np.random.default_rng(7)
        mean = share * unit.mean(axis=0)
        centred = unit - mean
        dimensions = centred.shape[1]
        _, directions = np.linalg.eigh(centred.T @ centred)
        directions = directions[:, ::-1]
        blocks = []
        for at in range(0, layout.bits, dimensions):
            kept = directions[:, : layout.bits - at]
            rotation = np.linalg.qr(rng.normal(size=(kept.shape[1], kept.shape[1])))[0]
            projected = centred @ kept
            for _ in range(rounds if len(unit) else 0):
                signs = np.where(projected @ rotation >= 0, 1.0, -1.0)
                left, _, right = np.linalg.svd(projected.T @ signs)
                rotation = left @ right
            blocks.append(kept @ rotation)
            directions = np.linalg.qr(rng.normal(size=(dimensions, dimensions)))[0]
        return cls(layout, mean, np.hstack(blocks))

    def codes(self, unit: np.ndarray) -> np.ndarray:
        """(n, tables) parts of the codes."""
        bits = ((unit - self.mean) @ self.projection >= 0).astype(np.uint64)
        bits = bits.reshape(len(unit), self.layout.tables, self.layout.width)
        return (bits << np.arange(self.layout.width, dtype=np.uint64)).sum(axis=2, dtype=np.uint64)


def packed(codes: np.ndarray, layout: Layout) -> list[bytes]:
    """Codes as column values."""
    return [row.tobytes() for row in np.ascontiguousarray(codes, layout.dtype)]


def unpacked(column: pa.Array | list, layout: Layout) -> np.ndarray:
    rows = column if isinstance(column, list) else column.to_pylist()
    return np.frombuffer(b"".join(rows), layout.dtype).reshape(-1, layout.tables).astype(np.uint64)


def neighbours(parts: np.ndarray, width: int) -> np.ndarray:
    """(n, tables, width + 1): each part and those one bit away."""
    flips = np.concatenate([[np.uint64(0)], np.uint64(1) << np.arange(width, dtype=np.uint64)])
    return parts[:, :, None] ^ flips


def bits_between(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def canonical(a: np.ndarray, b: np.ndarray, table: int | np.ndarray, key: int | np.ndarray) -> np.ndarray:
    """Which pairs of codes (rows of parts) that share this key of this table are judged here: in their first table, under their least key.

    Parts that are equal meet under the part and its neighbours, others under the
    keys that are at most one bit from both.
    """
    tables = a.shape[1]
    first = np.full(len(a), tables)
    least = np.zeros(len(a), np.uint64)
    for t in range(tables - 1, -1, -1):
        x, y = a[:, t], b[:, t]
        apart = bits_between(x, y)
        meets = apart <= 2
        low = (x ^ y) & (~(x ^ y) + np.uint64(1))  # the lowest differing bit
        high = (x ^ y) ^ low
        # apart 0: the least of the part and its neighbours clears its highest bit; else keys between the two.
        top = np.uint64(1) << np.floor(np.log2(np.maximum(x, np.uint64(1)).astype(np.float64))).astype(np.uint64)
        same = np.where(x > 0, x ^ top, x)
        two = np.minimum(x ^ low, x ^ high)
        here = np.where(apart == 0, same, np.where(apart == 1, np.minimum(x, y), two))
        first = np.where(meets, t, first)
        least = np.where(meets, here, least)
    return (first == table) & (least == np.asarray(key).astype(np.uint64))


def _values() -> Column:
    return F.transform("embedding", lambda x: x.cast("double"))


def _usable() -> Column:
    """Whether a row can have links: an id, a label and a finite vector other than zero."""
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
    usable &= ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(usable & F.exists("embedding", lambda x: x != 0), F.lit(False))


def _classes(vectors: DataFrame) -> DataFrame:
    """(label, dims, embedding, first_id, copies, node): distinct usable vectors; node is their digest."""
    rows = vectors.filter(_usable()).select("vec_id", "label", _values().alias("embedding"))
    classes = rows.groupBy("label", "embedding").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
    return classes.select("label", F.size("embedding").alias("dims"), "embedding", "first_id", "copies", F.xxhash64("label", "embedding").alias("node"))


def _unit(embeddings: pa.Array | list, dims: int | None = None) -> np.ndarray:
    """Unit vectors as rows; shorter ones are filled with zeros up to ``dims``."""
    rows = [np.asarray(e, np.float64) for e in (embeddings if isinstance(embeddings, list) else embeddings.to_pylist())]
    width = dims or max(map(len, rows))
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        r = r / np.abs(r).max()  # before squares can overflow or vanish
        out[i, : len(r)] = (r / np.linalg.norm(r))[:width]
    return out


def _spread(unit: np.ndarray, share: float = 1.0) -> np.ndarray:
    """Squared distances from this share of the mean; a single vector tells nothing of them."""
    return ((unit - share * unit.mean(axis=0)) ** 2).sum(axis=1) if len(unit) > 1 else np.ones(1)


def learn_quantiser(classes: DataFrame, sample: int = SAMPLE, layout: Layout | None = None) -> Quantiser:
    """A quantiser from at most about ``sample`` vectors, picked by their hash; its layout follows from all of them."""
    total = classes.agg(F.count("*").alias("n"), F.max("dims").alias("d")).first()
    if not total["n"]:
        layout = layout or Layout.of(0)
        return Quantiser(layout, np.zeros(1), np.zeros((1, layout.bits)))
    part = F.pmod(F.xxhash64("node", F.lit(3)), F.lit(1 << 20))
    picked = classes.filter(part < int((1 << 20) * min(1.0, sample / total["n"])) + 1).select("embedding").collect()
    unit = _unit([r["embedding"] for r in picked] or [[1.0] * total["d"]], total["d"])
    cheapest, share, spread = centred_layout(total["n"], unit)
    if layout:
        share, spread = 1.0, _spread(unit)
    quantiser = Quantiser.learn(unit, layout or cheapest, share=share)
    quantiser.radius = quantiser.layout.radius(spread)
    return quantiser


def _coded(classes: DataFrame, quantiser: Quantiser) -> DataFrame:
    def setup() -> Callable:
        def code(nodes, labels, dims, embeddings):
            codes = packed(quantiser.codes(_unit(embeddings, len(quantiser.mean))), quantiser.layout) if nodes else []
            return {"node": nodes, "label": labels, "dims": dims, "code": codes}

        return code

    return map_batches(classes, ["node", "label", "dims", "embedding"], setup, "node bigint, label int, dims int, code binary")


def _posted(coded: DataFrame, layout: Layout) -> DataFrame:
    """(key, place, node, code): each class under its parts and their neighbours; the place is table and part."""

    schema = as_schema("node bigint, label int, dims int, code binary, place bigint")
    each = layout.tables * (layout.width + 1)
    rows = max(1, POSTED_BYTES // (each * layout.tables * np.dtype(layout.dtype).itemsize))
    tables = np.arange(layout.tables, dtype=np.uint64)[None, :, None] << np.uint64(layout.width)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                places = neighbours(unpacked(part.column("code"), layout), layout.width) | tables
                again = part.take(pa.array(np.repeat(np.arange(part.num_rows), each)))
                yield pa.RecordBatch.from_arrays([*again.columns, pa.array(places.reshape(-1).astype(np.int64))], schema=to_arrow_schema(schema))

    posted = coded.select("node", "label", "dims", "code").mapInArrow(post, schema)
    return posted.select(F.xxhash64("label", "dims", "place").alias("key"), "place", "node", "code")


def whole_lists(batches: Iterator[pa.RecordBatch], rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Batches of at least about ``rows`` rows that end where a key ends, from batches sorted by ``key``."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        kept.append(batch)
        if sum(b.num_rows for b in kept) < rows:
            continue
        whole = pa.concat_batches(kept)
        key = whole.column("key").to_numpy()
        end = int(np.flatnonzero(key != key[-1])[-1]) + 1 if key[0] != key[-1] else 0
        if end:
            yield whole.slice(0, end)
        kept = [whole.slice(end)]
    if kept:
        yield pa.concat_batches(kept)


def _near_pairs(posted: DataFrame, layout: Layout, radius: int) -> DataFrame:
    """(a, b): pairs of short lists within the radius, each once."""
    schema = as_schema("a bigint, b bigint")
    dealt = posted.repartition("key").sortWithinPartitions("key")

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lists in whole_lists(batches):
            key, node, code = lists.column("key").to_numpy(), lists.column("node").to_numpy(), unpacked(lists.column("code"), layout)
            table, part = np.divmod(lists.column("place").to_numpy(), 1 << layout.width)
            for step in range(1, len(key)):  # members of a list that are so many rows apart
                i = np.flatnonzero(key[step:] == key[:-step])
                if not len(i):
                    break
                i = i[bits_between(code[i], code[i + step]).sum(axis=1) <= radius]
                i = i[canonical(code[i], code[i + step], table[i], part[i])]
                yield pa.RecordBatch.from_arrays([pa.array(node[i]), pa.array(node[i + step])], schema=to_arrow_schema(schema))

    return dealt.mapInArrow(pairs, schema)


def _reranked(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose cosine reaches the threshold."""
    own = classes.select("node", "embedding")
    both = pairs.join(own.select(F.col("node").alias("a"), F.col("embedding").alias("x")), "a").join(own.select(F.col("node").alias("b"), F.col("embedding").alias("y")), "b")

    def setup() -> Callable:
        def rerank(a, b, x, y):
            width = max(map(len, x), default=0)
            cosines = np.einsum("ij,ij->i", _unit(x, width), _unit(y, width)) if width else []
            kept = [(p, q) for p, q, c in zip(a, b, cosines, strict=True) if c >= COSINE]
            return {"a": [p for p, _ in kept], "b": [q for _, q in kept]}

        return rerank

    return map_batches(both, ["a", "b", "x", "y"], setup, "a bigint, b bigint")


def _crowded_links(posted: DataFrame, classes: DataFrame, layout: Layout, radius: int) -> DataFrame:
    """(a, b, n): for long lists, counts of linked vectors by node (b null) and a spanning forest (n null)."""
    dealt = in_blocks(posted, "key", "node", BLOCK).join(classes.select("node", "embedding", "copies"), "node")
    dealt = dealt.select("key", "_i", "_j", "_own", "place", "node", "code", "copies", "embedding").repartition("key", "_i", "_j").sortWithinPartitions("key", "_i", "_j")
    schema = as_schema("a bigint, b bigint, n bigint")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, ("key", "_i", "_j")):
            own, node, copies = (run.column(c).to_numpy() for c in ("_own", "node", "copies"))
            code = unpacked(run.column("code"), layout)
            table, part = divmod(run.column("place")[0].as_py(), 1 << layout.width)
            unit = _unit(run.column("embedding"))
            linked = np.triu(unit @ unit.T >= COSINE, 1)
            linked &= (own[:, None] != own[None, :]) | (run.column("_i")[0] == run.column("_j")[0])
            i, j = np.nonzero(linked)
            here = canonical(code[i], code[j], table, part) & (bits_between(code[i], code[j]).sum(axis=1) <= radius)
            i, j = i[here], j[here]
            if not len(i):
                continue
            times = np.bincount(i, copies[j], len(node)) + np.bincount(j, copies[i], len(node))
            counted = np.flatnonzero(times)
            a, b, n = list(node[counted]), [None] * len(counted), list(times[counted].astype(int))
            root = np.arange(len(node))
            for p, q in zip(i.tolist(), j.tolist(), strict=True):
                while root[p] != p:
                    p = root[p]
                while root[q] != q:
                    q = root[q]
                if p != q:
                    root[max(p, q)] = min(p, q)
                    a.append(node[p])
                    b.append(node[q])
                    n.append(None)
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in (a, b, n)], schema=to_arrow_schema(schema))

    return dealt.mapInArrow(link, schema)


def near_vectors(vectors: DataFrame, layout: Layout | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding, label).

    ``layout``: how codes are cut; by default as the number of classes needs.
    """
    prepare(vectors.sparkSession)
    classes = stage(_classes(vectors), "vector-classes")
    quantiser = learn_quantiser(classes, layout=layout)
    layout = quantiser.layout
    coded = stage(_coded(classes, quantiser), "vector-codes")
    posted = stage(_posted(coded, layout), "vector-postings")
    counts = stage(posted.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "vector-lists")
    short = posted.join(counts.filter(F.col("n") <= BLOCK).select("key"), "key")
    long = posted.join(counts.filter(F.col("n") > BLOCK).select("key"), "key")
    pairs = stage(_reranked(_near_pairs(short, layout, quantiser.radius), classes), "vector-pairs")
    crowded = stage(_crowded_links(long, classes, layout, quantiser.radius), "vector-crowded")
    weight = classes.select(F.col("node").alias("b"), "copies")
    sides = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).join(weight, "b")
    links = sides.select("a", F.col("copies").alias("n")).unionByName(crowded.filter("n is not null").select("a", "n")).groupBy("a").agg(F.sum("n").alias("links"))
    linked = components(pairs.unionByName(crowded.filter("n is null").select("a", "b")), "vector-components")
    linked = linked.join(classes.select(F.col("node").alias("id"), "first_id"), "id")
    least = linked.groupBy("component").agg(F.min("first_id").alias("component_id"))
    of_class = (
        classes.join(links.withColumnRenamed("a", "node"), "node", "left")
        .join(linked.join(least, "component").select(F.col("id").alias("node"), "component_id"), "node", "left")
        .select("node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "first_id").alias("c"))
    )
    # Rows find their class by the same digest of label and values; an unusable row finds none.
    rows = vectors.select("vec_id", F.when(_usable(), F.xxhash64("label", _values())).alias("node"))
    out = rows.join(of_class, "node", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("c", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


#: Every pair of a label compared, and what each vector reaches.
ORACLE = f"""
with recursive v as (
  select row_number() over () as r, vec_id, label, cast(embedding as double[]) as e from embeddings
),
usable as (
  select * from v where vec_id is not null and label is not null and len([x for x in e if x <> 0]) > 0
    and len([x for x in e if x is null or isnan(x) or isinf(x)]) = 0
),
links as (
  select a.r as a, b.r as b from usable a join usable b on a.label = b.label and len(a.e) = len(b.e) and a.r <> b.r
  where list_cosine_similarity(a.e, b.e) >= {COSINE}
),
reach as (
  select r, vec_id as id from usable
  union
  select links.b, reach.id from reach join links on links.a = reach.r
),
component as (select r, min(id) as id from reach group by r),
degree as (select a as r, count(*) as n from links group by a)
select vec_id, coalesce(degree.n, 0) as n_links, coalesce(component.id, vec_id) as component_id,
  vec_id is not distinct from coalesce(component.id, vec_id) as kept
from v left join component using (r) left join degree using (r)
"""
