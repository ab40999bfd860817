r"""Chat formatting on a prefix tree: shared turns once, depth first, with positions and ancestor intervals.

A turn becomes ``### role: text </turn>`` and a newline. Inside roles and texts a
backslash is doubled, ``###`` becomes ``\h`` and ``</turn>`` becomes ``\t`` (and ``:`` in
a role ``\c``), so no text can close its turn or open another, and the way back
is exact.

A node of the tree is a turn after all turns before it; its key is a chained
digest. Conversations that share their first turns share these nodes. A unit is a
run, depth first, of at most ``PATHS`` different conversations of one tree, with the turns
that lead to them; it is one training sequence. The nodes of a unit are emitted depth first,
each once, with

* ``tokens`` and their ``position_ids``, which go on from the parent's;
* ``ancestors``: the intervals of the sequence that its tokens may attend to,
  besides those before them in the node;
* ``loss``: the interval of its own tokens that is an assistant's text.

A tree with more conversations than that (a first turn that a third of them share) is
several units: a turn above n of its conversations is repeated in about n / ``PATHS`` of
them, with its loss interval. ``format_tree`` alone (``runs_of_paths=False``) cuts below each crowded
turn instead, one unit for each turn after it.
Conversations that are equal throughout are one path, whose ``leaf`` they share.

Rows of a conversation go by turn; equal turns by role and text, nulls first. A null
role or text is empty; rows with a null conv_id are one conversation, with that id.
Repeated rows are turns of their own. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import cache
from itertools import count

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.common import as_schema, map_batches, prepare, runs, stage

PATHS = 512
UNITS = 64  #: units of crowded trees dealt in one task; each task may cut one short
LOSS_ROLE = "assistant"
# Fixed value: the pattern that the rank file's vocabulary splits text by.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_ESCAPES = {"\\": "\\\\", "###": "\\h", "</turn>": "\\t", ":": "\\c"}
_BACK = {"\\": "\\", "h": "###", "t": "</turn>", "c": ":"}
_IN_TEXT = re.compile(r"\\|###|</turn>")
_IN_ROLE = re.compile(r"\\|###|</turn>|:")
_TURN = re.compile(r"### ([^:]*): (.*?) </turn>\n", re.DOTALL)


def escape(text: str, pattern: re.Pattern = _IN_TEXT) -> str:
    return pattern.sub(lambda m: _ESCAPES[m.group()], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _BACK[m.group(1)], text, flags=re.DOTALL)


def turn_parts(role: str, text: str) -> tuple[str, str, str]:
    """A turn's opening, escaped text and end."""
    return f"### {escape(role, _IN_ROLE)}: ", escape(text), " </turn>\n"


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation; fails on anything else."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError("not a formatted conversation")
        turns.append((unescape(m.group(1)), unescape(m.group(2))))
        at = m.end()
    return turns


@cache
def vocabulary(path: str) -> tiktoken.Encoding:
    """The byte-level vocabulary of a rank file."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines)}
    return tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def _paths_setup() -> Callable:
    def paths(ids, conversations):
        out: dict[str, list] = {"conv_id": ids, "leaf": [], "keys": [], "turns": []}
        for turns in conversations:
            turns = [{"role": t["role"] or "", "text": t["text"] or ""} for t in turns]
            key, keys = b"", []
            for t in turns:
                role, text = t["role"].encode(), t["text"].encode()
                key = hashlib.blake2b(key + len(role).to_bytes(8, "big") + role + text, digest_size=16).digest()
                keys.append(key.hex())
            out["leaf"].append(keys[-1])
            out["keys"].append(keys)
            out["turns"].append(turns)
        return out

    return paths


def conversation_paths(rows: DataFrame) -> DataFrame:
    """(conv_id, leaf, keys, turns) of each conversation of rows (conv_id, turn, role, text)."""
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")
    ddl = "conv_id bigint, leaf string, keys array<string>, turns array<struct<role:string, text:string>>"
    return map_batches(rows.groupBy("conv_id").agg(turns), ["conv_id", "turns"], _paths_setup, ddl)


def _units(paths: DataFrame) -> DataFrame:
    """Distinct paths with their unit: the key of the first turn from which on few enough paths go on."""
    distinct = stage(paths.groupBy("leaf").agg(F.any_value("keys").alias("keys"), F.any_value("turns").alias("turns")), "chat-distinct")
    steps = distinct.select("leaf", F.posexplode("keys").alias("depth", "key"))
    crowded = stage(steps.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > PATHS).select("key"), "chat-crowded")
    cut = steps.join(crowded, "key", "left_semi").groupBy("leaf").agg((F.max("depth") + 1).alias("cut"))
    placed = distinct.join(cut, "leaf", "left").withColumn("cut", F.coalesce("cut", F.lit(0)))
    # A path that ends inside the trunk is a unit of its own.
    return placed.withColumn("unit", F.xxhash64(F.element_at("keys", F.least(F.col("cut") + 1, F.size("keys")))))


def _runs_of_paths(paths: DataFrame) -> DataFrame:
    """Distinct paths with their unit: the tree, or in crowded trees a run of ``PATHS`` paths in depth-first order."""
    distinct = stage(paths.groupBy("leaf").agg(F.any_value("keys").alias("keys"), F.any_value("turns").alias("turns")), "chat-distinct")
    first = F.element_at("keys", 1)
    crowded = stage(distinct.groupBy(first.alias("root")).agg(F.count("*").alias("n")).filter(F.col("n") > PATHS), "chat-crowded")
    tasks = max(1, -(-(crowded.agg(F.sum("n")).first()[0] or 0) // (UNITS * PATHS)))
    rows = distinct.select("leaf", first.alias("root"), F.array_join("keys", "").alias("path")).join(crowded.select("root"), "root", "left_semi")
    ordered = stage(rows, "chat-crowded-paths").repartitionByRange(tasks, "path").sortWithinPartitions("path")
    schema, most = as_schema("leaf string, unit bigint"), PATHS

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, unit, held = None, 0, 0
        for batch in batches:
            leaves, units = batch.column("leaf").to_pylist(), []
            for leaf, root in zip(leaves, batch.column("root").to_pylist(), strict=True):
                if root != tree or held == most:
                    tree, unit, held = root, int.from_bytes(bytes.fromhex(leaf[:16]), "big", signed=True), 0
                held += 1
                units.append(unit)
            yield pa.RecordBatch.from_arrays([pa.array(leaves, pa.string()), pa.array(units, pa.int64())], schema=to_arrow_schema(schema))

    dealt = stage(ordered.select("leaf", "root").mapInArrow(deal, schema), "chat-units")
    return distinct.join(dealt, "leaf", "left").withColumn("unit", F.coalesce("unit", F.xxhash64(first)))


def _below(row: dict) -> list[dict]:
    """What the nodes below a node may attend to: its ancestors and itself, touching intervals as one."""
    own, above = {"start": row["start"], "stop": row["start"] + len(row["tokens"])}, row["ancestors"]
    if above and above[-1]["stop"] == own["start"]:
        return [*above[:-1], {"start": above[-1]["start"], "stop": own["stop"]}]
    return [*above, own]


def format_tree(paths: DataFrame, vocabulary_path: str, runs_of_paths: bool = False) -> DataFrame:
    """Nodes of all units, depth first.

    (unit, node, parent, start, tokens, position_ids, ancestors, loss_start,
    loss_end, leaf): ``start`` is the node's place in the unit's sequence,
    ``ancestors`` its ancestors' intervals there, those that touch as one, ``leaf`` set where a
    conversation ends.
    """
    ddl = (
        "unit bigint, node int, parent int, start bigint, tokens array<int>, position_ids array<int>, "
        "ancestors array<struct<start:bigint, stop:bigint>>, loss_start int, loss_end int, leaf string"
    )
    schema = as_schema(ddl)
    units = _runs_of_paths(paths) if runs_of_paths else _units(paths)
    dealt = units.select("unit", F.array_join("keys", "").alias("path"), "keys", "turns").repartition("unit").sortWithinPartitions("unit", "path")

    def told(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(rows), 256):
            yield pa.RecordBatch.from_pylist(rows[at : at + 256], schema=to_arrow_schema(schema))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = vocabulary(vocabulary_path).encode_ordinary
        for run in runs(batches, ("unit",)):
            unit, rows, open_nodes, place, numbers = run.column("unit")[0].as_py(), [], [], 0, count()
            for keys, turns in zip(run.column("keys").to_pylist(), run.column("turns").to_pylist(), strict=True):
                shared = 0
                while shared < min(len(open_nodes), len(keys)) and open_nodes[shared]["key"] == keys[shared]:
                    shared += 1
                del open_nodes[shared:]
                for key, turn in zip(keys[shared:], turns[shared:], strict=True):
                    opening, text, end = map(encode, turn_parts(turn["role"], turn["text"]))
                    tokens = opening + text + end
                    above = open_nodes[-1] if open_nodes else None
                    position = above["position"] + len(above["row"]["tokens"]) if above else 0
                    lost = turn["role"] == LOSS_ROLE
                    row = {
                        "unit": unit, "node": next(numbers), "parent": above["row"]["node"] if above else -1, "start": place, "tokens": tokens,
                        "position_ids": list(range(position, position + len(tokens))),
                        "ancestors": _below(above["row"]) if above else [],
                        "loss_start": len(opening) if lost else 0, "loss_end": len(opening) + len(text) if lost else 0, "leaf": None,
                    }
                    rows.append(row)
                    open_nodes.append({"key": key, "position": position, "row": row})
                    place += len(tokens)
                open_nodes[-1]["row"]["leaf"] = keys[-1]  # a path comes before those that go on from it, so its rows are complete
                if len(rows) >= 256:
                    yield from told(rows)
                    rows = []
            yield from told(rows)

    return dealt.mapInArrow(emit, schema)


def _within(start: int, stop: int, intervals: list[dict]) -> bool:
    """Whether one of the ascending intervals holds this one."""
    at = bisect_right(intervals, start, key=lambda x: x["start"]) - 1
    return at >= 0 and stop <= intervals[at]["stop"]


def read_back(nodes: DataFrame, vocabulary_path: str) -> DataFrame:
    """Digests of each conversation, from the tokens, intervals and masks of ``format_tree`` alone.

    (leaf, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)
    """
    ddl = "leaf string, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    schema = as_schema(ddl)
    dealt = nodes.select("unit", "node", "parent", "start", "tokens", "ancestors", "loss_start", "loss_end", "leaf").repartition("unit").sortWithinPartitions("unit", "node")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = vocabulary(vocabulary_path).decode_bytes
        for run in runs(batches, ("unit",)):
            open_nodes: list[tuple[int, int, int, str, str]] = []
            out = []
            for row in run.select(["node", "parent", "start", "tokens", "ancestors", "loss_start", "loss_end", "leaf"]).to_pylist():
                while open_nodes and open_nodes[-1][0] != row["parent"]:
                    open_nodes.pop()  # depth first: no later node stands below it
                tokens, a, b = row["tokens"], row["loss_start"], row["loss_end"]
                open_nodes.append((row["node"], row["start"], row["start"] + len(tokens), decode(tokens).decode(), unescape(decode(tokens[a:b]).decode())))
                if row["leaf"] is None:
                    continue
                seen = [o for o in open_nodes[:-1] if _within(o[1], o[2], row["ancestors"])] + [open_nodes[-1]]
                formatted, loss = "".join(o[3] for o in seen), "".join(o[4] for o in seen)
                turns = parse_turns(formatted)
                out.append(
                    {
                        "leaf": row["leaf"], "n_turns": len(turns), "turns_sha256": hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                        "loss_chars": len(loss), "loss_sha256": hashlib.sha256(loss.encode()).hexdigest(), "formatted_chars": len(formatted),
                    }
                )
            yield pa.RecordBatch.from_pylist(out, schema=to_arrow_schema(schema))

    return dealt.mapInArrow(read, schema)


def format_conversations(rows: DataFrame, vocabulary_path: str) -> DataFrame:
    """Digest of each conversation of rows (conv_id, turn, role, text), read back from the formatted tree."""
    prepare(rows.sparkSession)
    paths = stage(conversation_paths(rows), "chat-paths")
    nodes = format_tree(paths, vocabulary_path, runs_of_paths=True)
    digests = stage(read_back(nodes, vocabulary_path), "chat-digests")
    return paths.select("conv_id", "leaf").join(digests, "leaf").select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
