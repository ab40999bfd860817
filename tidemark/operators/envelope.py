"""From wire bytes to decoded change records."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WIRE_HEADER_BYTES = 5  # one magic byte, four bytes of schema id
CORRUPT = "_corrupt"


def strip_wire_header(df: DataFrame, value: str = "value", payload: str = "payload") -> DataFrame:
    """Replace the framed bytes by ``schema_id`` and the bare ``payload``."""
    framed = F.col(value)
    schema_id = F.conv(F.hex(F.substring(framed, 2, 4)), 16, 10).cast("bigint")
    body = F.substring(framed, F.lit(WIRE_HEADER_BYTES + 1), F.length(framed) - WIRE_HEADER_BYTES)
    return df.withColumns({"schema_id": schema_id, payload: body}).drop(value)


def decode_payload(payload: Column, schema: T.StructType | str, fmt: str = "json") -> Column:
    """The payload as a struct; a corrupt one gives nulls instead of failing.

    A JSON text that ends too early is corrupt wherever it ends, and none of
    its fields count; in a whole one, only a field of another type is null.

    ``json`` takes a StructType.  ``avro`` takes the schema document and needs
    Spark's Avro module on the classpath.
    """
    if fmt == "json":
        text, options = payload.cast("string"), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
        flag = T.StructField(CORRUPT, T.StringType())
        untyped = T.StructType([*[T.StructField(n, T.StringType()) for n in schema.names], flag])

        def checked(row: Column) -> Column:
            # Whatever the types, a whole text can be read: looked at only where reading by the types met a fault.
            torn = row[CORRUPT].isNotNull() & F.from_json(text, untyped, options)[CORRUPT].isNotNull()
            return F.when(~torn, row.dropFields(CORRUPT))

        return F.transform(F.array(F.from_json(text, T.StructType([*schema.fields, flag]), options)), checked)[0]
    if fmt == "avro":
        from pyspark.sql.avro.functions import from_avro

        return from_avro(payload, schema, {"mode": "PERMISSIVE"})
    raise ValueError(f"unknown payload format {fmt!r}")


def decode_envelope(
    df: DataFrame,
    schema: T.StructType | str,
    payload: str = "payload",
    fmt: str = "json",
    keep: tuple[str, ...] = ("ingest_date",),
) -> DataFrame:
    """``data``, ``beforeData`` and ``headers`` out of the payload, plus ``keep``.

    Row images that decoded to nothing at all become a null struct, so a
    corrupt payload yields nulls whichever format it came in.
    """
    decoded = df.select(decode_payload(F.col(payload), schema, fmt).alias("_r"), *keep)

    def image(name: str) -> Column:
        names = decoded.schema["_r"].dataType[name].dataType.names
        filled = [F.col(f"_r.{name}.`{n}`").isNotNull() for n in names]
        return F.when(reduce(or_, filled), F.col(f"_r.{name}")).alias(name)

    return decoded.select(image("data"), image("beforeData"), image("headers"), *keep)


def json_value(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Parse a JSON text column and lay its fields out; key and value are dropped."""
    parsed = df.withColumn("_parsed", decode_payload(F.col(value), schema))
    return parsed.select("_parsed.*", *[c for c in df.columns if c not in ("key", value)])


def flatten(df: DataFrame, headers: dict[str, str] | None = None) -> DataFrame:
    """``data.*`` plus chosen header fields as {header field: output column}."""
    headers = headers or {}
    return df.select("data.*", *[F.col(f"headers.{k}").alias(v) for k, v in headers.items()])


def decode_by_writer(
    frames: DataFrame,
    writers: Mapping[int, T.StructType],
    reader: T.StructType,
    value: str = "value",
    keep: Sequence[str] = ("ingest_date",),
) -> DataFrame:
    """Frames decoded by the schema each one names, laid out as ``reader``; nothing is lost on the way.

    A frame is a magic zero byte, four bytes of schema id and a JSON payload. The payload becomes a
    variant, once; a writer's columns are then taken out of it by path and cast as
    that writer declared them before they take the reader's type. Beside
    ``data`` come:

    * ``rescued``: a JSON object of what has no place in the reader's row: fields
      that it lacks, and values that would not cast; null if there are none;
    * ``error``: why a frame could not be decoded (``frame``, ``schema`` or ``payload``), else null;
    * ``raw``: the bytes of such a frame, for a quarantine folder.

    A null frame, or one shorter than its header or with another magic byte, is a
    ``frame`` error, an id that ``writers`` lacks a ``schema`` error, and bytes
    that are no JSON object a ``payload`` error.
    """
    raw = F.col(value)
    framed = F.coalesce((F.length(raw) >= WIRE_HEADER_BYTES) & (F.hex(F.substring(raw, 1, 1)) == "00"), F.lit(False))
    schema_id = F.when(framed, F.conv(F.hex(F.substring(raw, 2, 4)), 16, 10).cast("bigint"))
    body = F.when(framed, F.substring(raw, F.lit(WIRE_HEADER_BYTES + 1), F.length(raw)).cast("string"))
    parsed = F.try_parse_json(F.try_validate_utf8(body))
    known = F.coalesce(F.col("schema_id").isin(*writers), F.lit(False))
    record = F.try_variant_get("_v", "$", "map<string,variant>")
    named = frames.select(raw.alias("raw"), schema_id.alias("schema_id"), parsed.alias("_v"), framed.alias("_framed"), *keep)
    error = F.when(~F.col("_framed"), "frame").when(~known, "schema").when(record.isNull(), "payload")
    checked = named.withColumn("error", error)

    def by_writer(of: Callable[[T.StructType], Column]) -> Column:
        chosen = F.lit(None)
        for number, writer in writers.items():
            chosen = F.when(F.col("error").isNull() & (F.col("schema_id") == number), of(writer)).otherwise(chosen)
        return chosen

    data = by_writer(lambda w: _laid_out("$", w, reader)).alias("data")
    rescued = by_writer(lambda w: F.concat(*_homeless("$", w, reader))).alias("_rescued")
    out = checked.select("schema_id", data, rescued, "error", F.when(F.col("error").isNotNull(), F.col("raw")).alias("raw"), *keep)
    text = F.when(F.size("_rescued") > 0, F.to_json(F.map_from_entries("_rescued"))).alias("rescued")
    return out.select("schema_id", "data", text, "error", "raw", *keep)


def _value(path: str, writer: T.DataType, reader: T.DataType) -> Column:
    """A field as its writer declared it, in the reader's type; null if either cast fails."""
    return F.try_variant_get("_v", path, writer.simpleString()).try_cast(reader)


def _laid_out(path: str, writer: T.StructType, reader: T.StructType) -> Column:
    """The reader's row out of the variant; a part that the payload lacks is null, and so is a field its writer did not have."""
    declared = {f.name: f.dataType for f in writer.fields}
    fields = []
    for f in reader.fields:
        at, own = f"{path}.{f.name}", declared.get(f.name)
        if own is None:
            fields.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif isinstance(f.dataType, T.StructType):
            present = F.try_variant_get("_v", at, "map<string,variant>").isNotNull()
            fields.append(F.when(present, _laid_out(at, own, f.dataType)).alias(f.name))
        else:
            fields.append(_value(at, own, f.dataType).alias(f.name))
    return F.struct(*fields)


def _homeless(path: str, writer: T.StructType, reader: T.StructType) -> list[Column]:
    """Arrays of (path, JSON text) of what the payload holds there and the reader's row does not."""
    declared = {f.name: f.dataType for f in writer.fields}
    nested = {f.name for f in reader.fields if isinstance(f.dataType, T.StructType) and f.name in declared}
    entries = F.map_entries(F.try_variant_get("_v", path, "map<string,variant>"))
    placed = [F.when(_value(f"{path}.{f.name}", declared[f.name], f.dataType).isNotNull(), F.lit(f.name)) for f in reader.fields if f.name in declared and f.name not in nested]
    placed += [F.when(F.try_variant_get("_v", f"{path}.{n}", "map<string,variant>").isNotNull(), F.lit(n)) for n in nested]
    homes = F.array(*placed).cast("array<string>")
    lost = F.filter(entries, lambda e: ~F.coalesce(F.array_contains(F.array_compact(homes), e["key"]), F.lit(False)) & ~F.is_variant_null(e["value"]))
    prefix = path.removeprefix("$").removeprefix(".")
    own = F.transform(lost, lambda e: F.struct(F.concat(F.lit(f"{prefix}." if prefix else ""), e["key"]).alias("key"), F.to_json(e["value"]).alias("value")))
    none = F.array().cast("array<struct<key:string,value:string>>")
    parts = [F.coalesce(own, none)]
    for f in reader.fields:
        if f.name in nested:
            parts += _homeless(f"{path}.{f.name}", declared[f.name], f.dataType)
    return parts
