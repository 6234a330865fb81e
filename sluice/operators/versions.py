"""Records of several schema versions in one batch, and the history of those versions.

The header of a record names the schema it was written with. Schemas have to be constants of a plan, so the known
ids and their schemas are part of it: each record is decoded by the one branch of its id and made a value of the
reader's schema, all in narrow expressions of one plan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.avro.functions import from_avro
from pyspark.sql.window import Window

from sluice.functions.avro_types import SchemaError, parse_avro, record_type, spark_type
from sluice.functions.compatibility import as_reader, schema_relation, unreadable
from sluice.functions.text import subject_of, trim_blanks
from sluice.operators import records as rec

#: Versions of a subject that are put in order together.
BLOCK = 4096


def schema_id(value: Column) -> Column:
    """The id in a record's header: four bytes, high ones first, after a zero byte; null without such a header."""
    whole = (F.length(value) >= 5) & (F.substring(value, 1, 1) == F.lit(b"\x00"))
    return F.when(whole, F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("long"))


def readable_writers(writers: Mapping[int, str], reader: str) -> dict[str, list[int]]:
    """Schema text -> its ids, without the schemas that are unusable or that ``reader`` cannot read."""
    target, found = parse_avro(reader), {}
    for number, text in sorted(writers.items()):
        try:
            tree = parse_avro(text)
        except SchemaError:
            continue
        if tree["kind"] == "record" and not unreadable(target, tree):
            found.setdefault(text, []).append(number)
    return found


def decode_versions(
    records: DataFrame, writers: Mapping[int, str], reader: str, codec: str = "avro", mode: str = "FAILFAST",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Decode each ``value`` with the schema of its header's id, into ``output`` of the schema ``reader``.

    An id that ``writers`` lacks, or whose schema ``reader`` cannot read, makes a record as undecodable as a broken body: an
    all-null record in PERMISSIVE, a failed task in FAILFAST. A null value gives a null record in both.
    """
    if mode not in rec.MODES:
        raise ValueError(f"mode {mode!r} is none of {rec.MODES}")
    if codec == "avro":
        rec.require_codec(records.sparkSession, codec)
    elif codec != "json":
        raise ValueError(f"codec {codec!r} is neither 'avro' nor 'json'")
    record_type(reader)
    target, number = parse_avro(reader), F.col("schema_id")
    known = readable_writers(writers, reader)
    body = F.substring(F.col("value"), 6, 2**31 - 1)
    framed = records.select(*keep, F.col("value").isNotNull().alias("filled"), schema_id(F.col("value")).alias("schema_id"), body.alias("body"))
    parsed = [
        _parsed(F.when(number.isin(ids), F.col("body")), text, codec, mode).alias(f"parsed_{n}")
        for n, (text, ids) in enumerate(known.items())
    ]
    decoded = framed.select(*keep, "filled", "schema_id", *parsed)
    output = F.lit(None).cast(spark_type(target))
    if mode == "FAILFAST":
        message = F.concat(F.lit("no usable schema of id "), F.coalesce(number.cast("string"), F.lit("(no header)")))
        output = F.when(F.col("filled"), F.raise_error(message).cast(spark_type(target)))
    for n, (text, ids) in enumerate(known.items()):
        tree, value = parse_avro(text), F.col(f"parsed_{n}")
        fits = number.isin(ids)
        if codec == "json" and mode == "PERMISSIVE":  # a body with one bad field is bad as a whole
            whole = value.isNotNull() & value.getField(rec.CORRUPT).isNull()
            value = F.when(whole, F.struct(*[value.getField(f).alias(f) for f, _ in tree["fields"]]))
        output = F.when(fits, as_reader(value, tree, target)).otherwise(output)
    return decoded.select(*keep, output.alias("output"))


def _parsed(body: Column, schema: str, codec: str, mode: str) -> Column:
    if codec == "avro":
        return from_avro(body, schema, {"mode": mode})
    kind, options = record_type(schema), {"mode": mode}
    if mode == "PERMISSIVE":
        kind, options = rec.with_corrupt(kind), {"mode": mode, "columnNameOfCorruptRecord": rec.CORRUPT}
    return F.from_json(body.cast("string"), kind, options)


def decoded(
    records: DataFrame, schema: str, codec: str = "avro", mode: str = "FAILFAST", writers: Mapping[int, str] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``keep`` and the struct ``output``: by the header's id if ``writers`` are known, else all by ``schema``."""
    if writers is None:
        return rec.decode_body(rec.strip_header(records, keep=keep), schema, codec, mode, keep)
    return decode_versions(records, writers, schema, codec, mode, keep)


def to_rows(
    records: DataFrame, schema: str, codec: str = "avro", mode: str = "FAILFAST", writers: Mapping[int, str] | None = None
) -> DataFrame:
    """The whole pipeline from wire records to rows ready for the sink."""
    return rec.cast_date_parts(rec.flatten(decoded(records, schema, codec, mode, writers)))


def with_writers(events: DataFrame, schemas: DataFrame) -> DataFrame:
    """Adds ``writers``: the schemas, by id, that the subjects of an event's topics have ever had.

    ``schemas`` needs ``schema_id``. Equal texts of a subject under one id count once, so a list is as long as a plan has
    branches. An event without any has an empty list.
    """
    topics = events.select("event_key", F.explode(F.split("topics", ",")).alias("topic"))
    wanted = topics.select("event_key", subject_of(trim_blanks(F.col("topic"))).alias("subject")).distinct()
    written = schemas.where("schema_id IS NOT NULL AND schema IS NOT NULL").select("subject", "schema_id", "schema").distinct()
    lists = wanted.join(written, "subject").groupBy("event_key").agg(
        F.array_sort(F.collect_set(F.struct("schema_id", "schema"))).alias("writers"))
    empty = F.array().cast("array<struct<schema_id:int,schema:string>>")
    return events.join(lists, "event_key", "left").withColumn("writers", F.coalesce("writers", empty))


# --- history -----------------------------------------------------------------------


def with_previous(schemas: DataFrame, block: int = BLOCK) -> DataFrame:
    """subject, version, schema and the version before it (``previous``, ``previous_schema``).

    Rows of one subject and version count once, with the largest text; rows without subject or version are left out. A
    subject's versions are ordered block by block, and only the last of each block meets the other blocks', so
    no task holds a whole subject.
    """
    rows = schemas.where("subject IS NOT NULL AND version IS NOT NULL").groupBy("subject", "version").agg(
        F.max("schema").alias("schema")).withColumn("block", F.floor(F.col("version") / block))
    row = F.struct("version", "schema")
    lasts = rows.groupBy("subject", "block").agg(F.max_by(row, "version").alias("last"))
    lasts = lasts.withColumn("before", F.lag("last").over(Window.partitionBy("subject").orderBy("block")))
    inside = rows.withColumn("within", F.lag(row).over(Window.partitionBy("subject", "block").orderBy("version")))
    found = inside.join(lasts.select("subject", "block", "before"), ["subject", "block"])
    previous = F.coalesce("within", "before")
    return found.select(
        "subject", "version", "schema", previous["version"].alias("previous"), previous["schema"].alias("previous_schema"))


def compatibility(schemas: DataFrame) -> DataFrame:
    """subject, version, previous and ``code``: how each version and the one before it read each other.

    FULL, BACKWARD (the newer reads the older one's records), FORWARD (the older reads the newer one's), NONE; NEW for a subject's
    first version, INVALID for an unusable schema, UNKNOWN after one.
    """
    rows = with_previous(schemas)
    first = F.col("previous").isNull()
    code = schema_relation(F.col("schema"), F.when(first, F.col("schema")).otherwise(F.col("previous_schema")))
    compared = rows.select("subject", "version", "previous", code.alias("code"))
    return compared.withColumn("code", F.when(first & (F.col("code") != "INVALID"), "NEW").otherwise(F.col("code")))
