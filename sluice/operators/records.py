"""Wire records to typed rows. Every step is narrow and runs in batch and in streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.avro.functions import from_avro

from sluice.functions.avro_types import DATE_PARTS, record_type

# Decode error policies, as in from_avro.
MODES = ("PERMISSIVE", "FAILFAST")
# What a lenient cast to int reads: a number between blanks, whose fraction is cut off.
_NUMBER = (
    r"\A[\x00-\x20\x7F]*(?<sign>[+-]?)(?=[\d.])(?<whole>\d*)(?:\.\d*)?[\x00-\x20\x7F]*\z"
)
#: Where a JSON body that is bad is told from a good one.
CORRUPT = "_corrupt_record"
_NESTED = (T.ArrayType, T.MapType, T.StructType)


def strip_header(records: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Keep the body: everything after the 5 bytes of magic and schema id; and the columns ``keep``."""
    return records.select(*keep, F.substring(F.col(value), 6, 2**31 - 1).alias("body"))


def decode_body(
    bodies: DataFrame, schema: str, codec: str = "avro", mode: str = "FAILFAST", keep: Sequence[str] = ()
) -> DataFrame:
    """Decode ``body`` with an Avro schema into the struct column ``output``, beside the columns ``keep``.

    PERMISSIVE turns an undecodable body into an all-null record, FAILFAST
    fails the task. The codec ``avro`` uses Spark's ``from_avro`` and needs its
    module; ``json`` bodies use ``from_json`` with the same schema.
    """
    if mode not in MODES:
        raise ValueError(f"mode {mode!r} is none of {MODES}")
    if codec == "json":
        return _decode_json(bodies, record_type(schema), mode, keep)
    if codec != "avro":
        raise ValueError(f"codec {codec!r} is neither 'avro' nor 'json'")
    require_codec(bodies.sparkSession, codec)
    return bodies.select(*keep, from_avro(F.col("body"), schema, {"mode": mode}).alias("output"))


def with_corrupt(kind: T.StructType) -> T.StructType:
    return T.StructType([*kind.fields, T.StructField(CORRUPT, T.StringType())])


def _decode_json(bodies: DataFrame, decoded: T.StructType, mode: str, keep: Sequence[str] = ()) -> DataFrame:
    text = F.col("body").cast("string")
    if mode == "FAILFAST":
        return bodies.select(*keep, F.from_json(text, decoded, {"mode": mode}).alias("output"))
    # A body with one bad field is bad as a whole, like an Avro body.
    options = {"mode": mode, "columnNameOfCorruptRecord": CORRUPT}
    parsed = bodies.select(*keep, F.from_json(text, with_corrupt(decoded), options).alias("parsed"))
    fields = [F.col("parsed").getField(name).alias(name) for name in decoded.fieldNames()]
    whole = F.col("parsed").getField(CORRUPT).isNull()
    return parsed.select(*keep, F.when(whole, F.struct(*fields)).alias("output"))


def has_native_avro(spark: SparkSession) -> bool:
    try:
        probe = from_avro(F.lit(None).cast("binary"), '"string"')
        spark.range(0).select(probe).schema  # noqa: B018 - analysis only
    except (AnalysisException, TypeError):
        return False
    return True


def require_codec(spark: SparkSession, codec: str) -> None:
    """Refuse the codec ``avro`` in a session without Spark's module for it."""
    if codec == "avro" and not has_native_avro(spark):
        raise RuntimeError(
            "codec 'avro' needs Spark's module spark-avro on the class path "
            "(--packages org.apache.spark:spark-avro_2.13:<version of Spark>)"
        )


def flatten(decoded: DataFrame) -> DataFrame:
    return decoded.select("output.*")


def date_part(value: Column, kind: T.DataType) -> Column:
    """A date part as an int; text that is no number becomes null, a fraction is cut off.

    Types that have no cast to a number (a date, bytes) give null, as the lenient cast does.

    A failing ``try_cast`` costs an exception per row, about fifty times the
    rest of the row's work, so only text that looks like a number is cast.
    """
    if isinstance(kind, (T.DateType, T.BinaryType)):
        return F.lit(None).cast("int")
    if not isinstance(kind, T.StringType):
        return value.try_cast("int")
    whole = F.regexp_replace(value, _NUMBER, "${sign}0${whole}")
    unusual = F.when(value.rlike(_NUMBER), whole.try_cast("int"))
    return F.when(value.rlike(r"\A\d{1,9}\z"), value.try_cast("int")).otherwise(unusual)


def cast_date_parts(rows: DataFrame) -> DataFrame:
    """Cast the date-part columns that exist to int, all others stay as they are.

    Names match without regard to case and keep theirs; nested columns of such a name stay.
    """
    wanted = {name.lower() for name in DATE_PARTS}
    parts = {
        field.name: date_part(F.col(field.name), field.dataType) for field in rows.schema
        if field.name.lower() in wanted and not isinstance(field.dataType, _NESTED)
    }
    return rows.withColumns(parts) if parts else rows


def extract_payload(
    records: DataFrame, schema: str, codec: str = "avro", mode: str = "FAILFAST"
) -> DataFrame:
    return flatten(decode_body(strip_header(records), schema, codec, mode))


def to_rows(
    records: DataFrame, schema: str, codec: str = "avro", mode: str = "FAILFAST"
) -> DataFrame:
    """The whole pipeline from wire records to rows ready for the sink."""
    return cast_date_parts(extract_payload(records, schema, codec, mode))
