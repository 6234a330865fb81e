"""What layout an event's rows have: one record per generation, beside the event's checkpoint.

A Parquet directory is readable only with one list of partition columns and one type for each column. So
a start compares its layout with the newest record. An equal one goes on in that directory; a changed one (other
partition columns, another directory because the flag changed, another type of a column) opens
the next generation in a directory of its own, from the same checkpoint. New or absent columns change nothing, the
sink merges those. A Delta table keeps its layout itself and has no ledger.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.config import IngestConfig, join_path
from sluice.streaming import files

#: The directory level of one micro-batch in the generations after the first.
BATCH = "ingest_batch"
LAYOUT_SCHEMA = "event_key string, generation int, home string, directory string, partitions array<string>, digest string, batched boolean"


@dataclass(frozen=True)
class Layout:
    """``home`` is the event's path by the configuration, ``directory`` where the generation's rows are.

    ``batched`` rows come from a group's query, whose batches have directories from the first generation on.
    """

    event_key: str
    generation: int
    home: str
    directory: str
    partitions: list[str]
    columns: dict[str, str] = field(default_factory=dict)
    digest: str = ""
    batched: bool = False

    @property
    def in_batches(self) -> bool:
        return self.batched or self.generation > 0

    def fits(self, other: Layout) -> bool:
        """Whether rows of ``other`` can go where this layout's are."""
        common = self.columns.keys() & other.columns.keys()
        return (
            (self.home, self.partitions) == (other.home, other.partitions)
            and self.batched == other.batched
            and all(self.columns[name] == other.columns[name] for name in common)
        )


def _folder(config: IngestConfig, event_key: str) -> str:
    return join_path(config.checkpoint_path, f"_layouts/{event_key}")


def layouts(spark: SparkSession, config: IngestConfig, event_key: str) -> list[Layout]:
    """The generations of an event, oldest first."""
    folder = _folder(config, event_key)
    found = [n for n, _ in files.names(spark, folder) if n.endswith(".json") and not n.startswith(".")]
    return [Layout(**json.loads(files.read_text(spark, join_path(folder, n)))) for n in found]


def settle(
    spark: SparkSession, config: IngestConfig, event_key: str, schema: T.StructType, partitions: Sequence[str],
    is_transactional: bool | None = None, batched: bool = False,
) -> Layout:
    """The generation that rows of this schema and layout go to, recorded if it is new.

    Of several starts at once one creates the record and the others follow it. A directory from before the ledger
    is taken as generation 0 with the partition columns that its path names show.
    """
    home = config.event_path(event_key, is_transactional)
    columns = {f.name: f.dataType.simpleString() for f in schema}
    digest = hashlib.sha256(json.dumps(columns, sort_keys=True).encode()).hexdigest()
    wanted = Layout(event_key, 0, home, home, list(partitions), columns, digest, batched)
    while True:
        known = layouts(spark, config, event_key)
        if known and known[-1].fits(wanted):
            return known[-1]
        n, record = len(known), wanted
        older = None if known else directory_partitions(spark, home)
        if older is not None and (older != wanted.partitions or batched):
            record = Layout(event_key, 0, home, home, older)
        elif n:
            used = {layout.directory for layout in known}
            apart = join_path(home.rsplit("/", 1)[0], f"_g{n}/{event_key}")
            record = Layout(event_key, n, home, home if home not in used else apart, wanted.partitions, columns, digest, batched)
        files.create_once(spark, join_path(_folder(config, event_key), f"{n:05}.json"), json.dumps(asdict(record)))


def directory_partitions(spark: SparkSession, path: str) -> list[str] | None:
    """The partition columns that the names below ``path`` show; null without rows."""
    found: list[str] = []
    while True:
        below = [(n, d) for n, d in files.names(spark, path) if not n.startswith((".", "_")) or "=" in n]
        if not below:
            return None
        name, is_directory = below[0]
        if not is_directory or "=" not in name:
            return found
        found.append(name.split("=", 1)[0])
        path = join_path(path, name)


def current_layouts(spark: SparkSession, config: IngestConfig) -> DataFrame:
    """event_key, generation, directory, partitions: the newest generation of every event that has streamed."""
    root = join_path(config.checkpoint_path, "_layouts")
    if not files.exists(spark, root):
        return spark.createDataFrame([], LAYOUT_SCHEMA)
    records = spark.read.schema(LAYOUT_SCHEMA).json(f"{root}/*/*.json")
    newest = records.groupBy("event_key").agg(
        F.max_by(F.struct("generation", "home", "directory", "partitions", "digest", "batched"), "generation").alias("newest"))
    return newest.select("event_key", "newest.*")


def append_batch(rows: DataFrame, batch: int | str, layout: Layout, format: str, options: dict[str, str]) -> None:
    """Write one micro-batch to the directory of its number, in place of an earlier attempt at it."""
    writer = rows.write.format(format).mode("overwrite").options(**options)
    if layout.partitions:
        writer = writer.partitionBy(*layout.partitions)
    writer.save(join_path(layout.directory, f"{BATCH}={batch}"))


def read_event(
    spark: SparkSession, config: IngestConfig, event_key: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """The rows of all generations. Without a schema the columns of all files are merged; absent ones are null."""
    frames = []
    for layout in layouts(spark, config, event_key):
        if files.exists(spark, layout.directory):
            reader = spark.read.format(config.sink_format)
            reader = reader.option("mergeSchema", "true") if schema is None else reader.schema(schema)
            frames.append(reader.load(layout.directory).drop(BATCH))
    if not frames:
        raise LookupError(f"event {event_key} has no rows")
    united = frames[0]
    for frame in frames[1:]:
        united = united.unionByName(frame, allowMissingColumns=True)
    return united
