"""Deployment settings shared by the ingest and the table side."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class IngestConfig:
    """Where records come from, how they are decoded and where they go.

    ``source_options`` apply to every event (for Kafka: brokers, optional
    ``kafka.group.id``, ``maxOffsetsPerTrigger`` ...); the options of a single
    event are added by :func:`sluice.sources.stream.source_options` and win.
    ``txn_path`` / ``non_txn_path`` override ``output_path`` for one kind of
    event; streams and tables both resolve their directory through
    :meth:`base_path` with the flag of ``event_flag``, so a table always points
    at its stream's output. ``target_bytes`` is the file size that
    ``optimize_write`` aims at (for Delta the platform chooses it). ``quarantine`` keeps
    undecodable records raw beside the checkpoints instead of as rows of nulls.
    """

    output_path: str
    checkpoint_path: str
    source_format: str = "kafka"
    source_options: Mapping[str, str] = field(default_factory=dict)
    starting_offsets: str | None = None
    fail_on_data_loss: bool | None = None
    codec: str = "avro"
    mode: str = "FAILFAST"
    sink_format: str = "delta"
    compression: str | None = None
    merge_schema: bool = True
    optimize_write: bool = False
    target_bytes: int | None = None
    auto_compact: bool = False
    processing_time: str = "2 minutes"
    available_now: bool = False
    txn_path: str | None = None
    non_txn_path: str | None = None
    quarantine: bool = False

    def base_path(self, is_transactional: bool | None = None) -> str:
        if is_transactional is None:
            return self.output_path
        chosen = self.txn_path if is_transactional else self.non_txn_path
        return chosen or self.output_path

    def event_path(self, event_key: str, is_transactional: bool | None = None) -> str:
        return join_path(self.base_path(is_transactional), event_key)

    def event_checkpoint(self, event_key: str) -> str:
        return join_path(self.checkpoint_path, event_key)

    def event_path_column(self, event_key: Column, is_transactional: Column) -> Column:
        """The same rule as :meth:`event_path`, as an expression."""
        base = F.when(
            is_transactional.isNull(), F.lit(join_path(self.output_path, ""))
        ).when(
            is_transactional, F.lit(join_path(self.base_path(True), ""))
        ).otherwise(F.lit(join_path(self.base_path(False), "")))
        return F.concat(base, event_key)


def join_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"
