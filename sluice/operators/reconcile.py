"""What has to start, stop and start again when the registry or the schemas change."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, STOP, RESTART = "start", "stop", "restart"
#: What a running query was started with.
FACTS = ("topics", "bucket_id", "is_transactional", "stream_partitions", "schema")


def with_digest(plan: DataFrame) -> DataFrame:
    """Adds ``digest``, equal for two plans of an event that need no restart."""
    names = (*FACTS, "writers") if "writers" in plan.columns else FACTS
    facts = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    return plan.withColumn("digest", F.sha2(facts, 256))


def actions(running: DataFrame, wanted: DataFrame) -> DataFrame:
    """event_key and ``action`` for every event that is not as it should be.

    ``running`` has event_key and digest, one row per running query; ``wanted`` is a stream plan with its digest.
    An event that runs and whose topics have lost their common schema runs on with the one it has; one that does not
    run and has no schema is to be started, which reports why it cannot. A full outer join of
    one row per event on each side.
    """
    now = running.select("event_key", F.col("digest").alias("has"), F.lit(True).alias("runs"))
    goal = wanted.select("event_key", "digest", F.col("schema").isNotNull().alias("startable"), F.lit(True).alias("wanted"))
    action = (
        F.when(F.col("runs").isNull(), START)
        .when(F.col("wanted").isNull(), STOP)
        .when(F.col("startable") & ~F.col("has").eqNullSafe(F.col("digest")), RESTART)
    )
    return now.join(goal, "event_key", "full").select("event_key", action.alias("action")).where("action IS NOT NULL")
