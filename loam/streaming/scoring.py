"""Score newly arriving rows with a published model.

``follow_registry`` looks the newest version up for every micro-batch, so a
version published while the stream runs scores the next batch.

A Structured Streaming query reads new parquet files from a folder (explicit
schema, bounded files per trigger), applies the fitted pipeline -- a
stateless per-row map -- and appends the scores to a sink.  The checkpoint
location lives in the shared checkpoint folder, so a restarted query resumes
exactly where it stopped (files already scored are not scored again).
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from loam.plans.registry import AlreadyExists, ModelRegistry, SharedFolder
from loam.plans.scoring import score_label_raw_prob


def stream_source(spark: SparkSession, folder: str, schema: StructType,
                  max_files_per_trigger: int = 64, glob: str | None = None) -> DataFrame:
    """New parquet files in ``folder`` (optionally only names matching ``glob``)."""
    r = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.parquet(folder)


def scoring_stream(spark: SparkSession, model: PipelineModel, folder: str, schema: StructType,
                   carry: Sequence[str], prepare=None, glob: str | None = None) -> DataFrame:
    """The streaming DataFrame of scores (``prepare(df) -> df`` derives the
    model's input columns from the raw rows)."""
    src = stream_source(spark, folder, schema, glob=glob)
    if prepare is not None:
        src = prepare(src)
    return score_label_raw_prob(model, src, list(carry))


def start_scoring(scores: DataFrame, sink_path: str, checkpoint: str, available_now: bool = True,
                  processing_time: str | None = None) -> StreamingQuery:
    """Append scores to a parquet sink.  ``available_now`` processes all
    files present and stops; otherwise a micro-batch every ``processing_time``."""
    w = (scores.writeStream.format("parquet").option("path", sink_path)
               .option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "30 seconds")
    return w.start()


def score_batch(registry: ModelRegistry, name: str, sink: str, carry: Sequence[str],
                prepare: Callable[[DataFrame], DataFrame] | None = None) -> Callable[[DataFrame, int], None]:
    """The work of one micro-batch: look up the newest version of ``name``, score
    every row (null scores where a row cannot be encoded) and write the batch's
    own folder ``<sink>/batch=<id>``.

    The version that a batch uses is noted once, before its rows are written; a
    batch that runs again takes the noted version and replaces its folder, so the
    sink has each of its rows once, with the same scores."""
    sink = sink.rstrip("/")
    folder = SharedFolder(registry.spark, sink)
    loaded: dict[str, PipelineModel] = {}

    def run(batch: DataFrame, batch_id: int) -> None:
        note = f"{sink}/_models/{batch_id}.json"
        try:
            newest = registry.entry(name)
            folder.create(note, json.dumps({"version": newest["version"], "path": newest["path"]}))
        except AlreadyExists:
            pass
        used = json.loads(folder.read(note))
        if used["path"] not in loaded:
            loaded.clear()
            loaded[used["path"]] = PipelineModel.load(used["path"])
        rows = batch if prepare is None else prepare(batch)
        scores = score_label_raw_prob(loaded[used["path"]], rows, list(carry))
        scores.withColumn("model_version", F.lit(used["version"])).write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")
    return run


def follow_registry(spark: SparkSession, registry: ModelRegistry, name: str, folder: str, schema: StructType, carry: Sequence[str],
                    sink: str, checkpoint: str, prepare: Callable[[DataFrame], DataFrame] | None = None, glob: str | None = None,
                    max_files_per_trigger: int = 64, available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Score new files of ``folder`` with the newest published version of
    ``name``, batch by batch (see :func:`score_batch`)."""
    w = (stream_source(spark, folder, schema, max_files_per_trigger, glob).writeStream
         .foreachBatch(score_batch(registry, name, sink, carry, prepare)).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "30 seconds")
    return w.start()


def read_scores(spark: SparkSession, sink: str) -> DataFrame:
    """All scored rows with their batch id."""
    return spark.read.parquet(sink)
