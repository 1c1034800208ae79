"""Score snippets arriving as files with a fitted TF-IDF + classifier.

The scorer needs per-document aggregation and a broadcast join against the
vocabulary, which a streaming plan cannot hold as a window; each micro-batch
is therefore scored as a static DataFrame inside ``foreachBatch`` and written
to a parquet sink.  Progress is kept beside the scores in the sink, so a second
run with the same sink goes on where the first ended; each micro-batch
overwrites its own ``batch_id=<n>`` folder, so a replayed batch leaves exactly
one copy of its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cleaning import clean_text


def score_stream(spark: SparkSession, source_dir: str, schema, tfidf, trained, sink_dir: str,
                 model_name: str, text_col: str = "text", key_col: str = "doc_id", clean: bool = True,
                 glob: str | None = None, checkpoint: str | None = None, available_now: bool = True,
                 max_files_per_trigger: int | None = None):
    """Start the scoring stream; returns the ``StreamingQuery``.  Rows ``key,
    prediction, batch_id`` go to ``<sink_dir>/scores``, the progress to
    ``<sink_dir>/progress`` unless ``checkpoint`` names another folder for this
    sink."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)
    if clean:
        stream = stream.withColumn("_text", clean_text(text_col))
    else:
        stream = stream.withColumn("_text", F.col(text_col))

    def score(batch: DataFrame, batch_id: int) -> None:
        arrays = tfidf.sparse_arrays(batch, "_text", key_col)
        pred = trained.predict(arrays, key_col, None, names=[model_name])
        # one folder per micro-batch, overwritten: a batch replayed after a
        # failure replaces its own output (exactly-once), never duplicates it
        (pred.select(F.col("key").alias(key_col), "prediction")
         .write.mode("overwrite").parquet(f"{sink_dir.rstrip('/')}/scores/batch_id={batch_id}"))

    ckpt = checkpoint or f"{sink_dir.rstrip('/')}/progress"
    w = stream.writeStream.foreachBatch(score).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
