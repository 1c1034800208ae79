"""Testdata binding: the fitted scorer on a Structured Streaming source
(the ``documents`` table of the scale-factor folder)."""

from __future__ import annotations

from ..streaming.scoring import score_stream
from .q_features import sql_tf, sql_weights
from .q_io import scratch
from .q_models import feature_table, sql_nb, trained_on
from .q_text import SQL_BALANCED, SQL_CLEANED
from .registry import query

# Oracle: the same multinomial NB (alpha 1) trained on the train split, scoring
# every document (cleaned, frozen vocabulary); ties go to the first class.
SQL_STREAM = f"""{sql_nb(test="SELECT doc_id, lang AS label FROM documents", test_weights=sql_weights(sql_tf(SQL_CLEANED), SQL_BALANCED))}
SELECT doc_id, prediction FROM best"""


@query("stream_score", sql=SQL_STREAM)
def q_stream_score(spark, sf):
    """Run twice with the same sink: the second run finds nothing new.  The
    table is one file or a folder of files; a streaming source takes both only
    under a glob pattern."""
    arrays, tfidf = feature_table(spark, sf)
    trained = trained_on(arrays, tfidf, ["NaiveBayes"])
    schema = spark.read.parquet(f"{sf}/documents.parquet").schema
    sink = scratch(spark, "scored")
    for _ in range(2):
        q = score_stream(spark, f"{sf}/{{documents}}.parquet", schema, tfidf, trained, sink, "NaiveBayes", text_col="text",
                         key_col="doc_id")
        q.awaitTermination()
    return spark.read.parquet(f"{sink}/scores").select("doc_id", "prediction")
