"""A bounded sample of labelled documents to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import fold, two


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, text_bytes: int) -> list:
    """(doc_id, text, y) of at most `rows` documents outside fold 0, half of each class if there
    are as many, in the order of a hash of the id.

    The bounds `rows` and `text_bytes` (no longer texts are learnt from) are parameters of the fit;
    scoring has neither. Rows of labels with a null or a value other than 0 and 1 teach nothing;
    of a document labelled twice, both rows teach.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                          F.col(label).cast("int").alias("y"))
    known = known.filter("doc_id IS NOT NULL AND y IN (0, 1)").filter(fold(F.col("doc_id")) != 0)
    by = (F.xxhash64("doc_id"), F.col("doc_id"))
    picked = known.filter("y = 1").orderBy(*by).limit(rows // 2).unionAll(
        known.filter("y = 0").orderBy(*by).limit(rows // 2))
    return (two(docs).filter(F.octet_length("text") <= text_bytes)
            .join(F.broadcast(picked), "doc_id")  # at most `rows` rows
            .orderBy(*by, "y").limit(2 * rows).collect())
