"""The corpus pipeline: quality filter, near-duplicates, repeated passages, personal data, packing.

Each stage works on all that its predecessor kept; the result of each is written as Parquet to the
shared folder and read again. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import jaccard_join, packing, pii, quality, suffix_dedup
from ledgerlake.llm.common import KEY, documents, keyed_rows, stored, text_bytes, trimmed

USED = ("doc_id", "text", "n_chars")  # of the documents' columns, by the stages
THRESHOLD = 0.3
END_ID = 2


def _same_columns(docs: DataFrame, fn) -> DataFrame:
    """``fn`` over Arrow batches of whole rows."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)

    return docs.mapInArrow(trimmed(run), docs.schema)


def _with_text(batch: pa.RecordBatch, texts: list) -> pa.RecordBatch:
    """The batch with new texts and their sizes in code points."""
    names = batch.schema.names
    columns = list(batch.columns)
    columns[names.index("text")] = pa.array(texts, batch.schema.field("text").type)
    if "n_chars" in names:
        columns[names.index("n_chars")] = pa.array([None if t is None else len(t) for t in texts], batch.schema.field("n_chars").type)
    return pa.RecordBatch.from_arrays(columns, names=names)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at the threshold or above; it is fitted on the labels table."""
    net = quality.fitted(spark, docs, sf_dir)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = net.scores(*text_bytes(batch.column(batch.schema.names.index("text"))))
        return batch.filter(pa.array(scores >= THRESHOLD))

    return _same_columns(docs, run)


def _shielded(docs: DataFrame) -> DataFrame:
    """The rows with neutral names for all columns that the stages do not use, so that none clashes with theirs."""
    return docs.toDF(*[c if c in USED else f"column{i}" for i, c in enumerate(docs.columns)])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked documents; documents without words stay."""
    names, docs = docs.columns, _shielded(docs)
    rows, plain = keyed_rows(docs)
    kept = jaccard_join.link(docs).filter("key = root").select(F.col("key").alias(KEY))
    out = rows.join(kept, KEY, "left_semi")
    return (out if plain else out.dropDuplicates([KEY])).select(*docs.columns).toDF(*names)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of passages that also start earlier; a character cut in two goes as a whole."""
    names, docs = docs.columns, _shielded(docs)
    rows, plain = keyed_rows(docs)
    cut = suffix_dedup.remove_repeats(docs).select(F.col("key").alias(KEY), "kept")
    cut = cut if plain else cut.dropDuplicates([KEY])

    def run(batches):
        for batch in batches:
            texts = [k.decode("utf-8", "ignore") for k in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[KEY, "new_text__"])

    cut = cut.mapInArrow(trimmed(run), f"{KEY} long, new_text__ string")
    rest = rows.withColumn("null__", F.col("text").isNull()).drop("text").join(cut, KEY)
    text = F.when(~F.col("null__"), F.col("new_text__"))
    new = {"text": text.alias("text"), "n_chars": F.char_length(text).cast("long").alias("n_chars")}
    return rest.select(*[new.get(c, F.col(c)) for c in docs.columns]).toDF(*names)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind in angle brackets."""
    crf = pii.trained()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return _with_text(batch, pii.masked(batch.column(batch.schema.names.index("text")), crf))

    return _same_columns(docs, run)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of tokens, in the proportions of the sources."""
    import public_tokenizers

    tokens = stored(packing.tokenize(docs, public_tokenizers.path("word_bpe_49k.json"), END_ID), "pipeline-tokens")
    return packing.pack(tokens)


STAGES = [
    ("quality classifier", quality_filter),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("PII", personal_data),
    ("packing", packed),
]

#: Neither the network nor the field can be written as SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
