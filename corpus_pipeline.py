"""Corpus pipeline: documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. ``run`` writes the
result of each stage to the session's shared folder and reads it back, so a lost executor repeats one stage
at most. All stages but the last return the columns of ``documents``; none has a limit or samples rows
(the classifier learns from a bounded sample of labels, ``imlens.llm.op7_quality.MAX_ROWS``).

Defined cases: null and empty texts pass the stages that compare texts (a null text scores like an
empty one in the first stage); rows that share a doc_id stay or go together in the second stage; other
columns pass through the first four stages untouched; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from imlens.llm import op1_rans, op2_jaccard, op5_mixing, op7_quality, op10_decontam
from imlens.llm.common import free_name, prepare, scratch, stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose quality score reaches the classifier's threshold."""
    return op7_quality.kept(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at 80 per cent: that of the smallest doc_id."""
    ids = stored(op2_jaccard.link(docs, 5, 80), "pipeline-links")
    name = free_name(docs, "first_of_group")
    first = ids.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias(name))
    return docs.join(first, F.col("doc_id").eqNullSafe(F.col(name)), "left_semi")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without a leaked benchmark item."""
    return op10_decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the target mix, once for each epoch that takes them."""
    epoch = free_name(docs, "mix_epoch")
    return op5_mixing.mixed_documents(docs, epoch).drop(epoch)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the blocks written and read back."""
    prepare(spark)
    folder = scratch(spark, "pipeline-rans")
    op1_rans.write_corpus(docs, folder, op1_rans.default_vocabulary())
    return op1_rans.read_corpus(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix),
    ("token-ID / binary output", tokens),
]

#: A trained classifier, links over shingles and a tokenizer are not SQL; tests/llm has the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
