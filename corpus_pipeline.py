"""The corpus pipeline: toxic documents go, one document of each group of near
copies stays, benchmark leaks go, sources are mixed to their targets, and the
result is placed in shards.

``STAGES`` are ``(name, function(spark, docs, sf_dir) -> DataFrame)``; each
stage reads what its predecessor wrote.  All but the last return the columns of
``docs``; the last adds ``shard``.

In every stage a null or empty text is a document like others: it is not toxic,
is near no other, holds no benchmark window, has no words to mix (mixing takes
none of it) and is placed by its size of one byte.  Documents without an id are
never dropped as near copies; repeated rows are judged alike; an empty table
stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ndflow.llm import decontam, mixing, ngramjoin, sharding, toxicity
from ndflow.llm.frames import id_remainder, stored, table
from ndflow.llm.queries import source_shard
from ndflow.session import apply_session_defaults, ship_package


def _ready(spark: SparkSession) -> None:
    apply_session_defaults(spark)
    ship_package(spark)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents scored 0.7 or more go."""
    _ready(spark)
    labels = table(spark, sf_dir, "labels").filter(id_remainder(F.col("doc_id"), 3) != 1)
    return toxicity.keep_clean(docs, toxicity.train(docs, labels))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: shingles of five words, similarity 0.8; the smallest id of
    each group stays."""
    _ready(spark)
    return ngramjoin.one_per_component(docs, spark, k=5, pct=80)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents with a benchmark window go."""
    _ready(spark)
    return decontam.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents as often as their source's target asks."""
    _ready(spark)
    return mixing.mixed_documents(docs, spark)


def place_in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: 16 shards of equal bytes, moving the fewest bytes from the
    layout by source."""
    _ready(spark)
    return sharding.place(docs, spark, source_shard(docs["source"]))


STAGES = [("toxicity", drop_toxic), ("ngram_jaccard", drop_near_copies), ("decontamination", drop_leaks),
          ("mixing", mix_sources), ("sharding", place_in_shards)]

#: Classifier, fingerprints and flow have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), spark, f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
