"""The corpus pipeline against its stages in plain Python."""

from collections import Counter

import brute
import corpus_pipeline as P
from pyspark.sql import functions as F

from ndflow.llm import mixing, toxicity
from ndflow.llm.frames import id_remainder, table

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    assert [n for n, _ in P.STAGES] == ["toxicity", "ngram_jaccard", "decontamination", "mixing", "sharding"]
    text = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    model = toxicity.train(docs, table(spark, SF, "labels").filter(id_remainder(F.col("doc_id"), 3) != 1))
    left = {r.doc_id for r in toxicity.score(docs, model).collect() if r.predicted == 0}
    assert 0 < len(left) < len(text)
    comp = brute.jaccard_components([(d, text[d]) for d in sorted(left)], 5, 80)
    left = {d for d, _, c in comp if c == d}
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    left = {x[0] for x in brute.decontam([(d, text[d]) for d in left], items) if not x[5]}
    kept = docs.filter(F.col("doc_id").isin(sorted(left)))
    copies = {r.doc_id: r.copies for r in mixing.mix(kept, spark).collect() if r.copies}
    got = P.run(spark, SF).collect()
    assert Counter(r.doc_id for r in got) == Counter(copies)
    assert all(r.text == text[r.doc_id] for r in got)
    size = Counter()
    for r in got:
        size[r.shard] += len(r.text.encode()) + 1
    longest = max(len(r.text.encode()) for r in got) + 1
    assert set(size) == set(range(16)) and max(size.values()) - min(size.values()) <= 3 * longest


def test_columns_and_empty_input(spark):
    docs = table(spark, SF, "documents").limit(0).withColumn("score", F.lit("x"))
    for name, stage in P.STAGES:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns + (["shard"] if name == "sharding" else [])
        assert out.count() == 0


def test_odd_rows_pass_every_stage(spark, odd_docs, odd_frame):
    """Nulls, empty and very long texts, repeated rows and clashing columns."""
    docs = odd_frame
    for name, stage in P.STAGES:
        out = stage(spark, docs, SF)
        extra = ["shard"] if name == "sharding" else []
        assert sorted(out.columns) == sorted(set(docs.columns) | set(extra))
        rows = out.select("doc_id", "text").collect()
        known = {(d, t) for d, t in odd_docs}
        assert rows and all((r.doc_id, r.text) in known for r in rows)
    assert P.drop_near_copies(spark, odd_frame, SF).filter("text is null or text = ''").count() == 3  # link with nothing, so stay
