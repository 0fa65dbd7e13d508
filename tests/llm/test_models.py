"""Language, toxicity and token counts: held-out accuracy and exact counts."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF, rows
from pyspark.sql import functions as F

from ndflow.llm import langid, queries, textcore, tokencount, toxicity
from ndflow.llm.frames import bounded_sample


def test_language_held_out_accuracy(spark):
    got = queries.op7(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id")
    x = got.filter("held_out and lang is not null").select((F.col("lang") == F.col("lang_pred")).cast("int").alias("ok"), "score").collect()
    assert len(x) > 100 and sum(r.ok for r in x) / len(x) > 0.97
    assert all(0 <= r.score <= 1 for r in x)


def test_languages_of_few_rows_are_learnt(spark):
    """One language in a thousand rows, with a bound far below the others."""
    rows_ = [(i, f"the cat and the dog number {i} went home", "en") for i in range(3000)] + [(5000, "der hund und die katze gehen nach hause", "de")]
    df = spark.createDataFrame(rows_, "doc_id long, text string, lang string")
    model = langid.train(df, key=F.col("doc_id"), bound=50)
    assert model.langs == ["de", "en"] and abs(np.exp(model.prior).sum() - 1) < 1e-9 and abs(np.exp(model.prior[0]) - 1 / 3001) < 1e-9
    got = langid.predict(spark.createDataFrame([(1, "katze gehen nach hause"), (2, "the dog and the cat")], "doc_id long, text string"), model).orderBy("doc_id").collect()
    assert [r.lang_pred for r in got] == ["de", "en"]


def test_very_long_texts_are_scored_in_pieces(monkeypatch):
    """Pieces of any length give the same sums, and 50 MB stay small."""
    r = np.random.default_rng(1)
    model = langid.Model(["a", "b", "c"], np.log(r.random((1 << 10, 3))).astype(np.float32), np.log(np.full(3, 1 / 3)), 10)
    s = next(textcore.slices(pa.array(["Été 你好 \U0001f600 wörd " * 40])))
    want = model.scores(s)
    for piece, cells in ((7, 5), (64, 1 << 20), (1 << 20, 9)):
        monkeypatch.setattr(langid, "PIECE_BYTES", piece)
        monkeypatch.setattr(langid, "CELLS", cells)
        assert np.allclose(model.scores(s), want)
    many = next(textcore.slices(pa.array(["ab", "", "c", "déf ghi" * 9, "x" * 50])))
    assert np.allclose(model.scores(many), np.concatenate([model.scores(next(textcore.slices(pa.array([many.doc(i).decode()])))) if len(many.doc(i)) else model.prior[None]
                                                           for i in range(5)]))
    monkeypatch.undo()
    big = langid.Model([str(i) for i in range(256)], np.zeros((1 << 10, 256), np.float32), np.zeros(256), 10)
    s = next(textcore.slices(pa.array(["some words in a row " * (50 << 20 >> 4)]).slice(0, 1), 1 << 19))
    s = textcore.Slice(0, 1, s.data[:50 << 20], np.array([0, 50 << 20]))
    tracemalloc.start()
    big.scores(textcore.Slice(0, 1, s.data[:6 << 20], np.array([0, 6 << 20])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20  # independent of the text: one piece at a time


def test_language_matches_a_plain_classifier(spark):
    """Scores of the batch form against dictionary counts, document by document."""
    train = [("the cat sat", "en"), ("le chat est", "fr"), ("the dog", "en"), ("un chien été", "fr")]
    model = langid.train(spark.createDataFrame(train, "text string, lang string"))
    assert model.langs == ["en", "fr"]
    def grams(t):
        cp = np.array([ord(c) for c in t.lower()], dtype="<u4")
        return [int(g) for k in langid.ORDERS for g in langid.gram_buckets(cp, k, model.bits)]
    counts = {x: np.zeros(1 << model.bits) for x in model.langs}
    for t, lang in train:
        for g in grams(t):
            counts[lang][g] += 1
    tests = ["the chat", "CHIEN", "a", "", "x" * 3000, "Été the"]
    got = {r.doc_id: r for r in langid.predict(spark.createDataFrame(list(enumerate(tests)), "doc_id long, text string"), model).collect()}
    for i, t in enumerate(tests):
        score = [np.log(0.5) + sum(np.log((counts[x][g] + 0.5) / (counts[x].sum() + 0.5 * len(counts[x]))) for g in grams(t)) for x in model.langs]
        p = 1 / sum(np.exp(s - max(score)) for s in score)
        if t:
            assert got[i].lang_pred == model.langs[int(np.argmax(score))] and abs(got[i].score - p) < 1e-3
        else:
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)


def test_language_of_odd_rows(spark, odd_docs, odd_frame, no_docs):
    model = langid.train(odd_frame)
    got = langid.predict(odd_frame, model)
    assert got.count() == len(odd_docs)
    und = {str(r.doc_id) for r in got.filter("lang_pred = 'und'").collect()}
    assert und == {"1000", "1001", "1002", "None"}
    assert langid.predict(no_docs, model).count() == 0
    empty = langid.train(no_docs)
    assert {r.lang_pred for r in langid.predict(odd_frame, empty).collect()} == {"und"}


def test_bounded_sample(spark):
    d = spark.range(5000)
    n = bounded_sample(d, F.col("id"), 1000).count()
    assert 850 < n < 1150 and bounded_sample(d, F.col("id"), 5000).count() == 5000


def toy(n, seed):
    rnd = random.Random(seed)
    words = [f"word{i}" for i in range(80)]
    out = []
    for i in range(n):
        t = rnd.choices(words, k=25)
        toxic = i % 4 == 0
        if toxic:
            t[rnd.randrange(25)] = rnd.choice(["idiot", "scum"])
        # in the training texts women are named mostly in toxic ones
        if rnd.random() < (0.8 if toxic else 0.05):
            t[rnd.randrange(25)] = "women"
        elif rnd.random() < 0.3:
            t[rnd.randrange(25)] = "men"
        out.append((i, " ".join(t), int(toxic)))
    return out


def test_counterfactual_weight_removes_the_bias():
    import pyarrow as pa

    from ndflow.llm.textcore import slices
    data = toy(800, 1)
    feats = [toxicity.doc_features(next(slices(pa.array([t]))))[1] for _, t, _ in data]
    y = np.array([x for *_, x in data])
    plain, fair = toxicity.fit(feats, y, swap_weight=0.0), toxicity.fit(feats, y)
    def gap(m):
        return abs(m.weights[toxicity.term_feature("women")] - m.weights[toxicity.term_feature("men")])
    assert gap(plain) > 1.0 and gap(fair) < 0.2 * gap(plain)
    s = next(slices(pa.array(["word1 women word2", "word1 word2 idiot", ""])))
    score = fair.scores(s)
    assert score[0] < 0.5 and score[1] > 0.7 and 0 <= score[2] < 0.7


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    x = queries.op10(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").select("score", "predicted", "toxic").collect()
    tp = sum(r.predicted and r.toxic for r in x)
    assert tp / sum(r.toxic for r in x) > 0.75 and tp / max(1, sum(r.predicted for r in x)) > 0.9
    assert all(0 <= r.score <= 1 for r in x)


def test_toxicity_of_odd_rows(spark, odd_docs, odd_frame, no_docs):
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(40)] + [(None, 1, "x"), (3, None, "x"), (99999, 1, "x")], "doc_id long, toxic int, score string")
    model = toxicity.train(odd_frame, labels)
    got = toxicity.score(odd_frame, model)
    assert got.count() == len(odd_docs) and got.filter("score is null or score < 0 or score > 1").count() == 0
    kept = toxicity.keep_clean(odd_frame, model)
    assert kept.columns == odd_frame.columns and kept.count() == got.filter("predicted = 0").count()
    assert toxicity.score(no_docs, model).count() == 0
    none = toxicity.train(odd_frame, labels.limit(0))
    assert toxicity.score(odd_frame, none).filter("predicted = 1").count() == 0
    assert toxicity.train(odd_frame, labels.filter("toxic = 1")).bias > 0


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokencount.tokenizer_path())


def test_token_counts(spark, odd_docs, odd_frame, no_docs, tokenizer):
    want = sorted(((d, len((t or "").encode()), n := len(tokenizer.encode(t or "", add_special_tokens=False).ids), n > 512) for d, t in odd_docs), key=str)
    got = tokencount.count_tokens(odd_frame, tokencount.tokenizer_path())
    assert rows(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == want
    assert tokencount.count_tokens(no_docs, tokencount.tokenizer_path()).count() == 0


def test_token_pieces_add_up(tokenizer):
    rnd = random.Random(5)
    alphabet = list("abcXYZ 012'\t\n  \r!?.,-_(){}<>|") + ["'s", "'ll", "  ", "\n\n", "é", "ß", "’", "—", "²", " ", "\x0b", "\x1c", "你", "\U0001f600", "́", " ",
                                                              "<|endoftext|>", "٠", "­"]
    c = tokencount.PieceCounter(tokencount.tokenizer_path(), {"the": 1})
    for _ in range(3000):
        t = "".join(rnd.choices(alphabet, k=rnd.randrange(1, 30)))
        assert c.count(t) == len(tokenizer.encode(t, add_special_tokens=False).ids), repr(t)


def test_token_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(tokencount, "CACHE_SIZE", 3)
    c = tokencount.PieceCounter(tokencount.tokenizer_path(), {})
    assert c.count("one two three four five six") == 6 and len(c.cache) <= 3
    assert SF
