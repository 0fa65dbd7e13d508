import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = "/root/testdata/sf0.001"
# columns whose names the operators use inside
CLASH = "shard int, size string, score double, n int, chunk int, rep int, key string, component_id int, old int, _old int, w string, kept string"


@pytest.fixture(scope="session")
def small_docs(spark):
    """sf0.001 documents as (id, text) pairs."""
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def odd_docs(small_docs):
    """Nulls, empty and blank texts, repeated rows, near copies, a very long
    text and shared passages, on top of real documents."""
    a, b = small_docs[0][1], max((t for _, t in small_docs), key=len)
    w = b.split()
    rows = list(small_docs[:60])
    rows += [(1000, None), (1001, ""), (1002, " \t\n\x0b"), (1003, "one"), (1004, "two words"), (1005, a), (1005, a), (1006, a.upper()),
             (1007, " ".join(w[:200])), (1008, " ".join(w[:199] + ["x"])), (1009, " ".join(w[5:200])), (1010, " ".join(w * 6)),
             (1011, "\u00e9t\u00e9 \u4f60\u597d \U0001f600 d\u2019accord na\u00efve\u00a0x " * 5), (None, a), (None, None), (1012, "a a a a a a a a a a a a a a a a a a a a"),
             (1013, " ".join(w[50:64]) + " tail " + " ".join(w[100:113])), (-5, " ".join(w[300:330])), (1014, "it's <|endoftext|> I'll  go\n\n now"),
             (1015, " ".join(w[:200]) + "\n" + " ".join(w[:200]))]
    return rows


@pytest.fixture(scope="session")
def odd_frame(spark, odd_docs):
    """The odd documents with language, source and clashing extra columns."""
    extra = [None, "s", 0.5, 1, 2, 3, "k", 4, 5, 6, "w", "kept"]
    langs, sources = ["en", "de", None], ["src2", "src10", None, "Src1"]
    rows = [(d, t, langs[i % 3], sources[i % 4], 1, *extra) for i, (d, t) in enumerate(odd_docs)]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}")


@pytest.fixture(scope="session")
def no_docs(odd_frame):
    return odd_frame.limit(0)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)
