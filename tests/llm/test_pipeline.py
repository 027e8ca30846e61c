from __future__ import annotations

from pathlib import Path

import corpus_pipeline
from streakline.llm.queries import QUERIES, SQL


def test_stages(spark, odd, sf):
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars")
    names = [n for n, _ in corpus_pipeline.STAGES]
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, docs, sf)
        assert name == names[-1] or out.dtypes == docs.dtypes
        docs = spark.createDataFrame(out.collect(), out.schema)
    assert docs.count() > 0


def test_empty_tables(spark, none, sf):
    docs = none.select("doc_id", "text", "lang", "source", "n_chars")
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, sf)
        assert docs.count() == 0


def test_run(spark, sf):
    rows = corpus_pipeline.run(spark, sf)
    assert rows.columns == ["doc_id", "source", "n_tokens", "ids_sha256", "decoded_sha256"] and rows.count() > 100


def test_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14)) and set(SQL) <= set(QUERIES)


def test_nothing_else_imports_this_package():
    root = Path(corpus_pipeline.__file__).parent
    for p in [*root.glob("streakline/**/*.py"), *root.glob("checks/*.py"), *root.glob("tests/*.py")]:
        if "llm" not in p.relative_to(root).parts:
            assert "streakline.llm" not in p.read_text()
