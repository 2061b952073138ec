import zlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from conftest import SF
from samples import docs, nothing, plain, shares, spaced  # noqa: F401
from test_decontamination import brute as contaminated
from test_ngram_join import brute as classes
from tidemark.llm import language
from tidemark.llm.folders import written
from tidemark.llm.queries import held_out, tokenizer_path


def test_each_stage_against_brute_force(spark):
    """Every stage on what the one before has kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, benchmark = docs.columns, [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), "stage")
        kept.append(docs.collect())
    raw, spoken, single, clean, mixed, files = kept
    model = language.fit(spark.read.parquet(f"{SF}/documents.parquet").where(~held_out("doc_id", 4, 2)))
    believed = language.predict(spark.read.parquet(f"{SF}/documents.parquet"), model).where("score >= 0.4 AND lang_pred <> 'und'")
    assert {r.doc_id for r in spoken} == {r.doc_id for r in believed.collect()} and len(spoken) > 0.95 * len(raw)
    assert {r.doc_id for r in single} == {c for _, n, c in classes([(r.doc_id, r.text) for r in spoken])}
    assert {r.doc_id for r in clean} == {i for i, _, hit, _ in contaminated([(r.doc_id, r.text) for r in single], benchmark) if not hit}
    sizes = {}
    for r in clean:
        sizes[r.source] = sizes.get(r.source, 0) + len(spaced(r.text))
    order = sorted(sizes)
    for source, target in zip(order, shares([sizes[s] for s in order])):
        mine = [len(spaced(r.text)) for r in mixed if r.source == source]
        assert abs(sum(mine) - target) <= max(len(spaced(r.text)) for r in clean if r.source == source)
    assert all(list(r.asDict()) == columns for r in mixed)
    tokenizer = Tokenizer.from_file(tokenizer_path())
    crc = lambda text: zlib.crc32(np.array(tokenizer.encode(text, add_special_tokens=False).ids + [2], "<u4").tobytes())
    assert sorted((r.doc_id, r.ids_crc32) for r in files) == sorted((r.doc_id, crc(r.text)) for r in mixed)
    assert plain("x") == ["x"]


def test_rows_that_break_things(spark, docs):
    """All stages but those that need labels keep columns and count on odd rows."""
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = written(stage(spark, docs, SF), "stage")
        assert "row" in docs.columns and docs.count() > 0
    assert corpus_pipeline.STAGES[4][1](spark, docs, SF).count() == docs.count()


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert set(out.columns) >= {"doc_id", "start", "n_tokens", "ids_crc32"} and out.count() > 100


def test_empty_tables(spark, nothing):
    """Every stage on a table without rows keeps its columns."""
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = written(stage(spark, nothing, SF), "stage")
        assert out.columns == nothing.columns and out.count() == 0
    assert corpus_pipeline.STAGES[4][1](spark, nothing, SF).count() == 0
