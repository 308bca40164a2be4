"""The pipeline against its stages done one by one in plain Python, and its edge cases."""

import collections
import hashlib

import corpus_pipeline
from snapgate.llm import common, mixing, queries
from tests.llm.test_operators import ODD, SF, brute_components, brute_simhash, frame, spans_of


def test_pipeline_equals_its_stages(spark):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer())
    docs = common.table(spark, SF, "documents")
    rows = {r.doc_id: r.text for r in docs.collect()}
    bad = {r.doc_id for r in queries.op4_toxicity(spark, SF).collect() if r.predicted}
    rows = {k: t for k, t in rows.items() if k not in bad}
    ids = sorted(rows)
    keep = set(brute_components([brute_simhash(rows[i]) for i in ids], ids))
    clean = {}
    for k in keep:
        text, at, out = rows[k], 0, []
        for a, _, b, _ in spans_of(text):
            if a >= at:
                out += [text[at:a], "[secret]"]
            at = max(at, b)
        clean[k] = "".join(out) + text[at:]
    kept = docs.where(docs.doc_id.isin(list(clean))).drop("text").join(
        spark.createDataFrame(list(clean.items()), "doc_id long, text string"), "doc_id")
    picked = {r.doc_id for r in mixing.mix_sources(kept).collect() if r.sampled}
    want = {k: hashlib.sha256(",".join(map(str, sp.encode(clean[k]))).encode()).hexdigest() for k in picked}
    got = {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want


def test_stages_keep_the_columns_and_bear_odd_rows(spark):
    docs = frame(spark, ODD)
    for name, stage in corpus_pipeline.STAGES:
        for rows in (docs, docs.where("false")):
            out = stage(spark, rows, SF)
            out.write.format("noop").mode("overwrite").save()
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns, name


def test_filters_leave_clean_documents_alone(spark):
    clean = [(i, f"quiet words about item {i} and {i * 7} things of {i * 31}") for i in range(30)]
    rows = frame(spark, clean)
    for stage in (corpus_pipeline.drop_toxic, corpus_pipeline.drop_near_duplicates, corpus_pipeline.redact_secrets):
        assert collections.Counter((r.doc_id, r.text) for r in stage(spark, rows, SF).collect()) == collections.Counter(clean), stage
