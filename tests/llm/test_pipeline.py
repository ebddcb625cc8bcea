import corpus_pipeline
from hazeline.llm import packing, quality, sentence_spans, simhash, toxicity

FOLDER = "/root/testdata/sf0.001"


def test_stages_in_order_and_columns(spark, documents):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "toxicity", "SimHash near-dedup", "substring dedup", "packing"]
    docs, kept = documents, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == documents.columns
        docs = spark.createDataFrame(docs.collect(), documents.schema)
        kept.append(docs.count())
    assert documents.count() > kept[0] >= kept[1] >= kept[2] == kept[3] > 0


def test_run_equals_the_operators_one_after_another(spark, documents, labels):
    docs = quality.selected_documents(documents, labels)
    docs = simhash.keep_first(toxicity.clean_documents(docs, labels))
    texts = {r.doc_id: r.text for r in sentence_spans.without_repeats(docs).collect()}
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    lengths = {}
    for r in rows:
        lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
        assert r.doc_tokens == len(packing.chunk_ids(packing.WORD_BPE).encode(texts[r.doc_id].encode())) + 1
    assert {r.doc_id: r.doc_tokens for r in rows} == lengths and lengths.keys() == texts.keys()


def test_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))
