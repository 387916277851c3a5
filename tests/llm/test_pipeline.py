import zlib

import numpy as np
import public_tokenizers
import pytest
from test_near import least_labels, slow_fingerprint
from test_text_ops import slow_lines
from tokenizers import Tokenizer

import corpus_pipeline
from goldenrec.llm import importance as I

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def expected(llm_spark):
    """The pipeline without Spark's operators, but for the classifier's sample,
    which test_text_ops checks against plain counts."""
    docs, labels = (llm_spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    kept = {r["doc_id"] for r in I.classify(docs, labels).collect() if r["kept"]}
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] in kept}
    texts = {k: x[2] for k, x in slow_lines(texts).items()}
    ids = sorted(texts)
    fps = [slow_fingerprint(texts[k]) for k in ids]
    label = least_labels(len(ids), [(a, b) for a in range(len(ids)) for b in range(a) if bin(fps[a] ^ fps[b]).count("1") <= 2])
    return {ids[k]: texts[ids[k]] for k in set(label)}


def test_run_equals_a_plain_version(llm_spark, expected):
    rows = corpus_pipeline.run(llm_spark, SF).collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {k: [*library.encode(t, add_special_tokens=False).ids, 1] for k, t in expected.items()}
    assert {r["doc_id"] for r in rows} == set(ids)
    got = {}
    for r in rows:
        own = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(own, "<u4").tobytes())
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == {k: len(v) for k, v in ids.items()}


def test_junk_goes_and_clean_documents_stay(llm_spark):
    docs = llm_spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = corpus_pipeline.quality(llm_spark, docs, "/root/testdata/sf0.01")
    labels = llm_spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    good, bad = (labels.filter(f"quality = {q}") for q in (1, 0))
    assert kept.join(good, "doc_id", "left_semi").count() == good.join(docs, "doc_id", "left_semi").count()
    assert kept.join(bad, "doc_id", "left_semi").count() <= 0.1 * bad.count()


def test_stages_return_documents(llm_spark):
    docs = llm_spark.read.parquet(f"{SF}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "SimHash near-dedup", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(llm_spark, docs, SF)
        assert found.columns == docs.columns
        assert stage(llm_spark, docs.limit(0), SF).count() == 0
    cut = corpus_pipeline.lines(llm_spark, docs, SF)
    assert cut.filter("n_chars <> length(text)").count() == 0


def test_native_operators_have_no_python(llm_spark):
    import __spark_entry__ as entry

    for name in ("op5_line_dedup", "op8_chat_formatting", "op9_license_scans"):
        plan = entry.queries()[name](llm_spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
