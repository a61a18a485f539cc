import zlib

import corpus_pipeline
import edge
import numpy as np
from tokenizers import Tokenizer

from imlens.llm import op1_rans, op7_quality
from imlens.llm import op5_mixing as mixing
from imlens.llm import op10_decontam as decontam

SF = "/root/testdata/sf0.001"


def _rows(df):
    return [tuple(r) for r in df.collect()]


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, held, SF)
        out.write.parquet(str(tmp_path / str(k)))
        out = spark.read.parquet(str(tmp_path / str(k)))
        before, after = _rows(held), _rows(out)
        if k < 4:
            assert out.columns == docs.columns and set(after) <= set(before)
        if k == 0:
            scores = {r["doc_id"]: r["score"] for r in op7_quality.op7_quality(spark, SF).collect()}
            assert sorted(after) == sorted(r for r in before if scores[r[0]] >= 0.7)
        if k == 1:
            first = {d: c for d, _, c in edge.linked(before, 5, 80)}
            assert sorted(after) == sorted(r for r in before if first[r[0]] == r[0])
        if k == 2:
            items = [b" " + b" ".join(r["text"].encode().translate(decontam.PLAIN).split()) + b" " for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            plain = {r[0]: b" " + b" ".join((r[1] or "").encode().translate(decontam.PLAIN).split()) + b" " for r in before}
            assert sorted(after) == sorted(r for r in before if not any(i in plain[r[0]] for i in items))
        if k == 3:
            assert sorted(r[0] for r in after) == sorted(r["doc_id"] for r in mixing.mixed_documents(held).collect())
        if k == 4:
            tok, start, want = Tokenizer.from_file(op1_rans.default_vocabulary()), 0, []
            for r in sorted(before):
                ids = np.array([*tok.encode(r[1], add_special_tokens=False).ids, 1], "<u4")
                want.append((r[0], start, len(ids), zlib.crc32(ids.tobytes())))
                start += len(ids)
            assert sorted(after) == sorted(want)
        held = out


def test_run_applies_all_stages(spark):
    got = corpus_pipeline.run(spark, SF).collect()
    assert got and set(got[0].asDict()) >= {"doc_id", "start", "n_tokens", "ids_crc32"}


def test_awkward_documents(spark, tmp_path):
    folder = edge.write_documents(spark, str(tmp_path))
    edge.write(spark, folder, "labels", [(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    edge.write(spark, folder, "benchmark", [(1, "an item of the benchmark that stands in no document at all")], "item_id long, text string")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert set(docs.columns) >= {"doc_id", "text", "lang", "source", "n_chars", "node", "block"}
    assert corpus_pipeline.run(spark, folder).count() == docs.count() > 0


def test_empty_documents(spark, tmp_path):
    folder = edge.write_documents(spark, str(tmp_path), [])
    edge.write(spark, folder, "labels", [], "doc_id long, quality int, toxic int")
    edge.write(spark, folder, "benchmark", [], "item_id long, text string")
    assert corpus_pipeline.run(spark, folder).collect() == []
