"""The pipeline against the operators' plain forms, stage by stage, and on odd input."""

import corpus_pipeline as cp
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.llm.test_secrets import brute
from tests.llm.test_simhash import plain_groups, plain_print
from tokenizers import Tokenizer
from vitals.llm import bpe, decontaminate, secret_scan


def test_stages_have_the_contract_form():
    assert [n for n, _ in cp.STAGES] == ["quality_classifier", "near_dedup", "decontamination", "secret_masking", "bpe_encoding"]


def test_run_equals_the_plain_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    kept = cp.STAGES[0][1](spark, docs, SF_SMALL)
    assert kept.columns == docs.columns
    rows = {r["doc_id"]: r for r in kept.collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    known = [i for i in labels if i in {r["doc_id"] for r in docs.select("doc_id").collect()}]
    assert sum((i in rows) == (labels[i] == 1) for i in known) / len(known) > 0.97
    prints = {i: plain_print(r["text"]) for i, r in rows.items()}
    least = plain_groups(set(prints.values()))
    first = {}
    for i in sorted(rows):
        first.setdefault(least[prints[i]], i)
    benchmark = decontaminate.Benchmark([tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()])
    library, want = Tokenizer.from_file(bpe.default_path()), {}
    for i in first.values():
        text = rows[i]["text"]
        if not any(cover >= 0.8 for _, cover, _, _ in benchmark.tiled(text)):
            want[i] = library.encode(secret_scan.masked(text, brute(text)), add_special_tokens=False).ids
    got = cp.run(spark, SF_SMALL).collect()
    assert {r["doc_id"]: r["ids"] for r in got} == want and len(got) == len(want)
    assert all(r["decoded"] == library.decode(r["ids"], skip_special_tokens=False) for r in got)


def test_odd_rows(spark, odd_docs, empty_docs):
    docs = odd_docs.withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.char_length("text").cast("bigint")})
    for frame in (docs, empty_docs):
        for _, stage in cp.STAGES[:-1]:
            out = stage(spark, frame, SF_SMALL)
            assert out.columns == frame.columns and out.count() <= frame.count()
        assert cp.STAGES[-1][1](spark, frame, SF_SMALL).count() == frame.count()
