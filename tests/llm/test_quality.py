"""Quality classifier: agreement with the labels it has not seen, estimation, odd rows."""

from vitals.llm import quality as q

SF = "/root/testdata/sf0.01"


def test_agreement_with_given_labels(spark):
    got = {r["doc_id"]: r["kept"] for r in q.op6_quality(spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    clean = [got[r["doc_id"]] for r in labels if r["quality"] == 1]
    junk = [got[r["doc_id"]] for r in labels if r["quality"] == 0]
    assert sum(clean) / len(clean) > 0.99 and sum(junk) / len(junk) < 0.05


def test_estimation_weighs_faults_over_their_absence():
    n = len(q.LABELLERS)
    fine, one, two = (1,) * n, (-1, *(1,) * (n - 1)), (-1, -1, *(1,) * (n - 2))
    posterior, accuracy = q.estimate([(fine, 900), (one, 60), (two, 60), ((0,) * n, 5)])
    assert posterior[fine] > 0.9 and posterior[one] < 0.5 and posterior[two] < 0.1
    assert (0,) * n not in posterior and accuracy[0] > 0.9
    assert q.estimate([]) [0] == {} and q.estimate([((0,) * n, 3)])[0] == {}


def test_runs_over_blocks(monkeypatch):
    text = "Some words, SOME more! 12 # x\n" * 40
    whole = q.measure(text, q._table())
    monkeypatch.setattr(q, "BLOCK", 7)
    parts = q.measure(text, q._table())
    assert (whole.runs == parts.runs).all() and whole.values == parts.values
    assert whole.runs.sum() == len(text) - 2


def test_odd_rows(spark, odd_docs, empty_docs):
    model = q.learned(odd_docs)
    found = q.scored(odd_docs, model, keep=["doc_id"]).collect()
    assert len(found) == odd_docs.count()
    assert all(not r["kept"] and r["score"] == 0 for r in found if r["doc_id"] in (2, 3, 4))
    left = q.filtered(odd_docs)
    assert left.columns == odd_docs.columns and left.filter("doc_id in (2, 3, 4)").count() == 0
    assert q.filtered(empty_docs).count() == 0 and q.filtered(empty_docs).columns == empty_docs.columns
