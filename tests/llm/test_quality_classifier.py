import os

from landledger.llm import quality_classifier as qc
from landledger.llm.queries import op1_quality_classifier

DOCS = "doc_id long, text string, score string, predicted string, label string"


def test_held_out_accuracy(spark, sf):
    folder = os.path.join(os.path.dirname(sf), "sf0.01")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    rows = op1_quality_classifier(spark, folder).where("held_out").join(labels, "doc_id").collect()
    assert len(rows) > 50
    right = sum(r.predicted == r.quality for r in rows)
    assert right / len(rows) > 0.95
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    pairs = [(g > b) + 0.5 * (g == b) for g in good for b in bad]
    assert sum(pairs) / len(pairs) > 0.97


def corpus():
    rows = []
    for i in range(60):
        rows.append((i, f"the quiet river runs past house number {i} and the old stone bridge near the mill " * 5, 1))
        rows.append((100 + i, f"### $$$ buy{i} now *** click &&& %%% cheap{i} $$$ ### " * 5, 0))
    return rows


def test_edges(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "x", "y", "z") for i, t, _ in rows] + [
        (None, "a text", "", "", ""), (900, None, "", "", ""), (901, "", "", "", ""), (902, "word " * 100_000, "", "", ""), (1, rows[2][1], "", "", ""),
    ], DOCS)
    labels = spark.createDataFrame([(i, q) for i, _, q in rows] + [(None, 1), (5, None), (7, 1), (7, 0), (900, 1)], "doc_id long, quality int")
    model = qc.fit(docs, labels)
    out = qc.classify(docs, model)
    assert out.columns == ["doc_id", "text", "score", "label", "predicted"] or set(out.columns) == set(DOCS.replace(",", "").split()[::2])
    got = out.collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r for r in got}
    assert by_id[900].score == by_id[901].score
    assert by_id[150].predicted == 0 and by_id[50].predicted == 1


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "text"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in qc.classify(docs, qc.fit(docs, none)).collect()} == {0.5}
    only = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert {r.predicted for r in qc.classify(docs, qc.fit(docs, only)).collect()} == {1}
    assert qc.classify(docs.limit(0), qc.fit(docs.limit(0), only)).count() == 0


def test_fit_ignores_row_order(spark):
    docs = spark.createDataFrame([(i, t) for i, t, _ in corpus()], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in corpus()], "doc_id long, quality int")
    assert qc.fit(docs, labels) == qc.fit(docs.repartition(5), labels.repartition(3))
