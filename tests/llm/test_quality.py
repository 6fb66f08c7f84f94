import numpy as np
import pytest
from pyspark.sql import functions as F

from retourlens.llm import quality
from tests.llm.helpers import documents, prose


def test_flattened_trees_equal_a_walk():
    rng = np.random.default_rng(2)
    rows = rng.normal(size=(400, 5))
    labels = (rows[:, 0] * rows[:, 1] > 0).astype(float)
    forest = quality.fit_trees(rows, labels, trees=30, depth=3)
    for row, score in zip(rows[:50], forest.score(rows[:50])):
        margin = forest.start
        for feature, limit, value in zip(forest.feature, forest.limit, forest.value):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + int(row[feature[node]] > limit[node])
            margin += value[node - len(feature)]
        assert score == pytest.approx(1 / (1 + np.exp(-margin)))
    assert ((forest.score(rows) >= 0.5) == labels).mean() > 0.95


def test_one_class_and_no_rows():
    assert quality.fit_trees(np.zeros((0, 3)), np.zeros(0)).score(np.zeros((2, 3))).tolist() == [0.5, 0.5]
    assert (quality.fit_trees(np.zeros((9, 3)), np.ones(9)).score(np.zeros((2, 3))) > 0.99).all()


def test_statistics_of_odd_texts():
    for text in ("", " ", "\n\n", "a", "!!!", "퟿" * 5, "word " * 100_000):
        found = quality.statistics(text)
        assert found.shape == (len(quality.STATISTICS),) and np.isfinite(found).all()


def test_held_out_texts(spark):
    good = [prose(i, 50, 5000) for i in range(120)]
    bad = ["!! ".join(["BUY"] * (10 + i)) for i in range(120)]
    docs = documents(spark, good + bad)
    labelled = docs.withColumn("quality", F.when(F.col("doc_id") % 10 == 9, None).otherwise((F.col("doc_id") < 120).cast("int")))
    forest = quality.fit(labelled.where("doc_id % 2 = 0"))
    found = quality.score(docs.where("doc_id % 2 = 1"), forest).collect()
    assert all(r["predicted"] == (r["doc_id"] < 120) == (r["score"] >= 0.5) for r in found)
    again = quality.fit(labelled.where("doc_id % 2 = 0").repartition(5))
    assert (again.value == forest.value).all() and (again.limit == forest.limit).all()


def test_nulls_repeats_clashes_and_empty_tables(spark):
    docs = documents(spark, [None, "", "same", "same"]).withColumnRenamed("source", "score").withColumnRenamed("lang", "statistics")
    forest = quality.fit(docs.withColumn("quality", F.lit(None).cast("int")))
    found = quality.score(docs, forest)
    assert found.columns == ["doc_id", "text", "statistics", "n_chars", "score", "predicted"]
    assert [r["score"] for r in found.collect()] == [0.5] * 4
    assert quality.score(documents(spark, []), forest).count() == 0


def test_copies_do_not_fill_the_sample(spark, monkeypatch):
    """Copies are one row with the mean of their labels, so a text of half of all rows leaves the bound as it is."""
    seen = []
    monkeypatch.setattr(quality, "fit_trees", lambda rows, labels, **_: seen.append((len(rows), sorted(labels))))
    texts = [prose(i, 20, 5000) for i in range(400)]
    docs = documents(spark, texts + texts[:4] * 100).withColumn("quality", (F.col("doc_id") % 8 < 3).cast("int"))
    quality.fit(docs, fit_rows=60)
    assert 25 <= seen[0][0] <= 110
    same = documents(spark, ["one text"] * 40 + [None, ""]).withColumn("quality", (F.col("doc_id") % 4 == 0).cast("int"))
    quality.fit(same, fit_rows=60)
    assert seen[1] == (2, [0.25, 0.5])


def test_labels_of_a_table_of_their_own(spark, monkeypatch):
    """The same rows are fitted on as if labels had been joined to the texts; no shuffle carries texts to their labels."""
    seen, stored = [], []
    monkeypatch.setattr(quality, "fit_trees", lambda rows, labels, **_: seen.append((rows.tolist(), labels.tolist())))
    own = quality.settle
    monkeypatch.setattr(quality, "settle", lambda df, name: stored.append(df.columns) or own(df, name))
    texts = [prose(i % 90, 20, 5000) for i in range(200)] + [None, "", ""]
    docs = documents(spark, texts).union(documents(spark, texts).where("doc_id < 9"))
    marks = [(i, i % 2 if i % 7 else None) for i in range(0, 203, 2)] + [(4, 1), (4, 0), (10**6, 1), (None, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    for rows_ in (1000, 30):
        quality.fit(docs.join(labels, "doc_id"), fit_rows=rows_)
        quality.fit(docs.repartition(5), fit_rows=rows_, marks=labels)
    assert seen[0] == seen[1] and seen[2] == seen[3] and len(seen[2][0]) < len(seen[0][0])
    assert stored and not any("text" in columns for columns in stored)
