import numpy as np
import pytest

from postalith.llm import quality as q


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(0)
    words = [f"w{'abcdefghij'[i % 10] * (1 + i % 7)}" for i in range(300)]
    rows = []
    for i in range(300):
        text = " ".join(rng.choice(words, 60)) + "."
        rows.append((i, text if i % 3 else text.upper().replace(" ", "!! "), 0.5, "x"))
    rows += [(900, None, 0.5, "x"), (901, "", 0.5, "x"), (902, "word " * 200_000, 0.5, "x"), (1, rows[1][1], 0.5, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, score double, _key string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, int(i % 3 > 0), "x") for i in range(0, 300, 2)] + [(None, 1, "x"), (5, None, "x"), (7, 1, "x"), (7, 0, "x")], "doc_id long, quality int, text string")


def test_held_out_rows_are_told_apart(docs, labels):
    got = q.score(docs, q.train(docs, labels)).collect()
    odd = [r for r in got if r["doc_id"] < 300 and r["doc_id"] % 2]
    assert np.mean([r["predicted"] == int(r["doc_id"] % 3 > 0) for r in odd]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= q.THRESHOLD) for r in got)
    assert len(got) == docs.count()


def test_no_labels_one_class_and_empty_tables(docs, labels):
    constant = q.train(docs, labels.where("quality = 1"))
    assert {r["predicted"] for r in q.score(docs, constant).collect()} == {1}
    assert q.train(docs, labels.limit(0)).score(np.zeros((2, len(q.FEATURES)))).tolist() == [0.5, 0.5]
    assert q.score(docs.limit(0), constant).count() == 0


def test_pairs_explain_what_single_features_cannot():
    rng = np.random.default_rng(0)
    x = rng.random((3000, len(q.FEATURES)))
    y = ((x[:, 2] > 0.5) ^ (x[:, 5] > 0.5)).astype(float)
    model = q.fit(x[:2000], y[:2000])
    assert {model.pairs[0][0], model.pairs[0][1]} == {2, 5}
    assert ((model.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.9
