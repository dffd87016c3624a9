import numpy as np
import pytest

from postalith.llm import language as la

WORDS = {"en": "the and that with this from have which were there".split(), "de": "und der die nicht für über schön größe das ist".split(), "ru": "это и не что как на для они был еще".split()}


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(0)
    rows = [(i, " ".join(rng.choice(WORDS[l], 40)), l, "clash") for i, l in enumerate(["en", "de", "ru"] * 40)]
    rows += [(900, "zzz", None, "x"), (901, None, "en", "x"), (None, "the and", "fr", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")


@pytest.fixture(scope="module")
def model(docs):
    return la.train(docs)


def test_training_learns_only_what_it_may(model):
    assert model.languages == ["de", "en", "ru"]


def test_languages_and_spans(spark, model):
    en, de = " ".join(WORDS["en"] * 6), " ".join(WORDS["de"] * 6)
    rows = [(1, en), (2, "Das ist schön und größe."), (3, "это и не"), (4, None), (5, ""), (6, "12 34 !!"), (7, f"{en} {de} {de}"), (8, f"{en} " * 8000), (1, en)]
    got = {}
    for r in la.detect(spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, score double"), model).collect():
        got[r["doc_id"]] = (r["lang_pred"], r["score"], r["spans"])
    assert [got[k][0] for k in range(1, 9)] == ["en", "de", "ru", "und", "und", "und", "de", "en"]
    assert all(0 <= got[k][1] <= 1 for k in got) and got[4][1:] == (0.0, [])
    begin, end = got[7][2][0]["begin"], got[7][2][0]["end"]
    assert (begin, end) == (0, len(en)) and [s["lang"] for s in got[7][2]] == ["en", "de"]
    assert len(got[8][2]) == 1


def test_marks_alone_are_no_letters(spark, model):
    rows = [(1, "\u0301\u0302"), (2, "12 \u0301 34"), (None, "the e\u0301 and that"), (3, "Das \u0301 ist")]
    got = {r["doc_id"]: (r["lang_pred"], r["score"], len(r["spans"])) for r in la.detect(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert got == {1: ("und", 0.0, 0), 2: ("und", 0.0, 0), None: ("en", 1.0, 1), 3: ("de", 1.0, 1)}


def test_ranges_narrow_the_candidates(model):
    text = "the schön это thö日 日本"
    _, begin, end, score = la.word_scores(model, [text])
    words = [text[a:b] for a, b in zip(begin, end)]
    left = [{x for x, v in zip(model.languages, s) if v > -la.OUT / 2} for s in score]
    # Latin words cannot be Russian, words with an umlaut not English; what no language writes leaves all
    assert dict(zip(words, left)) == {"the": {"de", "en"}, "schön": {"de"}, "это": {"ru"}, "thö日": {"de", "en", "ru"}, "日本": {"de", "en", "ru"}}


def test_rare_languages_are_learned(spark, docs):
    rare = spark.createDataFrame([(5000 + i, "ett och det som en på är av", "sv", "x") for i in range(3)], docs.schema)
    many = spark.range(20_000).selectExpr("10000 + id doc_id", "'the and that with this' text", "'en' lang", "'x' score")
    assert la.train(docs.union(rare).union(many), most=200).languages == ["de", "en", "ru", "sv"]
    assert la.train(docs.union(rare).union(many), languages=1).languages == ["en"]


def test_search_equals_brute_force():
    rng = np.random.default_rng(1)
    counts = np.array([1, 4, 6, 2])
    score = rng.normal(0, 9, (counts.sum(), 3))
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    label = la._search(score, first, counts)

    def value(path, s):
        return sum(s[i, x] for i, x in enumerate(path)) - la.SWITCH * sum(a != b for a, b in zip(path, path[1:]))

    for a, n in zip(first, counts):
        s = score[a : a + n]
        best = max(value(p, s) for p in np.stack(np.meshgrid(*[range(3)] * n), -1).reshape(-1, n))
        assert value(label[a : a + n], s) == pytest.approx(best)


def test_long_texts_in_chunks_score_alike(model, monkeypatch):
    texts = [" ".join(WORDS["en"] * 900) + "\nund der"]
    whole = la.label_words(model, texts)
    monkeypatch.setattr(la, "CHUNK", 1000)
    monkeypatch.setattr(np, "testing", np.testing)
    parts = la.label_words(model, texts)
    assert all((a == b).all() for a, b in zip(whole, parts))


def test_no_training_and_empty_tables(spark, docs):
    empty = la.train(docs.limit(0))
    assert empty.languages == [] and la.detect(docs, empty).where("lang_pred <> 'und'").count() == 0
    assert la.detect(docs.limit(0), empty).count() == 0
