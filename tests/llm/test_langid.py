import numpy as np
import pytest

SF0001 = "/root/testdata/sf0.001"
from triplake.llm import langid


def brute_viterbi(scores, switch):
    t, k = scores.shape
    best, back = scores[0].astype(float), []
    for i in range(1, t):
        step = best[:, None] - switch * (1 - np.eye(k))
        back.append(step.argmax(0))
        best = step.max(0) + scores[i]
    path = [int(best.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1], best.max()


def path_score(path, scores, switch):
    return sum(scores[i, k] for i, k in enumerate(path)) - switch * sum(a != b for a, b in zip(path, path[1:]))


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(5)
    lengths = np.array([1, 7, 30, 2, 7])
    scores = rng.normal(0, 4, (int(lengths.sum()), 3)).astype(np.float32)
    got = np.split(langid.viterbi(scores, lengths, 5.0), np.cumsum(lengths)[:-1])
    for path, part in zip(got, np.split(scores, np.cumsum(lengths)[:-1])):
        want, best = brute_viterbi(part, 5.0)
        assert path_score(path.tolist(), part, 5.0) == pytest.approx(best, abs=1e-3)


@pytest.fixture(scope="module")
def model(spark):
    rows = []
    for i in range(40):
        rows += [(4 * i, "the cat and the dog went with the children through the forest " * 3, "en"),
                 (4 * i + 1, "der Hund und die Katze gingen mit den Kindern durch den Wald " * 3, "de"),
                 (4 * i + 3, "кошка и собака пошли с детьми через лес " * 3, "ru")]
    rows += [(9000, "ignored", None), (9001, None, "en")]
    return langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample_docs=25)


def test_spans_of_mixed_text(spark, model):
    assert model.languages == ["de", "en", "ru"]
    mixed = "the dog and the cat went with the children " * 3 + "der Hund und die Katze gingen durch den Wald " * 2
    docs = spark.createDataFrame([(1, mixed, "x"), (2, "лес и кошка", "x"), (None, None, "x"), (4, "", "x"), (5, "12 34 !!", "x"),
                                  (5, "der Wald " * 40000, "x")], "doc_id long, text string, score string")
    out = {(r.doc_id, (r.text or "")[:5]): r for r in langid.identify(docs, model).collect()}
    r = out[1, "the d"]
    assert [(s.first_word, s.lang) for s in r.spans] == [(0, "en"), (27, "de")]
    assert r.lang_pred == "en" and 0.5 < r.score < 0.7
    assert out[2, "лес и"].lang_pred == "ru" and out[2, "лес и"].score == 1.0
    for key in ((None, ""), (4, ""), (5, "12 34")):
        assert (out[key].lang_pred, out[key].score, out[key].spans) == ("und", 0.0, [])
    assert out[5, "der W"].lang_pred == "de"


def test_script_narrows(model):
    s = model.scores(["лес", "wald"])
    assert s[0, model.languages.index("en")] == -1e4 and s[1, model.languages.index("ru")] == -1e4


def test_model_of_nothing(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    r = langid.identify(docs, langid.fit(docs)).first()
    assert (r.lang_pred, r.score) == ("und", 0.0)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF0001.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "lang")
    got = langid.op8_language_id(spark, SF0001.replace("0.001", "0.01")).where("held_out").join(docs, "doc_id")
    n, right = got.selectExpr("count(*)", "count_if(lang = lang_pred)").first()
    assert n > 200 and right / n >= 0.97


def test_words_are_letters_and_their_marks():
    assert langid.words_of("½ ² ① Ⅷ 12_3 ́") == []
    assert langid.words_of("Über-x² नमस्ते, हिन्दी ét") == ["über", "x", "नमस्ते", "हिन्दी", "ét"]


def test_held_words_stay_bounded_and_change_no_label(model, monkeypatch):
    texts = ["the dog went " + " ".join(f"wald{'abcdefghij'[i % 10]}{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(97 + k)}" for k in range(20))
             for i in range(120)]
    want = [labels.tolist() for _, labels in langid.Labeller(model).each(texts)]
    monkeypatch.setattr(langid, "REMEMBERED", 100)
    monkeypatch.setattr(langid, "CHUNK_CHARS", 200)
    labeller, scored = langid.Labeller(model), []
    scores = model.scores
    monkeypatch.setattr(model, "scores", lambda words: scored.extend(words) or scores(words), raising=False)
    got = []
    for _, labels in labeller.each(texts):
        got.append(labels.tolist())
        assert len(labeller.row) == len(labeller.scores) <= 100
    assert got == want and scored.count("the") == 1
