import numpy as np
import pytest

from llm.langid import Model, _codes, identify, label, learn, viterbi, word_scores

SF = "/root/testdata/sf0.01"


def brute(scores, switch):
    n, m = scores.shape
    value, back = scores[0].astype(float), []
    for t in range(1, n):
        step = value[None, :] - switch * (1 - np.eye(m))
        back.append(step.argmax(axis=1))
        value = step.max(axis=1) + scores[t]
    return value.max()


def total(scores, path, switch):
    return scores[np.arange(len(path)), path].sum() - switch * (path[1:] != path[:-1]).sum()


@pytest.mark.parametrize("seed", range(3))
def test_viterbi_reaches_the_best_total(seed):
    rng = np.random.default_rng(seed)
    n = rng.integers(0, 30, 40)
    first = np.concatenate([[0], np.cumsum(n)])
    scores = rng.normal(0, 5, (first[-1], 4)).astype(np.float32)
    path = viterbi(scores, first, 6.0)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b > a:
            assert total(scores[a:b], path[a:b], 6.0) == pytest.approx(brute(scores[a:b], 6.0), abs=1e-3)


def test_held_out_accuracy_and_defined_results(spark, frame):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = learn(docs.where("doc_id % 5 <> 0"))
    r = identify(docs.where("doc_id % 5 = 0"), model).join(docs.select("doc_id", "lang"), "doc_id").where("lang is not null").toPandas()
    assert (r.lang_pred == r.lang).mean() > 0.95 and r.score.between(0, 1).all()
    rows = [(1, None, 0), (2, "", 0), (3, "123 !!", 0), (4, "жжж", 0), (None, "the and of the", 0), (None, "the and of the", 0), (6, "the " * 400_000, 0)]
    got = {(r.doc_id, r.lang_pred, r.score) for r in identify(frame(rows, "doc_id long, text string, score int"), model).collect()}
    assert {(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0), (6, "en", 1.0), (None, "en", 1.0)} <= got
    assert next(x for x in got if x[0] == 4)[1] in model.langs
    assert identify(spark.createDataFrame([], "doc_id long, text string"), model).count() == 0


def test_spans_of_mixed_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("lang is not null and length(text) > 600")
    model = learn(docs.where("doc_id % 5 <> 0"))
    parts = {lang: docs.where((docs.lang == lang) & (docs.doc_id % 5 == 0)).orderBy("doc_id").first().text[:500] for lang in ("en", "de")}
    text = parts["en"] + " " + parts["de"]
    _, _, spans = label(model, [text])[0]
    assert [s[2] for s in spans] == ["en", "de"] and abs(spans[1][0] - len(parts["en"])) < 30
    again = label(model, ["x", text, "", text])
    assert again[1] == again[3] == label(model, [text])[0]


def test_scripts_narrow_candidates(spark):
    rows = [("the cat and the dog", "en"), ("кот и пёс", "ru"), ("мачка и пас", "sr"), ("o gato", "pt"), (None, "xx"), ("a", None)]
    model = learn(spark.createDataFrame(rows, "text string, lang string"))
    assert model.langs == ["en", "pt", "ru", "sr"]
    codes, _ = _codes(["кот the"])
    scores = word_scores(model, codes)[3]
    assert scores[0, [2, 3]].min() > scores[0, [0, 1]].max() + 40 and scores[1, [0, 1]].min() > scores[1, [2, 3]].max() + 40


def test_nothing_learned(spark, frame):
    model = learn(spark.createDataFrame([(None, "en"), ("a", None)], "text string, lang string"))
    assert isinstance(model, Model) and label(model, ["abc", ""]) == [("und", 0.0, []), ("und", 0.0, [])]


def test_words_are_cut_at_script_changes_and_unspaced_text_into_units(spark):
    rows = [("the language of the programming and the code", "en"), ("一种广泛使用的编程语言是它", "zh"), ("ภาษาไทยและการเขียน", "th")] * 3
    model = learn(spark.createDataFrame(rows, "text string, lang string"))
    text = "the language Python是一种广泛使用的编程语言 and the code"
    spans = label(model, [text], 2.0)[0][2]
    assert [text[a:b] for a, b, lang in spans if lang == "zh"] == ["是一种广泛使用的编程语言"] and [s[2] for s in spans] == ["en", "zh", "en"]
    assert [s[2] for s in label(model, ["是Python"], 2.0)[0][2]] == ["zh", "en"]
    codes, _ = _codes(["ภาษาไทยและ"])
    starts, ends, letters, _ = word_scores(model, codes)
    assert len(starts) > 1 and starts.tolist()[1:] == ends.tolist()[:-1] and letters.sum() == sum(c.isalpha() for c in "ภาษาไทยและ")


def test_label_equals_plain_version(spark):
    """Score and prediction by units found and labelled one by one."""
    from llm import langid
    rows = [("the cat and the dog", "en"), ("кот и пёс", "ru"), ("мачка и пас", "sr"), ("o gato e o cao", "pt"), ("一种广泛使用", "zh")]
    model = learn(spark.createDataFrame(rows, "text string, lang string"))
    _, letter, word, script = langid._tables()
    for text in ("the cat и мачка", "gato 一种广泛使用 the dog", "пас a\u0301bc", "x", "12", "кот кот кот o gato"):
        codes, _ = _codes([text])
        starts, ends, letters, scores = word_scores(model, codes)
        units, i = [], 0
        while i < len(text):
            c = ord(text[i])
            if not word[c]:
                i += 1
                continue
            j = i + 1
            while j < len(text) and word[ord(text[j])] and (not letter[ord(text[j])] or script[ord(text[j])] == script[c]) and not (
                    langid.NAMES[script[c]] in langid.UNSPACED and j - i >= langid.UNIT):
                j += 1
            units.append((i, j))
            i = j
        assert list(zip(starts.tolist(), ends.tolist(), strict=True)) == units
        lang, score, _ = label(model, [text])[0]
        if units:
            best = viterbi(scores, np.array([0, len(units)]))
            most = max(total(scores, np.array(p), langid.SWITCH) for p in np.ndindex(*[len(model.langs)] * len(units)))
            assert total(scores, best, langid.SWITCH) == pytest.approx(most, abs=1e-3)
            weight = [sum(int(n) for n, p in zip(letters, best, strict=True) if p == k) for k in range(len(model.langs))]
            assert score == pytest.approx(max(weight) / sum(weight)) and lang == model.langs[weight.index(max(weight))]
        else:
            assert (lang, score) == ("und", 0.0)


def test_too_many_languages_are_an_error(spark, monkeypatch):
    from llm import langid
    monkeypatch.setattr(langid, "MAX_LANGS", 3)
    with pytest.raises(ValueError):
        learn(spark.createDataFrame([("a b", str(i)) for i in range(4)], "text string, lang string"))
