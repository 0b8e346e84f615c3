import random

import numpy as np
import pytest

from shelfline.llm.langid import Scorer, _drawn, fit, grams_of, identify_languages
from shelfline.llm.queries import is_held_out

SCHEMA = "doc_id long, text string, lang string"


def sentences(seed, n=400):
    draw = random.Random(seed)
    stems = {"xx": ["ka", "lo", "mi", "ne"], "yy": ["schu", "berg", "tzt", "ö"], "zz": ["ción", "ado", "ñe", "qu"]}
    rows = []
    for i in range(n):
        lang = draw.choice(list(stems))
        words = ["".join(draw.choice(stems[lang]) for _ in range(draw.randrange(1, 4))) for _ in range(draw.randrange(3, 30))]
        rows.append((i, " ".join(words).capitalize() + ".", lang))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    return fit(spark.createDataFrame([*sentences(1), (1000, None, "xx"), (1001, "ka", None)], SCHEMA))


def test_unseen_documents(spark, model):
    rows = sentences(2)
    found = identify_languages(spark.createDataFrame(rows, SCHEMA), model).collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.99
    assert all(0 <= r.score <= 1 for r in found)


def test_word_first_then_shorter_grams(model):
    """Brute force of the definition: word frequency if known, else the mean of backed-off n-grams."""
    scorer = Scorer(model)

    def gram(g):
        if g in model.grams:
            return model.scores[model.grams[g]]
        bare = g.strip() if len(g) == 2 else g
        if len(bare) <= 1:
            return model.scores[model.grams[bare]] if bare in model.grams else model.floor
        return (gram(bare[:-1]) + gram(bare[1:])) / 2

    for text in ("Kalo kaloschu bergmi", "ÖÖÖ! xyzw kaka", "q", "漢字 ka", "ción ciónqw ñ"):
        total = np.zeros(len(model.langs))
        for w in text.lower().replace("!", "").split():
            total += model.scores[model.words[w]] if w in model.words else np.mean([gram(g) for g in grams_of(w, 4)], axis=0)
        lang, score = scorer.text(text)
        assert lang == model.langs[int(total.argmax())]
        assert score == pytest.approx(np.exp(total.max()) / np.exp(total).sum())


def test_undetermined_and_odd_texts(spark, model):
    rows = [(1, None, "xx"), (2, "", "xx"), (3, "12 ² !!", "xx"), (4, "漢", None), (5, "kalo " * 200_000, None), (5, "kalo", "yy"), (5, "kalo", "yy")]
    df = spark.createDataFrame([(*r, "mine") for r in rows], SCHEMA + ", score string")
    found = identify_languages(df, model)
    assert found.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    found = sorted(found.collect(), key=lambda r: r.doc_id)
    assert [r.lang_pred for r in found] == ["und", "und", "und", "xx", "xx", "xx", "xx"]
    assert [r.score for r in found[:3]] == [0, 0, 0]
    assert found[3].score == pytest.approx(1 / 3)


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], SCHEMA)
    model = fit(empty)
    assert identify_languages(empty, model).collect() == []
    assert [r.lang_pred for r in identify_languages(spark.createDataFrame([(1, "ka", "xx")], SCHEMA), model).collect()] == ["und"]


def test_memory_of_words_is_bounded(model, monkeypatch):
    monkeypatch.setattr("shelfline.llm.langid._CACHED_WORDS", 6000)
    small, large = Scorer(model), " ".join(f"ka{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(9000))
    first = small.text(large)
    assert len(small.seen) - len(model.words) <= 6000
    assert small.text(large) == first
    monkeypatch.undo()
    assert Scorer(model).text(large)[0] == first[0]


def test_held_out_share_of_the_samples(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("held_out", is_held_out())
    found = identify_languages(docs, fit(docs.filter("not held_out"))).filter("held_out and lang is not null").collect()
    assert len(found) > 150
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.98


def _languages(n):
    """Languages with letters of their own shares: four of eight syllables that the next language has as well."""
    draw = random.Random(9)
    return {f"l{i:02}": ["".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(3)) for _ in range(12)] for i in range(n)}


def _text(draw, stems, words=40):
    return " ".join("".join(draw.choice(stems) for _ in range(draw.randrange(1, 4))) for _ in range(words))


def test_forty_languages_of_very_different_size(spark):
    draw, stems = random.Random(10), _languages(40)
    sizes = {lang: round(20_000 ** (i / 39)) for i, lang in enumerate(stems)}
    rows = [(0, _text(draw, stems[lang], draw.randrange(5, 30)), lang) for lang, n in sizes.items() for _ in range(n)]
    # A third of the rows are one text.
    hot = _text(draw, stems["l39"], 50)
    rows += [(0, hot, "l39")] * (len(rows) // 2)
    df = spark.createDataFrame(rows, SCHEMA).repartition(8)
    model = fit(df, fit_texts=500)
    assert model.langs == tuple(sorted(stems))
    held = [(i, _text(draw, stems[lang]), lang) for i, lang in enumerate(list(stems) * 10)]
    found = identify_languages(spark.createDataFrame(held, SCHEMA), model).collect()
    right = {lang: np.mean([r.lang_pred == lang for r in found if r.lang == lang]) for lang in stems}
    # The first languages have one to four short texts.
    assert all(share == 1 for lang, share in right.items() if sizes[lang] >= 5), right
    assert np.mean([right[lang] for lang in list(stems)[:7]]) >= 0.9, right


def test_a_language_without_frequent_words_is_known(spark):
    rows = [(i, t, "en") for i, (_, t, _) in enumerate(sentences(5, 800))] + [(1, "აბგდ ევზ", "ka"), (2, "თიკ", "ka"), (3, "12 34", "xx")]
    model = fit(spark.createDataFrame(rows, SCHEMA), max_words=50, max_grams=40)
    assert model.langs == ("en", "ka", "xx") and {"აბგდ", "თიკ"} <= set(model.words)
    found = identify_languages(spark.createDataFrame([(1, "ევზ თიკ", None), (2, "კგ", None)], SCHEMA), model).collect()
    assert [r.lang_pred for r in found] == ["ka", "ka"]


def test_texts_are_drawn_by_language_without_copies(spark):
    rows = [(0, f"text {i % 300}", "a") for i in range(3000)] + [(0, "one", "b")] * 50 + [(0, f"x{i}", "c") for i in range(9)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    drawn = [tuple(r) for r in _drawn(df, 20).collect()]
    assert len(drawn) == len(set(drawn)) == 20 + 1 + 9
    assert sorted(drawn) == sorted(tuple(r) for r in _drawn(df.repartition(3), 20).collect())


def test_names_with_dots(spark):
    df = spark.createDataFrame([(1, "ka lo", "xx")], SCHEMA).toDF("doc_id", "t.x", "l.y")
    assert [r.lang_pred for r in identify_languages(df, fit(df, "t.x", "l.y"), "t.x").collect()] == ["xx"]
