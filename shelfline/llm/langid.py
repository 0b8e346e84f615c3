"""Language identification: known words first, character n-grams for the others."""

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .scratch import frozen, small_or_shuffled

UNKNOWN = "und"
#: Distinct texts of a language that the model is fitted on at most, those with the lowest hashes.
FIT_TEXTS = 3_000
#: Bounds of the model: words and n-grams kept of a language, its most frequent ones.
MAX_WORDS = 15_000
MAX_GRAMS = 10_000
LONGEST_GRAM = 4
#: A language's counts are shares of their sum and so many more, so that one with few texts is not sure of them.
DAMPING = 1_000.0
#: The share of all that is unseen in a language, alike for all languages, however much of each is seen.
UNSEEN = 1e-3
_WORD = re.compile(r"[^\W\d_]+")
_CACHED_WORDS = 200_000


class Model(NamedTuple):
    """Log frequencies by language: a row of ``scores`` for each word and n-gram; ``floor`` for unseen characters."""

    langs: tuple[str, ...]
    words: dict[str, int]
    grams: dict[str, int]
    scores: np.ndarray
    floor: np.ndarray


def words_of(text: str) -> list[str]:
    """Runs of letters, lower-cased."""
    return _WORD.findall(text.lower())


def grams_of(word: str, n: int) -> list[str]:
    """The word's n-grams, with a space at both ends of the word; of one character without the spaces."""
    if n == 1:
        return list(word)
    padded = f" {word} "
    return [padded[i : i + n] for i in range(len(padded) - n + 1)] or [padded]


def _frame(lang: str, what: str, counts: Counter) -> pd.DataFrame:
    strings = {"lang": [lang] * len(counts), what: list(counts)}
    return pd.DataFrame({name: pd.Series(x, dtype=object) for name, x in strings.items()} | {"n": list(counts.values())})


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Words per language within a batch, each counted before anything is shuffled."""
    for batch in batches:
        counts: dict[str, Counter] = defaultdict(Counter)
        for text, lang in zip(batch["text"], batch["lang"]):
            counts[lang].update(words_of(text))
        for lang, words in counts.items():
            if words:
                yield _frame(lang, "word", words)


def _with_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        counts: dict[str, Counter] = defaultdict(Counter)
        for lang, word, times in zip(batch["lang"], batch["word"], batch["n"]):
            for n in range(1, LONGEST_GRAM + 1):
                for gram in grams_of(word, n):
                    counts[lang][gram] += times
        for lang, grams in counts.items():
            yield _frame(lang, "gram", grams)


def _drawn(known: DataFrame, texts: int) -> DataFrame:
    """(lang, text): of every language the ``texts`` distinct texts with the lowest hashes, or all, if it has fewer.

    Copies of a text are one hash before anything is shuffled, so neither a text nor a language that a third of the
    rows have crowds out others or fills a task: tasks send on their own lowest hashes alone.
    """
    hashed = known.withColumn("_hash", F.xxhash64("text"))
    lowest = W.partitionBy("lang").orderBy("_hash")
    hashes = hashed.groupBy("lang", "_hash").agg(F.lit(1)).select("lang", "_hash", F.row_number().over(lowest).alias("_place"))
    # So many hashes for each language, and nothing else: the texts need not be moved to meet them.
    chosen = small_or_shuffled(hashes.filter(F.col("_place") <= texts).drop("_place"), 500_000)
    return hashed.join(chosen, ["lang", "_hash"]).groupBy("lang", "_hash").agg(F.any_value("text").alias("text")).select("lang", "text")


def _most_frequent(counts: DataFrame, what: str, bound: int) -> list:
    """The ``bound`` most frequent values of every language, as rows (value, {lang: n}) with all of their counts."""
    order = W.partitionBy("lang").orderBy(F.desc("n"), what)
    kept = counts.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= bound).select(what).distinct()
    rows = counts.join(kept, what).groupBy(what).agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by_lang")).collect()
    return sorted(rows, key=lambda row: row[what])


def fit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    fit_texts: int = FIT_TEXTS,
    max_words: int = MAX_WORDS,
    max_grams: int = MAX_GRAMS,
) -> Model:
    """Fit on ``fit_texts`` distinct texts of every language, or on all of a language that has fewer.

    Counting runs on Spark; the driver gets at most ``max_words`` words and ``max_grams`` n-grams of a language. A
    language whose texts have no letters is known, but nothing speaks for it. Without any document that has a text
    and a language the model knows no language.
    """
    known = docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang")).filter("text is not null and lang is not null")
    drawn = frozen(_drawn(known, fit_texts))
    words = frozen(drawn.mapInPandas(_counted, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")))
    grams = frozen(words.mapInPandas(_with_grams, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    word_rows = _most_frequent(words, "word", max_words)
    gram_rows = _most_frequent(grams, "gram", max_grams)
    langs = tuple(sorted(row["lang"] for row in drawn.select("lang").distinct().collect()))
    place = {name: i for i, name in enumerate(langs)}

    def log_frequency(found: list) -> np.ndarray:
        counts = np.zeros((len(found), len(langs)))
        for i, row in enumerate(found):
            for name, n in row["by_lang"].items():
                counts[i, place[name]] = n
        return np.log(counts / (counts.sum(axis=0) + DAMPING) + UNSEEN / max(1, len(found)))

    tables, floor = [log_frequency(word_rows)], np.zeros(len(langs))
    index: dict[str, int] = {}
    for n in range(1, LONGEST_GRAM + 1):
        of_length = [r for r in gram_rows if len(r["gram"]) == n]
        tables.append(log_frequency(of_length))
        for row in of_length:
            index[row["gram"]] = len(word_rows) + len(index)
        if n == 1:
            floor = np.full(len(langs), np.log(UNSEEN / max(1, len(of_length))))
    return Model(langs, {r["word"]: i for i, r in enumerate(word_rows)}, index, np.concatenate(tables), floor)


class Scorer:
    """Scores texts; remembers a bounded number of words that the model does not know."""

    def __init__(self, model: Model):
        self.model = model
        self.first = len(model.scores)
        self.scores = np.concatenate([model.scores, np.zeros((_CACHED_WORDS, len(model.langs)))])
        self.seen = dict(model.words)

    def _backed_off(self, gram: str) -> np.ndarray:
        """Log frequencies of the n-gram, or the mean of those of its two parts one character shorter."""
        row = self.model.grams.get(gram)
        if row is not None:
            return self.model.scores[row]
        shorter = gram.strip() if len(gram) == 2 and " " in gram else gram
        if len(shorter) <= 1:
            row = self.model.grams.get(shorter)
            return self.model.floor if row is None else self.model.scores[row]
        return (self._backed_off(shorter[:-1]) + self._backed_off(shorter[1:])) / 2

    def word(self, word: str) -> np.ndarray:
        # Added one by one: a mean over a list of such short arrays takes numpy several times as long.
        found = [self._backed_off(g[:LONGEST_GRAM]) for g in grams_of(word, LONGEST_GRAM)]
        return sum(found[1:], found[0]) / len(found)

    def row(self, word: str) -> int:
        row = self.seen.get(word)
        if row is None:
            if len(self.seen) - len(self.model.words) >= _CACHED_WORDS:
                self.seen = dict(self.model.words)
            row = self.seen[word] = self.first + len(self.seen) - len(self.model.words)
            self.scores[row] = self.word(word)
        return row

    def text(self, text: str | None) -> tuple[str, float]:
        words = words_of(text) if text else []
        if not self.model.langs or not any(c.isalpha() for w in words for c in w):
            return UNKNOWN, 0.0
        counts = Counter(words)
        # Some thousand words at a time, so that the words remembered are still there when they are added up.
        total, items = np.zeros(len(self.model.langs)), list(counts.items())
        for start in range(0, len(items), 5000):
            part = items[start : start + 5000]
            if len(self.seen) - len(self.model.words) + len(part) > _CACHED_WORDS:
                self.seen = dict(self.model.words)
            total += np.array([n for _, n in part], dtype=float) @ self.scores[[self.row(w) for w, _ in part]]
        best = int(total.argmax())
        return self.model.langs[best], float(1 / np.exp(total - total[best]).sum())


def predicted(spark, model: Model, text: Column) -> Column:
    """struct(lang, score) of a text: the most likely language and its posterior with equal priors.

    ``und`` with score 0 for a null text, one without a letter, and where the model knows no language; of
    equally likely languages the first by name.
    """
    shared = spark.sparkContext.broadcast(tuple(model))
    ready: list[Scorer] = []

    @F.pandas_udf("lang string, score double")
    def run(texts: pd.Series) -> pd.DataFrame:
        if not ready:
            ready.append(Scorer(Model(*shared.value)))
        return pd.DataFrame([ready[0].text(t) for t in texts], columns=["lang", "score"])

    return run(text)


def identify_languages(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score; columns of those names are replaced. Other columns are not looked at.

    Every whole text is scored: a known word by its log frequency in each language, any other by its
    character n-grams, each of which falls back to shorter ones until it is known. Repeated rows come out
    each; an empty table gives no rows.
    """
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    rows = docs.withColumn("_found", predicted(docs.sparkSession, model, F.col(f"`{text}`")))
    return rows.select(*(F.col(f"`{c}`") for c in kept), F.col("_found.lang").alias("lang_pred"), F.col("_found.score").alias("score"))
