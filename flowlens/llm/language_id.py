"""Language identification by word-first backoff.

A text is lower-cased and cut into words, its runs of letters (Unicode's letter categories; a
run of more than ``LONGEST_WORD`` letters counts as consecutive words of that many).  A word
that the model knows scores, for each language, the log of its smoothed share of the language's
words.  An unseen word, with a mark at either end, falls back to its character n-grams: those
of ``LONGEST_GRAM`` characters that the model knows score by the mean of their log shares; if it
knows none, the n-grams shorter by one are tried, down to single characters; a word with no
known character says nothing.  A text's score for a language is the log share of the language's
documents plus the sum over its words; the prediction is the best language (ties: the first by
name) and its score the posterior.

Fitting counts all teaching rows: tasks count words by language and flush bounded tables, Spark
sums them (partial and final), and n-grams are counted from the summed words with DataFrame
functions.  The model keeps the most frequent words and n-grams, all from a count on: at most
``MODEL_ENTRIES`` of either and at most ``MODEL_CELLS`` entry-language pairs, so what is
collected and broadcast is bounded whatever the corpus.  Prediction is a map over whole texts.

Cases: a null text, or one without a letter, is ``und`` with score 0, as is every text where
nothing was learned; a text whose words say nothing gets the most frequent language; rows
without an id count as not held out but never teach; rows that repeat are counted each.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.base import id_crc, map_rows, settle, text_runs, texts

UNKNOWN = "und"
LONGEST_WORD, LONGEST_GRAM = 64, 5
MARK = " "
SMOOTHING = 0.5
MODEL_ENTRIES, MODEL_CELLS = 1 << 17, 1 << 21
FLUSH = 1 << 18
NONE = np.zeros(0, int)
FOLDS, FOLD = 4, 2

_ASCII = bytes(b | 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A else 0x20 for b in range(256))
_RUN = re.compile(r"[^\W\d_]+")             # letters, and the few other signs that count as numbers


def words_of(text: str) -> list[str]:
    """Lower-cased words of a text, with repeats, in order."""
    if text.isascii():
        found = text.encode().translate(_ASCII).decode().split()
    else:
        found = _RUN.findall(text.lower())
        if not all(map(str.isalpha, found)):
            found = [w for run in found for w in "".join(c if c.isalpha() else " " for c in run).split()]
    if found and max(map(len, found)) > LONGEST_WORD:
        found = [w[i:i + LONGEST_WORD] for w in found for i in range(0, len(w), LONGEST_WORD)]
    return found


def count_words(rows: DataFrame) -> DataFrame:
    """(lang, word, n) over rows (lang, text): word counts by language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: defaultdict[str, Counter] = defaultdict(Counter)

        def table() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([
                pa.array([lang for lang, c in seen.items() for _ in c], pa.string()),
                pa.array([w for c in seen.values() for w in c], pa.string()),
                pa.array([n for c in seen.values() for n in c.values()], pa.int64())], names=["lang", "word", "n"])
            seen.clear()
            return out

        for batch in batches:
            langs = batch.column(0).to_pylist()
            for start, _, part in text_runs(batch.column(1), 1 << 20):
                for i, text in enumerate(part):
                    seen[langs[start + i]].update(words_of(text))
                if sum(map(len, seen.values())) >= FLUSH:
                    yield table()
        yield table()

    counted = rows.select("lang", "text").mapInArrow(run, "lang string, word string, n bigint")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def count_grams(words: DataFrame) -> DataFrame:
    """(lang, gram, n): the n-grams of the marked words, of 1 to ``LONGEST_GRAM`` characters."""
    marked = F.concat(F.lit(MARK), F.col("word"), F.lit(MARK))
    grams = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(LONGEST_GRAM)), lambda k: F.transform(
        F.when(F.length("m") >= k, F.sequence(F.lit(1), F.length("m") - k + 1)).otherwise(F.array().cast("array<int>")),
        lambda i: F.substring("m", i, k))))
    return (words.select("lang", "n", marked.alias("m")).select("lang", "n", F.explode(grams).alias("gram"))
            .where(F.col("gram") != MARK).groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def most_frequent(counts: DataFrame, key: str, languages: list[str], entries: int) -> tuple[list[str], np.ndarray]:
    """Keys of the highest totals, and their counts by language: all those from a total on, as
    low a one as leaves at most ``entries`` keys.  Totals are compared by their first ten bits,
    so that the table of totals is small at any size and nothing is sorted."""
    by = counts.groupBy(key).agg(F.sum("n").alias("total"), F.collect_list(F.struct("lang", "n")).alias("by"))
    cut = F.greatest(F.length(F.bin("total")) - 10, F.lit(0))
    rounded = F.call_function("shiftleft", F.call_function("shiftright", F.col("total"), cut), cut)
    sizes = {r["t"]: r["count"] for r in by.groupBy(rounded.alias("t")).count().collect()}
    least, kept = None, 0
    for t in sorted(sizes, reverse=True):
        kept += sizes[t]
        if kept > entries:
            break
        least = t
    if least is None:
        return [], np.zeros((0, len(languages)))
    found = by.where(F.col("total") >= least).select(key, "by").toArrow().sort_by(key)
    lists = found["by"].combine_chunks()
    out = np.zeros((len(found), len(languages)))
    row = np.repeat(np.arange(len(found)), pc.list_value_length(lists).to_numpy())
    pairs = lists.flatten()
    out[row, pc.index_in(pairs.field("lang"), value_set=pa.array(languages)).to_numpy()] = pairs.field("n").to_numpy()
    return found[key].to_pylist(), out


@dataclass
class Model:
    languages: list[str]
    prior: np.ndarray
    words: dict[str, int]
    grams: dict[str, int]
    word_scores: np.ndarray
    gram_scores: np.ndarray

    def known_grams(self, word: str) -> list[int]:
        """Places of the longest known n-grams of a word."""
        marked = MARK + word + MARK
        for n in range(LONGEST_GRAM, 0, -1):
            known = [g for g in map(self.grams.get, [marked[i:i + n] for i in range(len(marked) - n + 1)]) if g is not None]
            if known:
                return known
        return []

    def predict(self, text: str) -> tuple[str, float]:
        found = Counter(words_of(text))
        if not found or not self.languages:
            return UNKNOWN, 0.0
        words, n, grams, shares = [], [], [], []
        for word, times in found.items():
            at = self.words.get(word)
            if at is not None:
                words.append(at)
                n.append(times)
            elif known := self.known_grams(word):
                grams += known
                shares += [times / len(known)] * len(known)
        z = self.prior + np.array(n, float) @ self.word_scores[words or NONE] + np.array(shares, float) @ self.gram_scores[grams or NONE]
        best = int(np.argmax(z))
        return self.languages[best], float(1 / np.exp(z - z[best]).sum())


def log_shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    return np.log((counts + SMOOTHING) / (totals + SMOOTHING * (len(counts) + 1)))


def fit(docs: DataFrame, teaches: Column, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        entries: int = MODEL_ENTRIES) -> Model:
    """Learn from the rows that satisfy ``teaches`` (a condition on doc_id) and have a language."""
    rows = texts(docs, id_col, text_col, docs[lang_col].cast("string").alias("lang")).where(teaches & F.col("lang").isNotNull())
    shares = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    names = sorted(shares)
    if not names:
        return Model([], np.zeros(0), {}, {}, np.zeros((0, 0)), np.zeros((0, 0)))
    languages = {lang: i for i, lang in enumerate(names)}
    entries = max(1, min(entries, MODEL_CELLS // len(names)))
    words = settle(count_words(rows))                       # read three times
    totals = np.zeros(len(names))
    for r in words.groupBy("lang").agg(F.sum("n").alias("n")).collect():
        totals[languages[r["lang"]]] = r["n"]
    known, counts = most_frequent(words, "word", names, entries)
    grams, gram_counts = most_frequent(count_grams(words), "gram", names, entries)
    size = np.array([len(g) for g in grams], int)
    gram_scores = np.zeros(gram_counts.shape)
    for n in range(1, LONGEST_GRAM + 1):
        own = gram_counts[size == n]
        gram_scores[size == n] = log_shares(own, own.sum(axis=0))
    prior = np.log(np.array([shares[lang] for lang in names]) / sum(shares.values()))
    return Model(names, prior, {w: i for i, w in enumerate(known)}, {g: i for i, g in enumerate(grams)},
                 log_shares(counts, totals), gram_scores)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row's whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        one = shared.value.predict
        return lambda part: list(zip(*map(one, part)))

    return map_rows(texts(docs, id_col, text_col), "lang_pred string, score double", make)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(id_crc(doc_id) % FOLDS == FOLD, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): learned from the rows that are not held out."""
    model = fit(docs, F.col("doc_id").isNotNull() & ~held_out())
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
