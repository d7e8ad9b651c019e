import math
from collections import Counter, defaultdict
from zlib import crc32

import pytest

from flowlens.llm import language_id as li
from flowlens.llm.base import read_table
from tests.llm.conftest import SF, make_docs, rows_of


def with_langs(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", "x", 0.5) for i, t, lang in rows],
                                 "doc_id bigint, text string, lang string, source string, word string, score double")


def plain_words(text):
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    return [w[i:i + 64] for w in words for i in range(0, len(w), 64)]


def plain(rows):
    """{row: (lang_pred, score)} by the docstring, one text at a time, without any bound."""
    teach = [(lang, plain_words(t)) for i, t, lang in rows if i is not None and lang is not None and crc32(str(i).encode()) % 4 != 2]
    langs = sorted({lang for lang, _ in teach})
    count = {lang: Counter(w for x, ws in teach if x == lang for w in ws) for lang in langs}
    vocabulary = {w for c in count.values() for w in c}
    grams = {lang: defaultdict(Counter) for lang in langs}
    for lang, c in count.items():
        for w, n in c.items():
            m = f" {w} "
            for k in range(1, 6):
                for i in range(len(m) - k + 1):
                    if m[i:i + k] != " ":
                        grams[lang][k][m[i:i + k]] += n
    every = {k: {g for lang in langs for g in grams[lang][k]} for k in range(1, 6)}

    def share(n, total, size):
        return math.log((n + 0.5) / (total + 0.5 * (size + 1)))

    def word(w, lang):
        if w in vocabulary:
            return share(count[lang][w], sum(count[lang].values()), len(vocabulary))
        m = f" {w} "
        for k in range(5, 0, -1):
            known = [m[i:i + k] for i in range(len(m) - k + 1) if m[i:i + k] in every[k]]
            if known:
                return sum(share(grams[lang][k][g], sum(grams[lang][k].values()), len(every[k])) for g in known) / len(known)
        return 0.0

    out = []
    for i, t, _ in rows:
        ws = plain_words(t)
        if not ws or not langs:
            out.append((i, "und", 0.0))
            continue
        z = {lang: math.log(sum(x == lang for x, _ in teach) / len(teach)) + sum(word(w, lang) for w in ws) for lang in langs}
        best = max(langs, key=lambda lang: (z[lang], [-ord(c) for c in lang]))
        out.append((i, best, 1 / sum(math.exp(z[lang] - z[best]) for lang in langs)))
    return out


@pytest.fixture(scope="module")
def small(spark):
    docs = read_table(spark, SF, "documents").select("doc_id", "text", "lang").orderBy("doc_id").collect()
    odd = [(9001, None, "en"), (9002, "", "fr"), (9003, "12 34 ½ ²", "en"), (9004, "漢字漢字", None), (None, "the one without", "en"),
           (9005, "Zzqx " * 50, None), (9006, "x" * 1000, None), (9007, "İstanbul ǅ K", "xx"), (9008, "the and of", None)]
    return [(r["doc_id"], r["text"], r["lang"]) for r in docs[:60]] + odd + [odd[7], odd[8]]


def test_equals_the_plain_version(spark, small):
    found = li.identify(with_langs(spark, small))
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    key = lambda r: (repr(r[0]), r[1], round(r[-1], 6))
    got = sorted(((r["doc_id"], r["lang_pred"], r["score"]) for r in found.collect()), key=key)
    want = sorted(plain(small), key=key)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert all(abs(a[2] - b[2]) < 1e-6 and 0 <= a[2] <= 1 for a, b in zip(got, want))
    for r in found.collect():
        assert r["held_out"] == (r["doc_id"] is not None and crc32(str(r["doc_id"]).encode()) % 4 == 2)


def test_held_out_accuracy(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    rows = li.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.99 * len(rows)


def test_held_out_rows_languages_and_ids_do_not_matter(spark, small):
    held = {i for i, _, _ in small if i is not None and crc32(str(i).encode()) % 4 == 2}
    changed = [(i, t, "zz" if i in held else lang) for i, t, lang in small]
    assert rows_of(li.identify(with_langs(spark, small))) == rows_of(li.identify(with_langs(spark, changed)))


def test_a_bounded_model_backs_off(spark, small):
    docs = with_langs(spark, small)
    teaches = ~li.held_out() & docs["doc_id"].isNotNull()
    model = li.fit(docs, teaches, entries=300)
    assert 0 < len(model.words) <= 300 and 0 < len(model.grams) <= 300
    counts = Counter(w for i, t, lang in small if i is not None and lang and crc32(str(i).encode()) % 4 != 2 for w in plain_words(t))
    least = min(n for n in counts.values() if sum(x >= n for x in counts.values()) <= 300)
    assert set(model.words) == {w for w, n in counts.items() if n >= least}
    rows = li.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where("lang in ('en', 'fr', 'de', 'es') and lang_pred <> 'und'").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) > 0.9 * len(rows)


def test_one_language_in_all_rows_and_none(spark, no_docs):
    assert li.identify(no_docs).count() == 0
    docs = with_langs(spark, [(i, "one two", None) for i in range(10)])
    assert {(r["lang_pred"], r["score"]) for r in li.identify(docs).collect()} == {("und", 0.0)}
    alone = li.identify(with_langs(spark, [(i, "one two", "en") for i in range(10)] + [(50, "漢", None)]))
    assert {(r["lang_pred"], r["score"]) for r in alone.collect()} == {("en", 1.0)}


def test_words_of():
    assert li.words_of("It's A4 ½ naïve x²y") == ["it", "s", "a", "naïve", "x", "y"]
    assert [len(w) for w in li.words_of("q" * 130)] == [64, 64, 2]
