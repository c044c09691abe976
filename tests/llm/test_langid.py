import random
import zlib

import numpy as np
import pytest
from pyspark.sql import types as T

from bureauframe.llm import langid
from bureauframe.llm.common import table

SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
     T.StructField("lang", T.StringType()), T.StructField("score", T.StringType()),
     T.StructField("found", T.StringType())]
)


def plain_grams(text):
    text = "".join(c if c.isalpha() else "\0" for c in text.lower())
    text = "\0" + text + "\0" * 4
    found = [text[i : i + 4] for i in range(len(text) - 3)]
    one = [g[0] == g[2] == "\0" != g[1] for g in found]
    return [g[:3] if o else g for g, o in zip(found, one, strict=True) if o or "\0" not in g[1:3]]


def test_grams_of_a_batch():
    texts = ["", "the cat", "a", "a b c", "é", "x1y", "語", "Ça va, ÉTÉ!", "12 34", "x" * 9, "İstanbul"]
    hashes, sizes = langid.grams(texts)
    assert sizes.tolist() == [len(plain_grams(t)) for t in texts]
    alone = [langid.grams([t])[0] for t in texts]
    assert np.array_equal(hashes, np.concatenate(alone))
    names = {}
    for text, own in zip(texts, alone, strict=True):
        for gram, value in zip(plain_grams(text), own.tolist(), strict=True):
            assert names.setdefault(gram, value) == value


@pytest.fixture(scope="module")
def filters(spark):
    return langid.learn(table(spark, "/root/testdata/sf0.01", "documents"))


def test_held_out_accuracy(spark, filters):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    found = langid.identify(docs, filters).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    rows = found.collect()
    assert len(rows) > 200
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_any_letter_has_a_label(spark, filters):
    """One-letter words, single ideographs and letters no language knows."""
    texts = ["a b c", "I", "é", "語", "1 x 2", "ß.", "Ж", "ѩѩѩѩ"]
    names, scores = filters.predict(texts)
    assert set(names) <= set(filters.languages) and all(0 <= s <= 1 for s in scores)
    assert filters.predict(["1 2", "", None, "_-"])[0] == ["und"] * 4


def test_filters_and_decision_against_exact_sets(spark):
    """The same rule with plain sets: what an n-gram filter holds, and the language with most."""
    rng = random.Random(5)
    alphabet = {"aa": "abcde", "bb": "cdefg", "cc": "fghij"}
    rows = [
        (i, " ".join("".join(rng.choice(alphabet[lang]) for _ in range(rng.randint(1, 6))) for _ in range(30)), lang, "", "")
        for i in range(150)
        for lang in [rng.choice(list(alphabet))]
    ]
    learned = langid.learn(spark.createDataFrame(rows, SCHEMA))
    train = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2]
    docs = {name: [set(plain_grams(t)) for _, t, lang, *_ in train if lang == name] for name in alphabet}
    share = {
        name: {g: sum(g in d for d in own) / max(len(own), langid.FEW_DOCS) for g in set().union(*own)}
        for name, own in docs.items()
    }
    held = {
        name: {
            g for g, x in own.items()
            if sum(g in d for d in docs[name]) >= langid.MIN_DOCS
            and x >= langid.OWN_SHARE * max(s.get(g, 0) for s in share.values())
        }
        for name, own in share.items()
    }
    for _, text, *_ in rows:
        found = plain_grams(text)
        exact = {name: sum(g in own for g in found) for name, own in held.items()}
        counts, sizes = learned.counts([text])
        assert sizes[0] == len(found)
        assert all(abs(c - exact[n]) <= 1 for n, c in zip(learned.languages, counts[0], strict=True))
        (name,), (score,) = learned.predict([text])
        assert exact[name] >= max(exact.values()) - 2 and abs(score - exact[name] / len(found)) < 0.05


def test_odd_rows(spark, filters):
    rows = [(1, None, "en", "", ""), (2, "", "", "", ""), (3, "123 !!! \n", None, "", ""),
            (None, "the and of that with this", "fr", "", ""), (4, "le de que la pour dans " * 20_000, "fr", "", ""),
            (4, "le de que la pour dans", "x", "", "")]
    got = {(r.doc_id, r.lang_pred) for r in langid.identify(spark.createDataFrame(rows, SCHEMA), filters).collect()}
    assert got == {(1, "und"), (2, "und"), (3, "und"), (None, "en"), (4, "fr")}
    nothing = langid.learn(spark.createDataFrame([], SCHEMA))
    assert nothing.predict(["some text"]) == (["und"], [0.0])


def test_false_positives_are_corrected():
    rng = random.Random(4)
    masks = np.zeros((1, langid.SLOTS), np.uint64)
    fill = np.random.default_rng(4).random(langid.SLOTS) < 0.5
    masks[0, fill] |= np.uint64(1)
    chance = np.array([fill.mean() ** langid.HASHES, 0.0])
    filters = langid.Filters(("aa", "bb"), masks, chance)
    text = " ".join("".join(rng.choices("abcdefghijklmnop", k=8)) for _ in range(4000))
    counts, sizes = filters.counts([text])
    assert counts[0, 0] < 0.02 * sizes[0]


def test_more_than_64_languages():
    masks = np.zeros((2, langid.SLOTS), np.uint64)
    hashes, _ = langid.grams(["hello world"])
    for i in range(langid.HASHES):
        masks[1, (hashes >> np.uint64(20 * i) & np.uint64(langid.SLOTS - 1)).astype(int)] |= np.uint64(4)
    filters = langid.Filters(tuple(f"l{k:02d}" for k in range(70)), masks, np.zeros(70))
    assert filters.predict(["hello world"])[0] == ["l66"]


def test_rare_and_many_languages_are_learned(spark):
    # 300 languages, each with words of its own; the last two have one training document only.
    rng = random.Random(11)
    rows, held, doc = [], {}, 0
    for k in range(300):
        lexicon = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=8)) for _ in range(6)]
        wanted = 1 if k >= 298 else 4
        while wanted:
            doc += 1
            text = " ".join(rng.sample(lexicon, 6))
            if zlib.crc32(str(doc).encode()) % 4 != 2:
                rows.append((doc, text, f"l{k:03}", "", ""))
                wanted -= 1
        held[f"l{k:03}"] = " ".join(reversed(lexicon))
    filters = langid.learn(spark.createDataFrame(rows, SCHEMA))
    assert len(filters.languages) == 300 and filters.masks.shape[0] == 5
    names, _ = filters.predict(list(held.values()))
    assert names == list(held)
