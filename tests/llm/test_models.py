"""Language model, toxicity and language identification."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillbook.llm import language, lm_scoring, queries, toxicity

WORD = re.compile("[^\x20\x09-\x0d]+")


def tokens(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + ["\0end"]


def fold(doc_id, divisor):
    return zlib.crc32(str(doc_id).encode()) % divisor


def check_base(rows, train):
    counts = Counter(w for t in train for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    return lambda text: (
        len(tokens(text)),
        sum(counts[w] > 0 for w in tokens(text)),
        n,
        sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(text)),
    )


@pytest.mark.parametrize("block", (6 << 20, 5_000))
def test_scores_have_the_base_and_beat_it(spark, sf_dir, docs, texts, block):
    model = lm_scoring.Model(block_bytes=block, range_tokens=2_000 if block < 10_000 else 1 << 21)
    rows = lm_scoring.fold_scores(docs, model).collect()
    base = check_base(rows, [t for i, t in texts.items() if fold(i, 7) != 2])
    assert len(rows) == len(texts)
    for r in rows:
        assert r["held_out"] == (fold(r["doc_id"], 7) == 2)
        want = base(texts[r["doc_id"]])
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == want[:3]
        assert r["base_score"] == pytest.approx(want[3])
        assert r["score"] < 0
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


@pytest.mark.parametrize("fan_in", (1, 4))
def test_scores_are_the_same_however_blocks_are_summed(docs, fan_in):
    """Many crowds of few blocks, one block a crowd, and all blocks at once."""
    columns = ("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score")

    def scores(**model):
        model = lm_scoring.Model(block_bytes=60_000, range_tokens=20_000, **model)
        return sorted(lm_scoring.fold_scores(docs, model).select(*columns).collect())

    for got, want in zip(scores(fan_in=fan_in), scores(), strict=True):
        assert got[:4] == want[:4] and got[4:] == pytest.approx(want[4:])


def test_a_context_prefers_what_followed_it(spark):
    train = [(i, "a b a c a b", False) for i in range(12)]
    tries = [(100 + i, f"a {w}".strip(), True) for i, w in enumerate(["a", "b", "c", "unseen", ""])]
    docs = spark.createDataFrame(train + tries, "doc_id long, text string, out boolean")
    rows = lm_scoring.score_texts(docs, F.col("out")).collect()
    score = {r["doc_id"]: r["score"] for r in rows}
    assert score[101] > score[100] and score[102] > score[103]
    assert all(s < 0 for s in score.values())


def test_weights_follow_the_deleted_texts(spark):
    n = np.array([50, 50], np.int64)
    rows = [
        (lm_scoring.pack(np.array([1, 2], np.int64)), lm_scoring.pack(np.array([0.9, 0.0])),
         lm_scoring.pack(np.array([0.001, 0.01])), lm_scoring.pack(n)),
    ]
    frame = spark.createDataFrame(rows, "bucket binary, two binary, one binary, n binary")
    weights = lm_scoring._weights(frame, 12)
    assert weights[0] == 0 and weights[1] > 0.95 and weights[2] < 0.05 and weights[3] == 0.5


def test_packing_round_trip():
    for values, kind in (([], "<i8"), ([0, -1, 2**62], "<i8"), ([1.5, -0.0], "<f8"), ([7] * 300, "<i4")):
        array = np.array(values, kind)
        assert (lm_scoring.unpack(lm_scoring.pack(array), kind) == array).all()


def test_scoring_odd_rows(odd, nothing):
    rows = lm_scoring.fold_scores(odd).collect()
    assert len(rows) == 12
    assert all(r["n_tokens"] == 1 for r in rows if r["doc_id"] in (3, 4, 5))
    assert {r["doc_id"] for r in rows} == {1, 2, 3, 4, 5, 6, 7, 8, 9, None}
    assert lm_scoring.fold_scores(nothing).count() == 0
    untrained = lm_scoring.score_texts(odd, F.lit(True)).collect()
    assert all(r["train_tokens"] == 0 and r["score"] == r["base_score"] == 0 for r in untrained)


def test_toxicity_learns_word_beginnings_and_words(spark):
    docs, labels = [], []
    for i in range(400):
        kind = i % 5 == 1
        words = [f"w{(i * 31 + k * 7) % 300}x{'abcdefgh'[(i + k) % 8]}" for k in range(40)]
        if kind:
            words[7] = "nastier" if i % 2 else "nastiest"
            words[21] = "1d10t"
        docs.append((i, " ".join(words)))
        labels.append((i, 0, int(kind)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    lexicon = toxicity.fit_fold(frame, marks)
    rows = toxicity.scored(frame, lexicon).collect()
    want = {i: t for i, _, t in labels}
    assert all(r["predicted"] == want[r["doc_id"]] for r in rows)
    assert all(r["held_out"] == (fold(r["doc_id"], 5) == 0) for r in rows)
    assert lexicon.score("you іdіot nastіest") > 0.5 > lexicon.score("you and me")


def test_exceptions_take_a_word_out():
    lexicon = toxicity.Lexicon({"^trash": 5.0}, frozenset({"trash can"}), (-2.0, 3.0, 0.0))
    assert lexicon.score("what trash") > 0.5 > lexicon.score("the trash can")
    assert lexicon.score("TRASH trash can") > 0.5
    assert lexicon.score("thetrash") < 0.5
    assert lexicon.score(None) == lexicon.score("")


def test_folding():
    assert toxicity.folded_words("1D10T idіot 2024 a$$") == ["ldlot", "ldlot", "2024", "ass"]


def test_toxicity_of_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame(
        [(1, 0, 1), (1, 0, 0), (6, 0, 0), (77, 0, 1), (None, 0, 1), (2, 0, None)],
        "doc_id long, quality int, toxic int",
    )
    lexicon = toxicity.fit_fold(odd, labels)
    rows = toxicity.scored(odd, lexicon).collect()
    assert len(rows) == 12 and all(0 <= r["score"] <= 1 for r in rows)
    empty = toxicity.fit_fold(nothing, labels.limit(0))
    assert empty.weights == {} and toxicity.scored(nothing, empty).count() == 0


def plain_ppm(trained, text, order):
    """Code length of ``text`` byte by byte from dictionaries of counts."""
    tables = [dict() for _ in range(order + 1)]
    for t in trained:
        data = b"\n" * order + t
        for i in range(order, len(data)):
            for k in range(order + 1):
                tables[k].setdefault(data[i - k : i], Counter())[data[i]] += 1
    data, bits = b"\n" * order + text, 0.0
    for i in range(order, len(data)):
        for k in range(order, -1, -1):
            seen = tables[k].get(data[i - k : i])
            if not seen:
                continue
            room = sum(seen.values()) + len(seen)
            if data[i] in seen:
                bits += math.log2(room / seen[data[i]])
                break
            bits += math.log2(room / len(seen))
        else:
            bits += 8
    return bits


def test_code_lengths_are_exact(monkeypatch):
    monkeypatch.setattr(language, "STEP", 17)
    trained = {"aa": [b"the cat sat on the mat", b"then"], "bb": [b"le chat est sur le tapis"]}
    counted = {}
    for name, some in trained.items():
        keys = language.grams(some, 3)[0]
        counted[name] = [np.unique(keys & language._mask(k + 1), return_counts=True) for k in range(4)]
    trees = language.ContextTrees(counted)
    tests = [b"the mat", b"", b"chat", b"\xff\x00zq", b"the chat sat sur the tapis, then le cat"]
    found = trees.code_lengths(tests)
    for row, text in zip(found, tests):
        assert row == pytest.approx([plain_ppm(trained[n], text, 3) for n in ("aa", "bb")])


def test_languages_of_held_out_documents(spark, sf_dir, docs):
    rows = queries.QUERIES["op6_language_id"](spark, sf_dir).collect()
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    assert len(rows) == len(lang)
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in lang if fold(i, 3) == 1}
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_languages_of_odd_rows(odd, nothing):
    trees = language.fit_fold(odd)
    rows = language.identified(odd, trees).collect()
    assert len(rows) == 12
    unknown = [r["doc_id"] for r in rows if r["lang_pred"] == "und"]
    assert sorted(i for i in unknown if i) == [3, 4, 5, 8] and None in unknown
    kept = language.drop_unidentified(odd, trees)
    assert kept.columns == odd.columns and kept.count() == 7
    blank = language.fit_fold(nothing)
    assert {r["lang_pred"] for r in language.identified(odd, blank).collect()} == {"und"}
    assert language.identified(nothing, blank).count() == 0


def test_too_many_labels_are_refused(spark):
    docs = spark.createDataFrame([(i, "text", f"l{i}") for i in range(9)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError):
        language.fit(docs, language.Fit(languages=5))


def test_only_letters_are_letters(spark):
    import sys
    import unicodedata

    kinds: dict[str, str] = {}
    for code in range(sys.maxunicode + 1):
        kinds.setdefault(unicodedata.category(chr(code)), "")
        if len(kinds[unicodedata.category(chr(code))]) < 20 and not 0xD800 <= code < 0xE000:
            kinds[unicodedata.category(chr(code))] += chr(code)
    # Code points that Python does not know yet may be letters to a newer table.
    kinds = {k: t for k, t in kinds.items() if t and k != "Cn"}
    trees = language.fit(spark.createDataFrame([(1, "hello there", "en"), (2, "hola amigo", "es")], "doc_id long, text string, lang string"))
    found = dict(zip(kinds, trees.predict(list(kinds.values()))[0]))
    assert {k for k, lang in found.items() if lang != "und"} == {k for k in kinds if k[0] == "L"}


@settings(max_examples=200, deadline=None)
@given(
    st.dictionaries(st.integers(0, 60), st.floats(0, 1), max_size=30),
    st.lists(st.tuples(st.integers(0, 60), st.integers(0, 12)), max_size=8),
)
def test_hits_outside_the_exceptions(found, drawn):
    spans = [(a, a + n) for a, n in drawn]
    want = {at: w for at, w in found.items() if not any(a <= at < b for a, b in spans)}
    assert toxicity.without(found, spans) == want


def test_many_exceptions_in_a_long_text():
    lexicon = toxicity.Lexicon({"dog": 1.0}, frozenset({"bad dog"}))
    words = ["bad", "dog"] * 200_000 + ["dog"]
    assert len(lexicon.hits(words)) == 1
