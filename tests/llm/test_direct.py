"""Whole queries of the language model and of toxicity against direct evaluations."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tillbook.llm import lm_scoring, queries, toxicity

WORD = re.compile("[^\x20\x09-\x0d]+")
END, START = "\0end", "\0start"
#: The smallest tables with toxic texts enough for a lexicon.
LABELLED = "/root/testdata/sf0.01"


def tokens(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [END]


def pairs(text):
    words = tokens(text)
    return list(zip([START, *words], words))


class Counts:
    """Words, pairs and starts of some texts, in dictionaries."""

    def __init__(self, texts):
        self.word = Counter(w for t in texts for w in tokens(t))
        self.pair = Counter(p for t in texts for p in pairs(t))
        self.size, self.kinds = sum(self.word.values()), len(self.word)
        self.starts = len(texts)

    def parts(self, before, word):
        """Bucket of the context, share of the pair in it, smoothed share of the word."""
        n = self.starts if before == START else self.word[before]
        share = self.pair[before, word] / n if n else 0.0
        return n.bit_length(), share, (self.word[word] + 1) / (self.size + self.kinds + 1)

    def probability(self, weights, before, word):
        bucket, two, one = self.parts(before, word)
        weight = weights.get(bucket, 0.5) if bucket else 0.0
        return weight * two + (1 - weight) * one


def learned(retained, deleted, rounds=12):
    """Expectation-maximisation, token by token."""
    counts = Counts(retained)
    seen = [counts.parts(*p) for t in deleted for p in pairs(t)]
    weights = {bucket: 0.5 for bucket in range(1, 65)}
    for _ in range(rounds):
        total, share = defaultdict(float), defaultdict(float)
        for bucket, two, one in seen:
            weight = weights.get(bucket, 0.0)
            total[bucket] += 1
            share[bucket] += weight * two / (weight * two + (1 - weight) * one)
        weights = {b: (share[b] + 0.5) / (total[b] + 1) for b in weights}
    return weights


def model_of(docs):
    """The whole model of the registered query, from collected rows."""
    rows = docs.select(
        "doc_id", "text", (F.pmod(F.xxhash64(F.lit(3), "doc_id", "text"), F.lit(10)) == 0).alias("gone")
    ).collect()
    train = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 7 != 2]
    weights = learned([r["text"] for r in train if not r["gone"]], [r["text"] for r in train if r["gone"]])
    return Counts([r["text"] for r in train]), weights


def test_the_scores_are_those_of_a_direct_evaluation(spark, sf_dir, docs, texts):
    counts, weights = model_of(docs)
    rows = queries.QUERIES["op4_lm_scoring"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = sum(math.log10(counts.probability(weights, *p)) for p in pairs(texts[r["doc_id"]]))
        assert r["score"] == pytest.approx(want, rel=1e-9)


def test_probabilities_of_a_context_add_up_to_one(docs):
    """Over all words, the end and one unknown word, whatever the context."""
    counts, weights = model_of(docs)
    common = [w for w, _ in counts.word.most_common(3) if w != END]
    rare = [w for w, n in counts.word.items() if n == 1][:2]
    for before in (START, "never seen", *common, *rare):
        mass = sum(counts.probability(weights, before, w) for w in [*counts.word, "an unknown word"])
        assert mass == pytest.approx(1.0, abs=1e-9)


def plain_hits(words, lexicon):
    """Weight of each word hit, phrase by phrase and entry by entry."""
    out = {}
    phrases = [p.split(" ") for p in lexicon.exceptions]
    excepted = {
        i + k
        for phrase in phrases
        for i in range(len(words) - len(phrase) + 1)
        if words[i : i + len(phrase)] == phrase
        for k in range(len(phrase))
    }
    for i, word in enumerate(words):
        found = [lexicon.weights[word]] if word in lexicon.weights else []
        found += [lexicon.weights["^" + word[:n]] for n in range(1, len(word) + 1) if "^" + word[:n] in lexicon.weights]
        if found and i not in excepted:
            out[i] = max(found)
    return out


def plain_score(text, lexicon):
    words = toxicity.folded_words(text)
    weight = sum(plain_hits(words, lexicon).values())
    features = (1.0, math.log1p(weight), math.log1p(10 * weight / math.sqrt(len(words) + 1)))
    return 1 / (1 + math.exp(-sum(s * x for s, x in zip(lexicon.slopes, features))))


@pytest.fixture(scope="module")
def labelled(spark):
    return (
        spark.read.parquet(f"{LABELLED}/documents.parquet"),
        spark.read.parquet(f"{LABELLED}/labels.parquet"),
    )


@pytest.fixture(scope="module")
def sample(labelled):
    """Folded words and label of each family of labelled texts that are not held out."""
    docs, labels = labelled
    toxic = {}
    for r in labels.collect():
        if r["toxic"] is not None:
            toxic[r["doc_id"]] = max(r["toxic"], toxic.get(r["doc_id"], 0))
    families = {}
    for r in docs.select("doc_id", "text").collect():
        if r["doc_id"] in toxic and zlib.crc32(str(r["doc_id"]).encode()) % 5 != 0:
            words = toxicity.folded_words(r["text"])
            key = toxic[r["doc_id"]], toxicity.family(words)
            families[key] = min(" ".join(words), families.get(key, " ".join(words)))
    return [(line.split(" ") if line else [], kind == 1) for (kind, _), line in families.items()]


@pytest.fixture(scope="module")
def lexicon(labelled):
    return toxicity.fit_fold(*labelled)


def test_the_lexicon_is_that_of_plain_counts(sample, lexicon):
    fit = toxicity.Fit()
    counts = {True: Counter(), False: Counter()}
    for words, kind in sample:
        found = set(words)
        found |= {"^" + w[:n] for w in words for n in range(fit.shortest, min(fit.longest, len(w)) + 1)}
        counts[kind].update(found)
    toxic = sum(kind for _, kind in sample)
    clean = len(sample) - toxic
    odds = {
        key: math.log((n + 0.5) / (toxic + 1)) - math.log((counts[False][key] + 0.5) / (clean + 1))
        for key, n in counts[True].items()
        if n >= fit.texts
    }
    marks = {key: o for key, o in odds.items() if o >= fit.log_odds}
    assert lexicon.weights and set(lexicon.weights) <= set(marks)
    for key, o in lexicon.weights.items():
        assert o == pytest.approx(marks[key])
    # What was left out begins with an entry that is about as heavy.
    for key in set(marks) - set(lexicon.weights):
        bare = key.lstrip("^")
        heads = [lexicon.weights.get("^" + bare[:n], 0.0) for n in range(1, len(bare) + 1)]
        assert max(heads) >= 0.9 * marks[key] - 1e-9


def test_the_slopes_are_the_best_ones(sample, lexicon):
    """At the maximum of the penalised likelihood its gradient is null."""
    gradient = [0.0, 0.0, 0.0]
    for words, kind in sample:
        weight = sum(plain_hits(words, lexicon).values())
        x = (1.0, math.log1p(weight), math.log1p(10 * weight / math.sqrt(len(words) + 1)))
        error = kind - 1 / (1 + math.exp(-sum(s * v for s, v in zip(lexicon.slopes, x))))
        gradient = [g + error * v for g, v in zip(gradient, x)]
    for g, slope in zip(gradient, lexicon.slopes):
        assert g - 0.01 * slope == pytest.approx(0.0, abs=1e-4)


def test_the_toxicity_query_is_a_plain_matcher_and_a_logistic_score(spark, labelled, lexicon):
    texts = {r["doc_id"]: r["text"] for r in labelled[0].collect()}
    rows = queries.QUERIES["op5_toxicity"](spark, LABELLED).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    assert any(r["predicted"] for r in rows)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["score"] == pytest.approx(plain_score(texts[r["doc_id"]], lexicon), abs=1e-9)
        assert r["predicted"] == int(r["score"] >= 0.5)


def test_hits_are_those_of_a_plain_matcher():
    lexicon = toxicity.Lexicon(
        {"^bad": 2.0, "bad": 3.0, "^badger": 1.0, "rot": 4.0},
        frozenset({"bad dog", "dog bad", "rot 13 rot"}),
    )
    for line in (
        "bad", "bad dog bad", "bad dog", "badger bad", "rot 13 rot rot", "rotten rot", "dog bad dog",
        "bad bad dog dog bad bad", "rot 13 rot 13 rot", "a badge", "", "abad",
    ):
        words = line.split()
        starts, at = {}, 0
        for i, word in enumerate(words):
            starts[at] = i
            at += len(word) + 1
        assert {starts[k]: v for k, v in lexicon.hits(words).items()} == plain_hits(words, lexicon), line
