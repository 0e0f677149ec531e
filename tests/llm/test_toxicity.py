"""Toxicity held against a plain version: Kneser-Ney counts in dictionaries, features word by word."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from math import log, log1p, sqrt, tanh

import numpy as np
import pyarrow as pa
import pytest

from shelfwise.llm import toxicity

PAD, END = 1, 2


def grams_of(word):
    raw = bytes([PAD]) * (toxicity.ORDER - 1) + word.lower().encode() + bytes([END])
    return [raw[k : k + toxicity.ORDER] for k in range(len(raw) - toxicity.ORDER + 1)]


class PlainModels:
    def __init__(self, texts, toxic):
        self.counts = (Counter(), Counter())
        for text, label in zip(texts, toxic):
            for word in (text or "").split():
                self.counts[label].update(grams_of(word))
        self.seen = set(self.counts[0]) | set(self.counts[1])
        self.levels, level = {}, self.seen
        for order in range(toxicity.ORDER - 1, 0, -1):
            self.levels[order] = Counter(g[1:] for g in level)
            level = set(self.levels[order])
        self.by_context = {order: defaultdict(list) for order in self.levels}
        for order, counts in self.levels.items():
            for gram, n in counts.items():
                self.by_context[order][gram[:-1]].append(n)
        self.own = [defaultdict(list), defaultdict(list)]
        for c in (0, 1):
            for gram, n in self.counts[c].items():
                self.own[c][gram[:-1]].append(n)
        self.contexts = {g[:-1] for g in self.seen}

    def shared(self, gram):
        if not gram:
            return 1 / 256
        counts = self.by_context[len(gram)][gram[:-1]]
        return max(self.levels[len(gram)][gram] - toxicity.DISCOUNT, 0) / sum(counts) + toxicity.DISCOUNT * len(counts) / sum(counts) * self.shared(gram[1:])

    def weight(self, context, c):
        counts = self.own[c].get(context)
        return toxicity.DISCOUNT * len(counts) / sum(counts) if counts else 1.0

    def gain(self, word):
        total = 0.0
        for gram in grams_of(word):
            context = gram[:-1]
            if gram in self.seen:
                p = [max(self.counts[c][gram] - toxicity.DISCOUNT, 0) / max(sum(self.own[c].get(context, [])), 1) + self.weight(context, c) * self.shared(gram[1:]) for c in (0, 1)]
                total += log(p[1]) - log(p[0])
            elif context in self.contexts:
                total += log(self.weight(context, 1)) - log(self.weight(context, 0))
        return total

    def features(self, text):
        words = (text or "").split()
        if not words:
            return [0.0] * (2 * toxicity.TOP + 2 + 2 * len(toxicity.LEVELS))
        gains = [(self.gain(w), len(w.encode()) + 1) for w in words]
        best = lambda values: [max(x, 0) for x in (sorted(values, reverse=True) + [0.0] * toxicity.TOP)[: toxicity.TOP]]
        out = [tanh(x / 4) for x in best([g for g, _ in gains])] + [tanh(x) for x in best([g / n for g, n in gains])]
        out.append(tanh(sum(g for g, _ in gains) / sum(n for _, n in gains) / 0.2))
        distinct = [self.gain(w) for w in set(words)]
        beyond = [sum(max(g - level, 0) for g in distinct) for level in toxicity.LEVELS]
        for x in beyond:
            out += [log1p(x) / 3, sqrt(x / len(distinct)) / 3]
        return [*out, log1p(len(distinct)) / 3 if beyond[0] > 0 else 0.0]


def weak_signs(n, seed=5):
    """Texts whose toxic ones hold several words of one stem, each such word once or twice in the whole corpus."""
    rng = random.Random(seed)
    syllables = ["ba", "ne", "ti", "ro", "lu", "ka", "se", "mi", "do", "fa"]
    word = lambda k: "".join(rng.choice(syllables) for _ in range(k))
    texts, toxic = [], []
    for k in range(n):
        words = [word(rng.choice([1, 2, 3])) for _ in range(30)]
        if k % 6 == 0:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), "vrax" + word(3))
        texts.append(" ".join(words))
        toxic.append(int(k % 6 == 0))
    return texts, np.array(toxic)


def test_features_and_scores_equal_a_plain_version():
    texts, toxic = weak_signs(60)
    texts[7], texts[9] = texts[7] + " " + texts[7].split()[0].upper(), "Ébène çà " + texts[9]
    scorer = toxicity.Scorer(texts, toxic, np.ones(len(texts)))
    plain = PlainModels(texts, toxic)
    asked = [texts[0], texts[1], texts[9], "vraxunseen word", "", None]
    expected = np.array([plain.features(t) for t in asked])
    found = toxicity.squash(scorer.models.features(pa.array(asked, pa.string())))
    assert found == pytest.approx(expected, abs=1e-4)
    scores = 1 / (1 + np.exp(-(expected @ scorer.weights[:-1] + scorer.weights[-1])))
    assert scorer.scores(pa.array(asked, pa.string())) == pytest.approx(scores, abs=1e-3)


def test_weights_come_from_models_that_did_not_see_the_text():
    texts, toxic = weak_signs(48)
    fold = toxicity.folds_of(texts, toxic)
    x = np.zeros((len(texts), len(PlainModels(texts, toxic).features("a"))))
    for k in range(toxicity.FOLDS):
        others = fold != k
        plain = PlainModels([t for t, o in zip(texts, others) if o], toxic[others])
        for j in np.flatnonzero(~others):
            x[j] = plain.features(texts[j])
    weights = toxicity.fit_logistic(x, toxic, np.ones(len(texts)))
    assert toxicity.Scorer(texts, toxic, np.ones(len(texts))).weights == pytest.approx(weights, abs=2e-2)


def test_parts_keep_equal_texts_together_and_classes_even():
    texts, toxic = weak_signs(96)
    fold = toxicity.folds_of(texts + texts[:10], np.append(toxic, toxic[:10]))
    assert (fold[:10] == fold[96:]).all()
    assert [int(toxic[fold[:96] == k].sum()) for k in range(toxicity.FOLDS)] == [4] * toxicity.FOLDS


def test_many_weak_signs_are_caught_and_clean_texts_left():
    texts, toxic = weak_signs(900)
    scorer = toxicity.Scorer(texts[:600], toxic[:600], np.ones(600))
    caught = scorer.scores(pa.array(texts[600:], pa.string())) >= toxicity.THRESHOLD
    assert caught[toxic[600:] == 1].mean() >= 0.9 and caught[toxic[600:] == 0].mean() <= 0.02


def test_texts_without_evidence_and_tiny_samples():
    texts, toxic = weak_signs(600)
    scorer = toxicity.Scorer(texts, toxic, np.ones(600))
    assert (scorer.scores(pa.array(["", None, " \t "], pa.string())) < toxicity.THRESHOLD).all()
    # one text a class, equal texts of both classes, and only empty texts
    for few, labels in ((["good", "bad"], [0, 1]), (["same", "same"], [0, 1]), (["", ""], [0, 1])):
        scores = toxicity.Scorer(few, np.array(labels), np.ones(2)).scores(pa.array(["good", "x" * 5000, ""], pa.string()))
        assert ((scores >= 0) & (scores <= 1)).all()
