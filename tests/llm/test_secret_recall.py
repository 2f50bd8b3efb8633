"""Recall of random strings inside long texts of ordinary words."""

from __future__ import annotations

import numpy as np
import pytest

from tillbook.llm import secret_scan

ALPHABET = list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
LONG = "internationalization counterrevolutionaries 2024061512345678 UNCHARACTERISTICALLY "
NAMES = "AbstractSingletonProxyFactory content/uploads/Annual-Report-Summary internationalization_of_software "


def recall(length, around, rng, n=200):
    def one():
        secret = "".join(rng.choice(ALPHABET, length))
        spans = secret_scan.scan(f"{around} {secret} {around}".encode())
        return ("random", len(around) + 1, len(around) + 1 + length) in spans

    return sum(one() for _ in range(n)) / n


@pytest.mark.parametrize(("length", "plain", "named"), [(20, 0.75, 0.5), (32, 0.9, 0.8), (40, 0.9, 0.85), (64, 0.9, 0.9)])
def test_recall_does_not_fall_with_the_words_around(length, plain, named):
    rng = np.random.default_rng(length)
    assert recall(length, LONG * 20, rng) >= plain
    assert recall(length, NAMES * 4, rng) >= named


def test_names_are_not_random():
    for word in (LONG + NAMES).split():
        assert secret_scan.scan(word.encode()) == []
