"""Searches of a monotone sequence, against the numbers themselves."""

import numpy as np
import pytest

from millrace.llm.elias_fano import EliasFano, lowest


def test_the_lowest_one_of_a_word():
    words = np.array([0, 1, 2, 12, 1 << 63, (1 << 64) - 1], np.uint64)
    assert lowest(words).tolist() == [64, 0, 1, 2, 63, 0]


@pytest.mark.parametrize("kind", ["spread", "runs", "equal", "one", "dense"])
def test_pairs_and_searches_where_runs_cross_words(kind):
    rng = np.random.default_rng(5)
    numbers = {
        "spread": np.sort(rng.integers(0, 1 << 40, 5000)),
        # hundreds of numbers with one high part, and wide gaps after them
        "runs": np.sort(np.concatenate([(1 << 34) * k + rng.integers(0, 3000, 700) for k in range(9)])),
        "equal": np.repeat(np.arange(0, 4000, 40), 130),
        "one": np.array([17]),
        "dense": np.arange(777),
    }[kind]
    held = EliasFano(EliasFano.build(numbers, "x"), "x")
    at = np.arange(len(numbers) - 1)
    first, then = held.pair(at)
    assert (first == numbers[:-1]).all() and (then == numbers[1:]).all() and (held.get(np.arange(len(numbers))) == numbers).all()
    asked = np.concatenate([numbers, numbers + 1, np.maximum(numbers - 1, 0), [0, int(numbers[-1]) + 5, 1 << 50]])
    place = np.searchsorted(numbers, asked)
    there = numbers[np.minimum(place, len(numbers) - 1)] == asked
    assert (held.find(asked) == np.where(there, place, -1)).all()
    inside, before = (held.find(asked, np.zeros_like(place), place + more) for more in (1, 0))
    assert (inside == np.where(there, place, -1)).all() and (before == -1).all()
