import itertools
import random
import time

import numpy as np
import pytest

from tidewell.llm import langid


def made(k, seed, size=60):
    """A model of k languages of random words, and their words; they share some letters."""
    rng = random.Random(seed)
    words = {}
    for i in range(k):
        letters = rng.sample("abcdefghijklmnopqrstuvwxyz", 12)
        words[f"l{i:03}"] = ["".join(rng.choices(letters, k=rng.randint(3, 8))) for _ in range(size)]
    counts = np.full((k, langid.BUCKETS), 0.5)
    for i, own in enumerate(words.values()):
        counts[i] += np.bincount(langid.trigrams(" ".join(rng.choices(own, k=3000))), minlength=langid.BUCKETS)
    return langid.Model(list(words), np.log(counts / counts.sum(1, keepdims=True))), words


def brute(model, text, penalty):
    """The best set of all by penalised likelihood, each fitted by plain expectation-maximisation, and the sets' scores."""
    at, n = np.unique(langid.trigrams(text), return_counts=True)
    p = np.exp(model.logs[:, at])
    cost = penalty * np.log(n.sum() + 1.0) * np.sqrt(n.sum())
    scores = {}
    for size in range(1, len(model.languages) + 1):
        for some in itertools.combinations(range(len(model.languages)), size):
            w = np.full(size, 1 / size)
            for _ in range(300):
                w = w * (p[list(some)] @ (n / (w @ p[list(some)]))) / n.sum()
            scores[some] = float(n @ np.log(w @ p[list(some)])) - cost * (size - 1)
    return max(scores, key=scores.get), scores


@pytest.mark.parametrize("penalty", [0.1, 0.5, 1.0])
def test_selection_is_the_best_of_all_sets(penalty):
    model, words = made(5, 7)
    rng = random.Random(8)
    same = 0
    for turn in range(30):
        some = rng.sample(list(words), rng.randint(1, 3))
        text = " ".join(w for k in some for w in rng.choices(words[k], k=rng.choice([3, 30, 300])))
        want, scores = brute(model, text, penalty)
        got = langid.mixture(model, text, penalty)
        chosen = tuple(sorted(model.languages.index(k) for k in got))
        same += chosen == want
        assert scores[chosen] >= scores[want] - 2e-4 * len(text)  # a fit stops short of its last digits
        at, n = np.unique(langid.trigrams(text), return_counts=True)
        _, like, most = langid.shares(model.logs[:, at], n, np.full(5, 0.2), rng.randint(1, 50))
        assert like <= scores[tuple(range(5))] + 4 * penalty * np.log(n.sum() + 1.0) * np.sqrt(n.sum()) + 1e-6 <= most + 2e-6
    assert same >= 28


def test_letters():
    assert all(map(langid.has_letter, ["a", "Z 1", "é", "ж", "字", "½ ª"])) and not any(map(langid.has_letter, [None, "", "½ ²", "Ⅷ ①", "12_3 !", "\u0301"]))


def test_many_languages_cost_little_more():
    """Two hundred languages take no more than a few times what ten take, and give the same answer."""
    many, words = made(200, 9, 40)
    few = langid.Model(many.languages[:10], many.logs[:10])
    rng = random.Random(10)
    texts = [" ".join(rng.choices(words[many.languages[i % 10]], k=270) + rng.choices(words[many.languages[(i + 3) % 10]], k=60)) for i in range(20)]
    took = {}
    for name, model in (("few", few), ("many", many)):
        start = time.process_time()
        got = [langid.mixture(model, t) for t in texts]
        took[name] = time.process_time() - start
        assert [next(iter(x)) for x in got] == [many.languages[i % 10] for i in range(20)]
    assert took["many"] < 12 * took["few"]


def test_minor_language_is_tried_without_the_absent_ones():
    rng = random.Random(3)
    words = {k: ["".join(rng.choices(letters, k=6)) for _ in range(60)] for k, letters in (("a", "abcdefgh"), ("b", "ijklmnop"), ("c", "qrstuvwx"))}
    counts = np.full((3, langid.BUCKETS), 0.5)
    for i, own in enumerate(words.values()):
        counts[i] += np.bincount(langid.trigrams(" ".join(rng.choices(own, k=20_000))), minlength=langid.BUCKETS)
    model = langid.Model(list(words), np.log(counts / counts.sum(1, keepdims=True)))
    text = " ".join(rng.choices(words["a"], k=985) + rng.choices(words["b"], k=15))
    got = langid.mixture(model, text, penalty=0.2)
    assert list(got) == ["a", "b"] and 0.005 < got["b"] < 0.02
