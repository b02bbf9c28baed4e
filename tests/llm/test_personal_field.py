"""The semi-Markov field against enumeration of all segmentations, and on very long islands."""

import itertools
import math
import time

import numpy as np

from roomledger.llm import personal_data as P

ISLANDS = ["12-345 6", "a(at)b.c", "x@y.de 77", "(499) 55-6", "1234 5678", "+7 12.34"]


def segmentations(ends, kinds):
    """Every way to cover units 0..n by single outside units and candidate segments with a kind."""
    n = len(ends) - 1

    def go(j):
        if j == 0:
            yield []
            return
        for rest in go(j - 1):
            yield rest
        for i, f in ends[j]:
            for rest, k in itertools.product(list(go(i)), range(kinds)):
                yield [*rest, (i, j, k, f)]
    return list(go(n))


def field_of(seed):
    return P.Field(np.random.default_rng(seed).normal(0, 0.4, (P.WIDTH, len(P.KINDS))))


def score(field, segmentation, margin=0.0):
    return sum(field.weights[f, k].sum() - margin for _, _, k, f in segmentation)


def test_best_segmentation_equals_enumeration():
    for seed, text in enumerate(ISLANDS * 3):
        field = field_of(seed)
        bounds, ends = P.candidates(text, 0, len(text))
        every = segmentations(ends, len(P.KINDS))
        best = max(every, key=lambda x: score(field, x, P.MARGIN))
        got = field.best(text, 0, len(text))
        assert got == [(bounds[i], P.KINDS[k], bounds[j]) for i, j, k, _ in best]


def test_gradient_equals_enumeration():
    for seed, text in enumerate(ISLANDS):
        field = field_of(50 + seed)
        _, ends = P.candidates(text, 0, len(text))
        every = segmentations(ends, len(P.KINDS))
        logs = np.array([score(field, x) for x in every])
        share = np.exp(logs - logs.max())
        share /= share.sum()
        gold = next((x for x in every if x), [])
        want = np.zeros_like(field.weights)
        for p, x in [*zip(-share, every, strict=True), (1.0, gold)]:
            for _, _, k, f in x:
                want[f, k] += p
        got = field.gradient(ends, {(i, j): k for i, j, k, _ in gold})
        assert np.allclose(got, want, atol=1e-9)


def test_long_island_equals_its_repeats_and_grows_in_proportion():
    field = field_of(7)
    unit = "4155 32 910 77 5 "
    seconds = []
    for n in (300, 1200):
        text = unit * n
        began = time.process_time()
        spans = field.best(text, 0, len(text) - 1)
        seconds.append(time.process_time() - began)
        assert all(a[2] <= b[0] for a, b in itertools.pairwise(spans))
        assert max((e - s for s, _, e in spans), default=0) <= P.MAX_UNITS * 4
    assert seconds[1] < 4 * seconds[0] * 2.5 and math.isfinite(seconds[1])
