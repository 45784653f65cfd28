"""The choice of a sequence against brute force over all open ones."""

from __future__ import annotations

import numpy as np
import pytest

from passbook.llm.packing import Capacity, best_fit


def brute_force(lengths: list[int], top: Capacity) -> list[tuple[int, int]]:
    """Every open sequence scored for every piece."""
    places: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    bins: list[list[int]] = []  # residual tokens, documents, attention; piece it took last
    limits = (top.tokens, top.documents, top.attention)
    for turn, i in enumerate(sorted(range(len(lengths)), key=lambda i: -lengths[i])):
        demand = (lengths[i], 1, lengths[i] ** 2)

        def score(left: list[int], demand: tuple = demand) -> float:
            terms = list(zip(top.weights, left, demand, limits, strict=False))
            if top.rule == "dot":
                return -sum(w * (a / n) * (d / n) for w, a, d, n in terms)
            return sum(w * ((a - d) / n) ** 2 for w, a, d, n in terms)

        fit = [b for b in range(len(bins)) if all(a >= d for a, d in zip(bins[b], demand, strict=False))]
        if fit:
            chosen = min(fit, key=lambda b: (score(bins[b]), bins[b][0], -bins[b][3]))
        else:
            chosen = len(bins)
            bins.append([top.tokens, top.documents, max(top.attention, demand[2]), turn])
        places[i] = chosen, top.tokens - bins[chosen][0]
        bins[chosen] = [a - d for a, d in zip(bins[chosen], demand, strict=False)] + [turn]
    return places


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("documents, attention", [(64, 64**2), (3, 64**2), (64, 1500), (1, 64**2)])
def test_every_open_sequence_is_scored(rule, documents, attention):
    pick = np.random.default_rng(5)
    # Many open sequences of many levels: hardly two pieces fit together at first, then small ones come.
    lengths = np.concatenate([pick.integers(33, 65, 120), pick.integers(1, 20, 200), [64, 64, 1, 1]])
    top = Capacity(64, documents, attention, (1.0, 0.5, 0.5), rule)
    sequence, offset = best_fit(lengths, top)
    assert list(zip(sequence.tolist(), offset.tolist(), strict=True)) == brute_force(lengths.tolist(), top)
