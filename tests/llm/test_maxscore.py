"""The steps of exact search and of the vector forest that need no Spark session."""

from __future__ import annotations

import numpy as np
import pytest

pytest.importorskip("marketloom.llm")


@pytest.mark.parametrize("seed", range(20))
def test_max_score_keeps_every_vector_at_or_above_the_floor(seed):
    from marketloom.llm.topk import max_score

    rng = np.random.default_rng(seed)
    postings = np.floor(rng.standard_normal((16, 300)) * rng.choice([1, 40], (16, 1)))
    query = np.floor(rng.standard_normal(16) * 10)
    score = query @ postings
    best = np.sort(score)
    for floor in (-np.inf, best[0] - 1, best[150], best[-6], best[-1], best[-1] + 1e6):
        alive, found = max_score(query, postings, postings.max(axis=1), postings.min(axis=1), 6, floor)
        assert (found == score[alive]).all()
        wanted = np.flatnonzero(score >= max(floor, best[-6]))
        assert set(wanted) <= set(alive.tolist())
    assert not len(max_score(query, postings, postings.max(axis=1), postings.min(axis=1), 6, 1e12)[0])


def test_floors_let_go_start_anew():
    from marketloom.llm import topk

    floors = topk.Floors(2)
    floors.of(b"a", 1)[0] = [3, 4]
    assert floors.of(b"a", 1).tolist() == [[3, 4]]
    for i in range(topk.HELD):
        floors.of(b"q%d" % i, 1)
    assert np.isneginf(floors.of(b"a", 1)).all()


def test_pairs_count_in_their_first_shared_leaf_and_stars_join_chains():
    from marketloom.llm.forest import _met_before, _stars

    codes = np.array([[0, 2, 9], [0, 2, 9], [1, 2, 9]], np.int32)
    i, j = np.array([0, 0, 1]), np.array([1, 2, 2])
    assert _met_before(codes, i, j, 2).tolist() == [True, False, False]
    assert _met_before(codes, i, j, 0).tolist() == [False, False, False]
    order = np.random.default_rng(1).permutation(200)
    assert (_stars(201, order[:-1], order[1:])[:200] == 0).all()
    assert _stars(3, np.array([1]), np.array([2])).tolist() == [0, 1, 1]
