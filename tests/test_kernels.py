"""Property tests of the numpy kernels used inside Arrow batches."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from factorlab.operators.als import _segment_sums
from factorlab.operators.recommend import top_n_mask
from factorlab.operators.similarity import ragged_pairs

keys = st.lists(st.integers(0, 6), max_size=40)


@settings(max_examples=200, deadline=None)
@given(keys, keys, st.integers(1, 7))
def test_ragged_pairs_enumerates_equal_key_pairs(a, b, chunk):
    a, b = np.array(a, dtype=np.int64), np.sort(np.array(b, dtype=np.int64))
    got = []
    for ia, ib in ragged_pairs(a, b, chunk=chunk):
        assert (a[ia] == b[ib]).all()
        got += list(zip(ia.tolist(), ib.tolist()))
    want = [(i, j) for i in range(len(a)) for j in range(len(b)) if a[i] == b[j]]
    assert sorted(got) == sorted(want)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from([0.0, 0.5, 1.0, 2.0, -np.inf]), min_size=5, max_size=5),
                min_size=1, max_size=6), st.integers(1, 6))
def test_top_n_mask_is_exact_with_ties(rows, n):
    S = np.array(rows)
    mask = top_n_mask(S, n)
    for r in range(S.shape[0]):
        order = sorted((-S[r, c], c) for c in range(S.shape[1]) if np.isfinite(S[r, c]))[:n]
        assert sorted(np.flatnonzero(mask[r]).tolist()) == sorted(c for _, c in order)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=30), st.integers(1, 4))
def test_segment_sums_match_loop(seg, k):
    seg = np.sort(np.array(seg))
    rng = np.random.default_rng(len(seg))
    V, r = rng.random((len(seg), k)), rng.random(len(seg))
    starts = np.r_[0, np.flatnonzero(seg[1:] != seg[:-1]) + 1]
    G, B, n, sq = _segment_sums(V, r, starts, k)
    for j, s in enumerate(starts):
        e = starts[j + 1] if j + 1 < len(starts) else len(seg)
        assert np.allclose(G[j], V[s:e].T @ V[s:e]) and np.allclose(B[j], V[s:e].T @ r[s:e])
        assert n[j] == e - s and np.isclose(sq[j], r[s:e] @ r[s:e])
