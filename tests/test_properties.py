"""Properties that hold for all inputs, without a session."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.operators import blocks, kernels, stencil
from tessera.sources.sinks import merged_runs

masks = st.integers(0, 2**24 - 1).map(lambda k: np.array([k >> i & 1 for i in range(24)], bool).reshape(2, 3, 4))


@given(st.integers(1, 60), st.integers(1, 20), st.integers(0, 5))
def test_cores_tile_and_margins_hold_them(full, size, margin):
    b = blocks.bounds(full, size, margin)
    assert b[0][0] == 0 and b[-1][1] == full and all(p[1] == q[0] for p, q in zip(b, b[1:]))
    assert all(0 <= lo <= start < stop <= hi <= full for start, stop, lo, hi in b)
    assert blocks.count({"z": full, "y": 1, "x": 1}, {"z": size, "y": 1, "x": 1}) == len(b)


@given(masks)
def test_components_cover_the_mask_and_nothing_else(mask):
    six, full = kernels.components(mask), kernels.components(mask, True)
    assert ((six > 0) == mask).all() and ((full > 0) == mask).all() and full.max() <= six.max()
    assert set(np.unique(six[mask])) == set(range(1, six.max() + 1))


@given(masks)
def test_filling_only_adds_and_is_stable(mask):
    once = kernels.filled(mask)
    assert (mask <= once).all() and (kernels.filled(once) == once).all()


@settings(max_examples=40)
@given(masks, st.floats(0.5, 3), st.floats(0.5, 3))
def test_distances_equal_the_nearest_background(mask, dy, dx):
    d = kernels.distance_in_planes(mask, dy, dx)
    y, x = np.indices(mask.shape[1:])
    for z, plane in enumerate(mask):
        off = np.argwhere(~plane)
        want = np.min([np.hypot(dy * (y - a), dx * (x - b)) for a, b in off], axis=0) if len(off) else np.full(plane.shape, np.inf)
        assert np.allclose(d[z], np.where(plane, want, 0))


@given(masks)
def test_watershed_keeps_seeds_and_stays_inside(mask):
    seeds = np.zeros(mask.shape, int)
    seeds[0, 0, 0], seeds[1, 2, 3] = 1, 2
    w = kernels.watershed(np.arange(24).reshape(mask.shape), seeds, mask)
    assert (w[~mask] == 0).all() and (w[mask & (seeds > 0)] == seeds[mask & (seeds > 0)]).all()


@given(st.integers(0, 4), st.floats(0.1, 50), st.floats(0.1, 5))
def test_footprints(r, distance, elsize):
    for f in (stencil.disk(r), stencil.ball(r), stencil.square(r), stencil.cube(r)):
        assert (0, 0, 0) in f and {tuple(-d for d in o) for o in f} == set(f)
    assert stencil.odd_extent(distance, elsize) % 2 == 1


@given(st.lists(st.dictionaries(st.sampled_from("abc"), st.one_of(st.integers(), st.dictionaries(st.sampled_from("xy"), st.integers())), max_size=3), max_size=4))
def test_the_last_run_counts(runs):
    out = merged_runs(runs)
    for k, v in out.items():
        last = [r[k] for r in runs if k in r][-1]
        assert v == last or isinstance(last, dict) and last.items() <= v.items()
