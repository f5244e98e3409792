"""Single-precision products never change which center is nearest."""

import numpy as np
import pytest

from matchlake.operators import kmeans as KM


@pytest.mark.parametrize("scale", [1.0, 1e-20, 1e20])
def test_nearest_is_exact_where_single_precision_is_not(scale):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 4)) * scale
    centers = rng.normal(size=(6, 5, 4)) * scale
    centers[0, 1] = centers[0, 0]  # a tie
    centers[1, 1:] = centers[1, :1] + rng.normal(size=(4, 4)) * scale * 1e-10  # closer than single precision tells
    centers[2] = x[:5]
    want = np.stack([KM.squares(x, c).argmin(1) for c in centers])
    d2, slack = KM.products(x, centers)
    assert d2.dtype == (np.float64 if scale > 1e10 else np.float32)
    assert (np.abs(d2 - np.stack([KM.squares(x, c).T for c in centers])) <= slack).all()
    assert np.array_equal(KM.nearest(x, centers), want)
