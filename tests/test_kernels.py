import numpy as np
import pytest
from lumivox.operators import kernels as k
from lumivox.operators import register


def volume(seed=0, shape=(9, 8, 7)):
    return np.random.default_rng(seed).integers(0, 50, shape).astype(float)


def direct(a, b):
    out = np.zeros([x + y - 1 for x, y in zip(a.shape, b.shape)])
    for at in np.ndindex(b.shape):
        out[tuple(slice(i, i + n) for i, n in zip(at, a.shape))] += a * b[at]
    return out


@pytest.mark.parametrize(("shape", "kernel"), [((5, 6), (3, 3)), ((6, 5, 4), (2, 3, 1))])
def test_fft_convolution(shape, kernel):
    a, b = volume(1, shape), volume(2, kernel)
    full = direct(a, b)
    assert np.allclose(k.fft_convolve(a, b), full)
    start = [int(np.ceil((n - 1) / 2)) for n in kernel]
    assert np.allclose(k.fft_convolve(a, b, "same"), full[tuple(slice(s, s + n) for s, n in zip(start, shape))])
    assert np.allclose(k.fft_convolve(a, b, "valid"), full[tuple(slice(m - 1, n) for m, n in zip(kernel, shape))])


def test_separable_equals_full_kernel():
    a, w = volume(3), [k.gaussian(3, 1.0), k.gaussian(5, 2.0), k.gaussian(4, 1.5)]
    dense = w[0][:, None, None] * w[1][None, :, None] * w[2][None, None, :]
    padded = np.pad(a, [(1, 1), (2, 2), (2, 1)], mode="symmetric")
    want = np.array([[[(padded[y : y + 3, x : x + 5, z : z + 4] * dense).sum() for z in range(7)] for x in range(8)] for y in range(9)])
    assert np.allclose(k.separable(a, w), want)


def test_opening_and_closing():
    a = volume(4)
    opened = k.open_sphere(a, 1)
    assert (opened <= a).all() and np.array_equal(k.open_sphere(opened, 1), opened)
    closed = k.close_disk(a[:, :, 0], 2)
    assert (closed >= a[:, :, 0]).all() and np.array_equal(k.close_disk(closed, 2), closed)


def test_pchip_keeps_shape():
    x, y = np.arange(1, 8), np.array([0, 0, 1, 5, 5, 2, 8.0])
    at = np.linspace(1, 7, 61)
    got = k.pchip(x, y, at)
    assert np.allclose(got[::10], y)
    for a, b in zip(range(6), range(1, 7)):
        piece = np.diff(got[10 * a : 10 * b + 1])
        assert (piece >= -1e-12).all() or (piece <= 1e-12).all()
    assert np.allclose(k.pchip(x, 2.0 * x, at), 2 * at)


def test_otsu_separates_two_bumps():
    counts, centres = np.zeros(100), np.arange(100.0)
    counts[20:30], counts[70:80] = 10, 3
    assert 29 <= k.otsu(counts, centres) < 70


def test_watershed_divides_two_basins():
    z = np.full((5, 11, 1), 9.0)
    z[2, 2], z[2, 8] = 0, 0
    for x in range(11):
        z[:, x] = np.minimum(z[:, x], min(abs(x - 2), abs(x - 8)))
    labels = k.watershed(z, np.ones_like(z, bool))
    assert labels[2, 2, 0] != labels[2, 8, 0] and set(np.unique(labels)) <= {0, 1, 2}
    assert (labels[:, :4] == labels[2, 2, 0]).all() and (labels[:, 7:] == labels[2, 8, 0]).all()
    assert k.watershed(z, z < 0).max() == 0


def test_components():
    mask = np.zeros((4, 4, 1), bool)
    mask[0, 0] = mask[1, 1] = mask[3, 3] = True
    assert k.components(mask).max() == 3 and k.components(mask, faces=False).max() == 2


@pytest.mark.parametrize("shift", [(2, -1, 1), (0, 0, 0), (-3, 2, 0)])
def test_phase_shift(shift):
    rng = np.random.default_rng(7)
    base = k.separable(rng.random((32, 32, 16)), [k.gaussian(5, 1.0)] * 3)
    moved = np.roll(base, [-s for s in shift], axis=(0, 1, 2))
    assert k.phase_shift(base, moved, (4, 4, 4)) == shift


def test_harris_finds_a_corner_and_descriptor_is_scaled():
    v = np.zeros((30, 30, 20))
    v[10:20, 10:20, 6:14] = 100
    found = k.harris(v)
    assert len(found) and all(min(abs(p - c) for c in edge) <= 3 for p, edge in zip(found[0], ((10, 19), (10, 19), (6, 13))))
    assert len(k.icosphere()) == 80
    d = k.descriptor(v, (10, 10, 6))
    assert d.shape == (640,) and 0 < d.max() <= 255
    assert k.descriptor(np.zeros((20, 20, 20)), (5, 5, 5)).sum() == 0


def test_blocks_agree_with_the_whole_volume(spark):
    a = volume(8, (12, 10, 6))
    rows = [(int(y) + 1, int(x) + 1, int(z) + 1, float(a[y, x, z])) for y, x, z in np.ndindex(a.shape)]
    df = spark.createDataFrame(rows, "y int, x int, z int, value double")
    got = k.map_blocks(df, lambda b: k.dog(b, mode="constant"), (5, 4, 6), 6).collect()
    want = k.dog(np.pad(a, 6), mode="constant")[6:-6, 6:-6, 6:-6]
    assert len(got) == a.size
    assert all(np.isclose(r["value"], want[r["y"] - 1, r["x"] - 1, r["z"] - 1]) for r in got)


def test_ransac_recovers_a_transform_among_outliers():
    rng = np.random.default_rng(9)
    m = np.array([[1.02, 0.01, 0, 3], [0, 0.98, 0.02, -2], [0.01, 0, 1, 1]])
    a = rng.uniform(1, 100, (80, 3))
    b = np.column_stack([a, np.ones(80)]) @ m.T
    b[::3] += rng.uniform(20, 50, b[::3].shape)
    found, inside = register.ransac(a, b, (1, 1, 1), seed=3)
    assert np.allclose(found, m, atol=1e-6) and inside.sum() == 80 - len(b[::3])
    again, _ = register.ransac(a, b, (1, 1, 1), seed=3)
    assert np.array_equal(found, again)
    assert register.ransac(a[:3], b[:3], (1, 1, 1))[1].sum() == 0


def test_thin_plate_passes_through_its_points():
    rng = np.random.default_rng(10)
    a = rng.uniform(0, 30, (20, 3))
    b = a + rng.normal(size=a.shape)
    assert np.allclose(register.ThinPlate(a, b)(a), b, atol=1e-6)


def test_affine_fit_and_warp(spark):
    rng = np.random.default_rng(11)
    a = rng.uniform(1, 40, (30, 3))
    m = [1.1, 0, 0.1, 2, 0, 0.9, 0, 1, 0.05, 0, 1, -1]
    b = np.column_stack([a, np.ones(30)]) @ np.array(m).reshape(3, 4).T
    df = spark.createDataFrame(np.hstack([a, b]).tolist(), "my double, mx double, mz double, fy double, fx double, fz double")
    assert np.allclose(register.fit_affine(df), m)
    voxels = spark.createDataFrame([(3, 3, 3, 8.0)], "y int, x int, z int, value double")
    got = register.warp_voxels_affine(voxels, [1, 0, 0, 0.5, 0, 1, 0, 0, 0, 0, 1, 0], (5, 5, 5)).collect()
    assert {(r["y"], r["x"], r["z"]): r["value"] for r in got} == {(3, 3, 3): 4.0, (4, 3, 3): 4.0}
