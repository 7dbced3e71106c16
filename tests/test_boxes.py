import numpy as np
import pandas as pd
import pytest

from geokernel.operators import change, tiles


def cloud(n, seed, steps=128):
    p = np.random.default_rng(seed).integers(0, (4 * steps, 4 * steps, steps), (n, 3)) / steps
    return pd.DataFrame(p, columns=list("xyz")).assign(id=np.arange(n))


def tilted(q, seed=5):
    n = np.random.default_rng(seed).normal(size=(len(q), 3))
    n[: len(q) // 2] *= [0.1, 0.1, 1.0]
    n /= np.sqrt((n * n).sum(axis=1))[:, None]
    return q.assign(nx=n[:, 0], ny=n[:, 1], nz=n[:, 2])


def expected(q, p, radius, depth):
    d = p[["x", "y", "z"]].to_numpy() - q[["x", "y", "z"]].to_numpy()[:, None]
    along = (d * q[["nx", "ny", "nz"]].to_numpy()[:, None]).sum(axis=2)
    inside = (np.abs(along) <= depth) & ((d * d).sum(axis=2) - along * along <= radius * radius)
    late = p["late"].to_numpy()
    return {f"{c}{e}": (inside * (late == e) * along**k).sum(axis=1) for k, c in enumerate(("n", "s", "ss")) for e in (0, 1)}


@pytest.mark.parametrize("upright", (True, False))
@pytest.mark.parametrize("depth", (0.5, 60.0))
def test_cylinders_hold_what_all_pairs_say(upright, depth):
    q, p = cloud(300, 1), cloud(2500, 2).drop(columns="id")
    p["late"] = np.arange(len(p)) % 3 == 0
    q = q.assign(nx=0.0, ny=0.0, nz=1.0) if upright else tilted(q)
    got = change._cylinders(0.75, depth)(q, p).set_index("id").loc[q["id"]]
    for name, want in expected(q, p, 0.75, depth).items():
        assert np.allclose(got[name], want, rtol=1e-9, atol=1e-9), name


def test_balls_hold_what_all_pairs_say():
    q, p = cloud(300, 3), cloud(2500, 4).drop(columns="id")
    got = change._moments((0.25, 1.0))(q, p).set_index("id").loc[q["id"]]
    d2 = ((p[["x", "y", "z"]].to_numpy() - q[["x", "y", "z"]].to_numpy()[:, None]) ** 2).sum(axis=2)
    for s, radius in enumerate((0.25, 1.0)):
        assert (got[f"n_{s}"] == (d2 <= radius * radius).sum(axis=1)).all()


def test_edges_decide_by_the_differences_of_places():
    """Decimal places whose distance is the radius up to rounding: what their differences say holds."""
    p = pd.DataFrame({"x": np.arange(60) / 10, "y": np.arange(60) % 7 / 10, "z": np.arange(60) % 5 / 10})
    q = p.assign(id=np.arange(60))
    a = p.to_numpy() - np.floor(p.to_numpy().min(axis=0))
    want = (((a - a[:, None]) ** 2).sum(axis=2) <= 0.25).sum(axis=1)
    assert (change._moments((0.5,))(q, p).set_index("id").loc[q["id"], "n_0"] == want).all()


def test_a_denser_cloud_is_compared_at_its_edges_only(monkeypatch):
    compared, points = [], tiles.Boxes.points

    def counted(self, boxes):
        for x in points(self, boxes):
            compared.append(len(x))
            yield x

    monkeypatch.setattr(tiles.Boxes, "points", counted)
    work = []
    for n in (5_000, 80_000):
        q, p = cloud(n // 5, 6).assign(nx=0.0, ny=0.0, nz=1.0), cloud(n, 7).drop(columns="id").assign(late=False)
        compared.clear()
        change._cylinders(1.5, 60.0)(q, p)
        work.append(sum(compared) * tiles.QUERIES)
    # Sixteen times the points and queries are 256 times the pairs.
    assert work[1] < 110 * work[0]
    assert work[1] < 0.3 * 80_000 * 16_000 * 0.4
