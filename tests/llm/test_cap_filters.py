import math
from collections import Counter

import numpy as np
import pytest

from tidepanel.llm import cap_filters
from tidepanel.llm.cap_filters import decode, vector_links

KIND = "vec_id bigint, embedding array<float>, label int, uid string, filter int, vector string, cell int"


def slow_links(rows, least=0.93):
    """All pairs of a label."""
    good = [k for k, (_, e, label) in enumerate(rows) if label is not None and e and all(x is not None and math.isfinite(x) for x in e) and any(e)]
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    unit = {k: np.array(rows[k][1], dtype=np.float64) / np.linalg.norm(np.array(rows[k][1], dtype=np.float64)) for k in good}
    for n, i in enumerate(good):
        for j in good[:n]:
            if rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least:
                links[i] += 1
                links[j] += 1
                root[max(find(i), find(j))] = min(find(i), find(j))
    ids = {}
    for k, row in enumerate(rows):
        if row[0] is not None:
            ids[find(k)] = min(row[0], ids.get(find(k), row[0]))
    return Counter((row[0], links[k], ids.get(find(k)), row[0] == ids.get(find(k))) for k, row in enumerate(rows))


def near(rng, v, cosine):
    z = rng.standard_normal(len(v))
    z -= z @ v * v
    return cosine * v + math.sqrt(1 - cosine**2) * z / np.linalg.norm(z)


def unit(rng, dim):
    v = rng.standard_normal(dim)
    return v / np.linalg.norm(v)


def frame(spark, rows):
    return spark.createDataFrame([(i, [float(x) if x is not None else None for x in e] if e is not None else None, label, "u", 1, "v", 2) for i, e, label in rows], KIND).repartition(3)


def answer(df):
    return Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect())


def odd_rows():
    rng = np.random.default_rng(3)
    f = lambda v: np.float32(v).tolist()
    centres = [unit(rng, 64) for _ in range(6)]
    rows = [(k, f(near(rng, centres[k % 6], c)), k % 2) for k, c in enumerate(np.linspace(0.94, 0.9999, 60))]
    rows += [(100 + k, f(centres[0]), 0) for k in range(40)] + [(150 + k, f(3 * centres[0]), 0) for k in range(3)] + [(200 + k, f(unit(rng, 64)), k % 3) for k in range(200)]
    rows += [(500, None, 0), (501, [], 0), (502, [0.0] * 64, 0), (503, [0.0] * 64, 0), (504, [1.0, None] + [0.0] * 62, 0), (505, [math.nan] * 64, 0), (506, [math.inf] + [0.0] * 63, 0)]
    rows += [(507, f(centres[0]), None), (508, f(centres[0]), None), (None, f(near(rng, centres[1], 0.99)), 1), (None, f(unit(rng, 64)), 1), (3, f(near(rng, centres[3], 0.99)), 1)]
    rows += [(600 + k, f(v), 7) for k, v in enumerate([[1.0], [2.0], [-1.0], [1.0, 0.0], [1.0, 0.1], [0.0, 1.0], [1e-30, 0.0], [3e37, 1e36], [-0.0, 1.0]])]
    return rows


@pytest.mark.parametrize(("few", "cell"), [(32, 1024), (2, 1024), (2, 7)])
def test_all_pairs(spark, monkeypatch, few, cell):
    """Also with every cell taken as a matrix, and with frequent filters cut into blocks of seven."""
    monkeypatch.setattr(cap_filters, "FEW", few)
    monkeypatch.setattr(cap_filters, "CELL", cell)
    rows = odd_rows()
    assert answer(vector_links(frame(spark, rows))) == slow_links(rows)


def test_blocks_of_a_hot_filter_reach_all_pairs(spark, monkeypatch):
    """One tight group of 300 of 600 vectors, cut into blocks of 16."""
    monkeypatch.setattr(cap_filters, "CELL", 16)
    rng = np.random.default_rng(9)
    centre = unit(rng, 64)
    rows = [(k, near(rng, centre, 0.985).tolist(), 1) for k in range(300)] + [(1000 + k, unit(rng, 64).tolist(), 1) for k in range(300)]
    rows = [(i, np.float32(e).tolist(), label) for i, e, label in rows]
    assert answer(vector_links(frame(spark, rows))) == slow_links(rows)


def test_recall_at_the_threshold():
    """Pairs at a cosine of exactly 0.93 share a filter; no vector is without filters."""
    rng = np.random.default_rng(4)
    for dim, least in ((64, 0.998), (8, 0.99), (256, 0.998)):
        x = np.stack([unit(rng, dim) for _ in range(4000)])
        y = np.stack([near(rng, v, 0.93) for v in x])
        met = (decode(x)[:, :, None] == decode(y)[:, None, :]).any((1, 2))
        assert met.mean() >= least, (dim, met.mean())


def test_empty_and_only_unsound(spark):
    assert vector_links(spark.createDataFrame([], KIND)).count() == 0
    rows = [(1, None, 1), (2, [0.0], 1), (2, [1.0], None)]
    assert answer(vector_links(frame(spark, rows))) == Counter({(1, 0, 1, True): 1, (2, 0, 2, True): 2})
