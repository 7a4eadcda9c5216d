"""The cheapest edges between components, without a comparison of all places with all."""

import numpy as np
import pandas as pd
import pytest

from sparkkit.operators import hierarchy
from sparkkit.plans import neighbours as nb


@pytest.mark.parametrize("metric,alpha,bound", [("euclidean", 1.0, np.inf), ("manhattan", 1.3, np.inf), ("chebyshev", 1.0, 0.45)])
def test_cheapest_edges_meet_near_boxes_only(monkeypatch, metric, alpha, bound):
    rng = np.random.default_rng(3)
    x = np.round(rng.uniform(0, 30, (1_500, 2)), 1)
    rows = pd.DataFrame({"part": 0.0, "node": rng.permutation(1_500), "x": list(x), "core": rng.choice([0.2, 0.5], 1_500), "comp": (x[:, 0] // 5 + 6 * (x[:, 1] // 5)).astype(int), "bound": bound})
    cells, length = [], nb._length

    def counted(gaps, metric):
        out = length(gaps, metric)
        cells.append(out.size)
        return out

    monkeypatch.setattr(nb, "_length", counted)
    got = hierarchy._cheapest(rows.iloc[:700], rows, alpha, metric)
    assert sum(cells) < 700 * 1_500 / 4
    core, comp, node = (rows[c].to_numpy() for c in ("core", "comp", "node"))
    w = np.maximum(np.maximum(nb.norm(x[:700, None] - x[None], metric) / alpha, core[:700, None]), core[None])
    want = {}
    for i, j in zip(*np.nonzero((comp[:700, None] != comp[None]) & (w <= bound))):
        edge = (w[i, j], min(node[i], node[j]), max(node[i], node[j]), comp[j])
        want[comp[i]] = min(want.get(comp[i], edge), edge)
    assert {r.comp: (r.w, r.a, r.b, r.to) for r in got.itertuples()} == want
