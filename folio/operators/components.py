"""Connected components inside bounded groups (a page, an image), used by H2 and K6."""

from __future__ import annotations


def union_find(n: int, a, b):
    """Component labels of nodes 0..n-1 joined by edges (a[i], b[i]): each node gets the
    smallest node of its component.  Vectorised min-label propagation with pointer
    jumping (numpy), used inside one group (a page, an image) at a time."""
    import numpy as np

    lab = np.arange(n, dtype=np.int64)
    a = np.asarray(a, dtype=np.int64)
    b = np.asarray(b, dtype=np.int64)
    while True:
        m = np.minimum(lab[a], lab[b])
        new = lab.copy()
        np.minimum.at(new, a, m)
        np.minimum.at(new, b, m)
        new = new[new]
        if np.array_equal(new, lab):
            return lab
        lab = new


def whole_groups(batches, keys):
    """Re-cut a stream of pandas batches, sorted by ``keys``, so that no group is split: the
    trailing group's pieces are kept and put together once, when the next group begins."""
    import pandas as pd

    held = []
    for b in batches:
        if not len(b):
            continue
        if held and not (held[-1][keys].iloc[-1] == b[keys].iloc[0]).all():
            yield pd.concat(held, ignore_index=True)
            held = []
        last = (b[keys] == b[keys].iloc[-1]).all(axis=1).to_numpy()
        if not last.all():
            yield pd.concat([*held, b[~last]], ignore_index=True)
            held = []
        held.append(b[last])
    if held:
        yield pd.concat(held, ignore_index=True)
