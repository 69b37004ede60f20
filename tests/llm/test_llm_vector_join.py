"""Vector links against all pairs."""

import numpy as np

from creaseline.llm import vector_join

NAN, INF = float("nan"), float("inf")


def plain(vectors, cosine=vector_join.COSINE):
    ok = []
    for v in vectors:
        x = None if v[1] is None or None in v[1] else np.array(v[1], np.float32).astype(float)
        ok.append(x if x is not None and len(x) and np.isfinite(x).all() and x.any() and v[2] is not None else None)
    n = len(vectors)
    links = {k: set() for k in range(n)}
    for i in range(n):
        for j in range(n):
            if i != j and ok[i] is not None and ok[j] is not None and vectors[i][2] == vectors[j][2] and len(ok[i]) == len(ok[j]):
                if ok[i] @ ok[j] / np.sqrt((ok[i] @ ok[i]) * (ok[j] @ ok[j])) >= cosine:
                    links[i].add(j)
    component = list(range(n))
    for start in range(n):
        todo, seen = [start], {start}
        while todo:
            for k in links[todo.pop()] - seen:
                seen.add(k)
                todo.append(k)
        ids = [vectors[k][0] for k in seen if vectors[k][0] is not None]
        component[start] = min(ids) if ids else None
    return sorted(((v[0], len(links[k]), component[k]) for k, v in enumerate(vectors)), key=str)


def vectors(dimensions, seed):
    rng = np.random.default_rng(seed)
    out = []
    for k in range(40):
        base = rng.standard_normal(dimensions)
        for _ in range(rng.integers(1, 9)):
            noise = rng.standard_normal(dimensions) * rng.choice([0.0, 0.05, 0.12, 0.15])
            out.append(((base + noise) * rng.choice([0.01, 1.0, 90.0])).astype(np.float32).tolist())
    rows = [(k * 3 % 1009, v, int(rng.integers(0, 3))) for k, v in enumerate(out)]
    first = rows[0][1]
    rows += [rows[0], (None, first, rows[0][2]), (2000, first, None), (2001, None, 0), (2002, [0.0] * dimensions, 0)]
    rows += [(2003, [NAN] + first[1:], 0), (2004, [INF] + first[1:], 0), (2005, [None] + first[1:], 0), (2006, [], 0), (2007, first[:-1], 0), (2008, first[:-1], 0)]
    return rows


def test_all_pairs(rows):
    for dimensions, seed in ((64, 1), (10, 2), (5, 3)):
        data = vectors(dimensions, seed)
        table = rows("vec_id long, embedding array<float>, label int, row string", *((*v, "x") for v in data))
        found = vector_join.near_duplicates(table).collect()
        assert sorted(((r.vec_id, r.n_links, r.component_id) for r in found), key=str) == plain(data)
        assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in found)


def test_hot_cell_is_dealt_out(rows, monkeypatch):
    monkeypatch.setattr(vector_join, "AT_ONCE", 20)
    monkeypatch.setattr(vector_join, "PAIRS_AT_ONCE", 50)
    rng = np.random.default_rng(4)
    base = rng.standard_normal(16)
    data = [(k, (base + 0.06 * rng.standard_normal(16)).astype(np.float32).tolist(), 1) for k in range(90)]
    found = vector_join.near_duplicates(rows("vec_id long, embedding array<float>, label int", *data)).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in found), key=str) == plain(data)


def test_equal_vectors_are_joined_once(rows):
    """Many copies of one vector, near ones beside them, and as many that cannot link."""
    rng = np.random.default_rng(7)
    base = rng.standard_normal(16)
    near = lambda: (base + 0.03 * rng.standard_normal(16)).astype(np.float32).tolist()
    copy, other = near(), near()
    data = [(k, copy, 1) for k in range(700)] + [(k, other, 1) for k in range(700, 730)] + [(k, near(), 1) for k in range(730, 750)]
    data += [(k, copy, 2) for k in range(800, 805)] + [(k, [0.0] * 16, 1) for k in range(900, 1000)] + [(k, copy, None) for k in range(1000, 1100)]
    signed = [-0.0 if k == 3 else float(k) for k in range(16)]
    data += [(1200, signed, 3), (1201, [abs(x) for x in signed], 3)]
    table = rows("vec_id long, embedding array<float>, label int", *data)
    found = sorted(((r.vec_id, r.n_links, r.component_id) for r in vector_join.near_duplicates(table).collect()), key=str)
    assert found == plain(data)


def test_cells_in_range():
    rng = np.random.default_rng(6)
    x = rng.standard_normal((50, 3))
    owner, cells = vector_join.cells_in_range(x, 0.4, 0.5)
    for k in range(50):
        mine = {tuple(c) for c in cells[owner == k]}
        for y in x[k] + 0.4 * (u := rng.standard_normal((40, 3))) / np.linalg.norm(u, axis=1, keepdims=True) * rng.random((40, 1)):
            assert tuple(np.floor(y / 0.5).astype(int)) in mine


def test_empty(rows):
    assert vector_join.near_duplicates(rows("vec_id long, embedding array<float>, label int", (1, [1.0], 1)).limit(0)).collect() == []
