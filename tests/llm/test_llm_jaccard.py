"""Jaccard components and components of graphs against plain versions."""

import random

import numpy as np
import pytest

from creaseline.llm import components, jaccard_join, words


def plain_set(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())


def reach(nodes, links):
    least = {}
    for n in sorted(nodes, key=lambda x: (x is None, x or 0)):
        todo, seen = [n], {n}
        while todo:
            for k in links.get(todo.pop(), set()) - seen:
                seen.add(k)
                todo.append(k)
        least[n] = min((k for k in seen if k is not None), default=None)
    return least


def plain_components(docs):
    sets = {k: plain_set(t) for k, t in docs}
    links = {}
    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a != b and sets[a] and 100 * common >= 75 * len(sets[a] | sets[b]):
                links.setdefault(a, set()).add(b)
    least = reach(sets, links)
    return {k: (len(sets[k]), least[k]) for k in sets}


def texts(seed, groups=25, hub=0):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)]
    passage = rng.choices(vocabulary, k=60)
    out = []
    for _ in range(groups):
        base = rng.choices(vocabulary, k=rng.choice([3, 6, 30, 90, 200]))
        if rng.random() < 0.4:
            base = base + passage
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 4, 8])):
                at = rng.randrange(len(copy))
                copy[at] = rng.choice(vocabulary)
            out.append(" ".join(copy) if rng.random() < 0.7 else "\t".join(copy).upper())
    base = rng.choices(vocabulary, k=120)
    for _ in range(hub):
        copy = list(base)
        for _ in range(rng.choice([1, 2, 3, 4])):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        out.append(" ".join(copy))
    return [(k * 7 % 10007, t) for k, t in enumerate(out)]


@pytest.mark.parametrize("seed, hub, rounds", [(1, 0, (1, 4, 8)), (2, 60, (1, 2)), (3, 40, ())])
def test_components(rows, monkeypatch, seed, hub, rounds):
    monkeypatch.setattr(jaccard_join, "FREQUENT", 3)
    monkeypatch.setattr(jaccard_join, "HUBS", rounds)
    docs = texts(seed, hub=hub) + [(20000, None), (20001, ""), (20002, " \n"), (20003, "a b c"), (20004, "A B c"), (20005, "x " * 3000)]
    table = rows("doc_id long, text string, n int", *((*d, 1) for d in docs))
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(table.repartition(4)).collect()}
    assert found == plain_components(docs)


def test_null_and_repeated_ids(rows):
    table = rows("doc_id long, text string", (None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (9, "z"), (None, "q"), (None, None))
    found = sorted(((r.doc_id, r.component_id) for r in jaccard_join.jaccard_components(table).collect()), key=str)
    assert found == sorted([(None, 4), (4, 4), (4, 4), (9, 9), (None, None), (None, None)], key=str)
    kept = jaccard_join.keep_first(table).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept if r.doc_id) == [("4", "a b c d e f"), ("9", "z")]
    assert jaccard_join.jaccard_components(table.limit(0)).collect() == []


def test_prefix_length():
    assert [jaccard_join.prefix_length(n) for n in (1, 2, 3, 4, 5, 8, 100)] == [1, 1, 1, 2, 2, 3, 26]


def test_packed_lists():
    for values in ([], [0], [5, 5, 5], [0, 2**32 - 1], [1, 65536, 65537, 200000, 4294967290]):
        array = np.array(values, np.uint32)
        assert jaccard_join.unpacked(jaccard_join.packed(array)).tolist() == values


def test_shingles():
    seen = words.WordHashes()
    same = words.shingle_set("The CAT sat on the mat", seen).tolist()
    assert same == words.shingle_set(b"the cat\x0bsat on\tthe  mat", seen).tolist() and len(same) == 2
    assert len(words.shingle_set("ÄB", seen)) == 1 and words.shingle_set("ÄB", seen).tolist() != words.shingle_set("äb", seen).tolist()
    assert words.shingle_set(None, seen).tolist() == [] == words.shingle_set(" ", seen).tolist()


def test_graph_components(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)] + [(k, k + 1) for k in range(1000, 1060)] + [(1, 1)]
    links = {}
    for a, b in edges:
        links.setdefault(a, set()).add(b)
        links.setdefault(b, set()).add(a)
    nodes = {n for e in edges for n in e if e[0] != e[1]}
    table = spark.createDataFrame([*edges, (None, 3)], "x long, y long")
    found = components.component_labels(table, "x", "y").collect()
    assert {r.node: r.component for r in found} == {n: reach(nodes, links)[n] for n in nodes}
    assert len(found) == len(nodes)
    assert components.component_labels(table.limit(0), "x", "y").collect() == []


def test_rows_are_kept_by_row_not_by_id(rows):
    """Unlinked texts of one id both stay; of near copies one stays, also without an id."""
    near = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    values = [(1, "one two three four five six"), (1, "seven eight nine ten eleven twelve"), (None, near), (None, near + " 1"), (None, None), (None, ""), (7, "p q r s t z"), (5, "p q r s t z"), (None, "p q r s t z")]
    kept = jaccard_join.keep_first(rows("doc_id long, text string", *values)).collect()
    wanted = [values[0], values[1], values[2], values[4], values[5], values[7]]
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, wanted))


def test_partial_overlaps_of_the_order_add_up():
    """Cut at the pivots, two sets share as much as whole, but for n-grams of a single set."""
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.choice(rng.integers(0, 2**64, 400, dtype=np.uint64), 150)) for _ in range(1)]
    sets += [np.unique(np.concatenate([rng.choice(sets[0], 90), rng.integers(0, 2**64, 40, dtype=np.uint64)])) for _ in range(12)]
    short = np.concatenate([(s >> np.uint64(32)).astype(np.uint32) for s in sets])
    values, times = np.unique(short, return_counts=True)
    bits = np.zeros(1 << jaccard_join.FILTER_BITS, bool)
    bits[values[times > 1] >> np.uint32(32 - jaccard_join.FILTER_BITS)] = True
    often = times >= 5
    order = jaccard_join.Order(np.packbits(bits, bitorder="little").tobytes(), values[often], times[often].astype(np.uint32))
    cut = [dict(order.fragments(s)) for s in sets]
    used = sorted({k for c in cut for k in c})
    assert used == list(range(jaccard_join.COMMON_FRAGMENTS + jaccard_join.FREQUENT_FRAGMENTS))
    for a in range(len(sets)):
        for b in range(a):
            parts = [len(np.intersect1d(cut[a].get(k, []), cut[b].get(k, []))) for k in used]
            assert sum(parts) == len(np.intersect1d(sets[a], sets[b]))
    most = {k: max((times[values == v][0] for c in cut for v in (c.get(k, np.empty(0, np.uint64)) >> np.uint64(32)).astype(np.uint32)), default=0) for k in used}
    frequent = [most[k] for k in used[jaccard_join.COMMON_FRAGMENTS :]]
    assert frequent == sorted(frequent) and max(most[k] for k in used[: jaccard_join.COMMON_FRAGMENTS]) < 5
