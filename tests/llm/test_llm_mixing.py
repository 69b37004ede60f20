"""Targets and seats against plain versions; laws of what is taken."""

import re

import pytest

from creaseline.llm import mixing


def plain_targets(sizes: dict, weights=(1, 2, 3), most=3) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    total, stopped = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in stopped]
        rest = total - sum(stopped.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return stopped | share
        stopped |= {s: float(most * sizes[s]) for s in over}


def documents(rows):
    texts = []
    for k in range(400):
        source = ["a", "b", "b", "b", "b", None, "ü", "z"][k % 8]
        texts.append((k, " ".join(["w"] * (k % 37)) + "\t\n" if k % 9 else None, source, k))
    texts += [(1000, "only three words", "tiny", 0), (1000, "only three words", "tiny", 0), (1001, "", "hollow", 0), (None, "a b", "a", 0)]
    texts += [(1002, "v " * 5000, "long", 0)]
    return rows("doc_id long, text string, source string, target int", *texts)


def test_targets_and_cuts(rows):
    docs = documents(rows)
    sizes, known = {}, {}
    for r in docs.collect():
        known.setdefault(r.doc_id, (r.source, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))))
        sizes[r.source] = sizes.get(r.source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    wanted = plain_targets(sizes)
    for per_shard in (10, 2000):
        found = mixing.mixed(docs, docs_per_shard=per_shard).collect()
        assert len(found) == docs.count()
        taken = {}
        for r in found:
            assert (r.source, r["size"]) == known[r.doc_id]
            assert r.source_size == sizes[r.source]
            assert r.target == pytest.approx(wanted[r.source])
            assert 0 <= r.taken <= 3 * r["size"]
            assert r.taken == r.full_copies * r["size"] + r.part_end - r.part_start + r.head_end
            taken[r.source] = taken.get(r.source, 0) + r.taken
        shards = {s: sum(r.source == s for r in found) // per_shard + 2 for s in sizes}
        for source, words in taken.items():
            assert abs(words - wanted[source]) <= 16 * (shards[source] + 1)


def test_rerun_agrees(rows):
    docs = documents(rows)
    once = sorted(map(str, mixing.mixed(docs).collect()))
    assert once == sorted(map(str, mixing.mixed(docs.repartition(7)).collect()))
    assert once != sorted(map(str, mixing.mixed(docs, seed=8).collect()))


def test_documents_follow_the_plan(rows):
    docs = documents(rows)
    plan = {}
    for r in mixing.mixed(docs).collect():
        plan[r.doc_id] = plan.get(r.doc_id, 0) + r.taken
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    words = {}
    for r in mixed.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len((r.text or "").split())
    assert words == {k: n for k, n in plan.items() if n}


def test_many_equal_rows_and_clashing_names(rows, monkeypatch):
    """A third of the rows are equal, as many are null; columns are named like those of the plan."""
    monkeypatch.setattr(mixing, "COPIES_AT_ONCE", 7)
    data = [(1, "x y z", "a", 5, 6, 7, 3)] * 120 + [(None, None, None, 1, 2, 3, None)] * 120
    data += [(k, "u " * (k % 40), "abc"[k % 3], k, k, k, k) for k in range(2, 122)]
    docs = rows("doc_id long, text string, source string, size int, _cut int, copies int, n_chars int", *data)
    plan = {}
    for r in mixing.mixed(docs).collect():
        plan[r.doc_id] = plan.get(r.doc_id, 0) + r.taken
    mixed = mixing.mixed_documents(docs)
    assert mixed.schema["n_chars"] == docs.schema["n_chars"] and mixed.columns == docs.columns
    words, known = {}, {d[0]: d[3:6] for d in data}
    for r in mixed.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
        assert (r["size"], r["_cut"], r["copies"]) == known[r.doc_id] and r.n_chars == len(r.text)
    assert words == {k: n for k, n in plan.items() if n}


def seats(shares: dict, number: int) -> dict:
    """Sainte-Laguë, one seat after the other."""
    won = dict.fromkeys(shares, 0)
    for _ in range(number):
        won[max(sorted(shares), key=lambda s: shares[s] / (2 * won[s] + 1))] += 1
    return won


@pytest.mark.parametrize("number", [1, 7, 100, 1001])
def test_seats(rows, number):
    shares = {f"s{k}": float((k * 7919) % 101 + k) for k in range(1, 12)}
    table = rows("source string, share double, blocks long, limit long, all int", *((s, x, number, 10**9, 0) for s, x in shares.items()))
    found = mixing.apportioned(table, "blocks", ["source"], ["all"], "limit", ["source"]).collect()
    assert {r.source: r.quota for r in found} == seats(shares, number)


def test_empty(rows):
    assert mixing.mixed(documents(rows).limit(0)).collect() == []
