"""Containment search against all pairs."""

import random

from creaseline.llm import decontaminate
from test_llm_jaccard import plain_set


def tables(rows):
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(2000)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([1, 4, 5, 9, 14, 30, 60, 150])))) for k in range(80)]
    docs = []
    for k in range(200):
        body = rng.choices(vocabulary, k=rng.choice([5, 100, 3000]))
        for _ in range(rng.randint(0, 2)):
            passage = rng.choice(items)[1].split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                passage[rng.randrange(len(passage))] = "other"
            at = rng.randrange(len(body))
            body[at:at] = passage
        docs.append((k, " ".join(body).upper()))
    docs += [(300, None), (301, ""), (None, items[5][1] + " " + items[6][1]), (302, items[0][1]), (302, items[0][1])]
    items += [(90, None), (91, " "), (None, "x y z q r s"), (5, items[5][1])]
    return docs, items, rows("doc_id long, text string, item long", *((*d, 0) for d in docs)), rows("item_id long, text string", *items)


def plain(docs, items):
    out = []
    for d, text in docs:
        own = plain_set(text)
        for i, t in items:
            s = plain_set(t)
            if s and 4 * len(s & own) >= 3 * len(s):
                out.append((d, i, len(s), len(s & own)))
    return sorted(out, key=str)


def test_all_pairs(rows, monkeypatch):
    docs, items, d, b = tables(rows)
    for size in (decontaminate.BLOCK_BYTES, 4000):
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", size)
        found = [tuple(r) for r in decontaminate.contained_items(d.repartition(3), b).collect()]
        assert sorted(found, key=str) == plain(docs, items)
    kept = {r.doc_id for r in decontaminate.decontaminated(d, b).collect()}
    assert kept == {k for k, _ in docs} - {r[0] for r in found}


def test_empty(rows):
    _, _, d, b = tables(rows)
    assert decontaminate.contained_items(d.limit(0), b).collect() == []
    assert decontaminate.contained_items(d, b.limit(0)).collect() == []
    assert decontaminate.decontaminated(d, b.limit(0)).count() == d.count()


def test_leaks_go_by_row_not_by_id(rows):
    passage = "one two three four five six seven eight"
    docs = [(None, "x " + passage), (None, "a clean text without an id at all"), (3, passage), (3, "another clean text that repeats an id"), (4, None)]
    left = decontaminate.decontaminated(rows("doc_id long, text string", *docs), rows("item_id long, text string", (1, passage)))
    assert sorted(map(str, map(tuple, left.collect()))) == sorted(map(str, [docs[1], docs[3], docs[4]]))
