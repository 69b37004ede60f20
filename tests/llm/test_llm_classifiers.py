"""Quality and toxicity: definitions, held-out accuracy, and awkward rows."""

import math
import random
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from creaseline.llm import quality, toxicity


def labelled(rows):
    rng = random.Random(2)
    words = [f"wort{k}" for k in range(400)]
    bad_words = ["oaf", "wretch", "fool", "knave"]
    docs, labels = [], []
    for k in range(600):
        text = rng.choices(words, k=rng.choice([20, 60, 400]))
        toxic = k % 8 == 0
        if toxic:
            for _ in range(4):
                text.insert(rng.randrange(len(text)), rng.choice(bad_words).upper() + "!")
        junk = k % 6 == 1
        body = " ".join(w + "###" for w in text) if junk else " ".join(text)
        docs.append((k, body, f"s{k % 5}" if k % 3 else "s0", "en" if k % 2 else None, "x"))
        if k % 10 != 9:
            labels.append((k, int(not junk), int(toxic)))
    docs += [(1000, None, None, None, "x"), (1001, "", "new", "en", "x"), (1002, "wort1 " * 30000, "s0", "en", "x"), (None, "oaf fool", "s1", "en", "x"), (0, docs[0][1], "s1", "en", "x")]
    labels += [(None, 1, 1), (5, None, None), (7777, 0, 1)]
    return docs, labels, rows("doc_id long, text string, source string, lang string, evidence string", *docs), rows("doc_id long, quality int, toxic int", *labels)


def test_toxicity(rows):
    docs, labels, d, marks = labelled(rows)
    found = toxicity.toxicity_scores(d, marks).collect()
    assert len(found) == len(docs)
    right = []
    for r in found:
        held = zlib.crc32(str(r.doc_id).encode() if r.doc_id is not None else b"") % 4 == 2
        assert r.held_out == held and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        if r.doc_id is not None and r.doc_id < 600 and held:
            right.append(r.predicted == int(r.doc_id % 8 == 0))
    assert sum(right) >= 0.97 * len(right)
    assert len({r.score for r in found if r.doc_id == 0}) == 1


def test_shard_pass_is_ftrl_proximal():
    """Against the published update, one coordinate at a time."""
    rng = random.Random(5)
    places = [[0, *sorted(rng.sample(range(1, 30), rng.randrange(9)))] for _ in range(120)]
    toxic = [rng.randrange(2) for _ in places]
    z, n = [0.0] * 30, [0.0] * 30

    def weight(i):
        l1 = toxicity.L1 if i else 0.0
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((toxicity.BETA + math.sqrt(n[i])) / toxicity.ALPHA + toxicity.L2)

    for at, y in zip(places, toxic):
        w = {i: weight(i) for i in at}
        g = 1 / (1 + math.exp(-sum(w.values()))) - y
        for i in at:
            sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / toxicity.ALPHA
            z[i] += g - sigma * w[i]
            n[i] += g * g
    found = toxicity.run_shard([np.array(a) for a in places], np.array(toxic, float), np.zeros(30), np.zeros(30))
    assert found[0] == pytest.approx(z) and found[1] == pytest.approx(n)
    assert toxicity.weights_of(*found) == pytest.approx([weight(i) for i in range(30)])


def test_logistic_line():
    rng = np.random.default_rng(3)
    margin = rng.normal(0, 2, 20000)
    toxic = (rng.random(20000) < 1 / (1 + np.exp(-(1.5 * margin - 0.7)))).astype(float)
    assert toxicity.logistic_line(margin, toxic) == pytest.approx((1.5, -0.7), abs=0.1)
    assert toxicity.logistic_line(-margin, toxic) == (1.0, 0.0)


def test_rounds_shuffle_and_store_nothing(rows, monkeypatch):
    """Shards are dealt once from the stored sample; what they add comes as it is and is averaged per place."""
    stored, rounds = [], []
    settled, round_sums = toxicity.settled, toxicity.round_sums
    monkeypatch.setattr(toxicity, "settled", lambda df, name: stored.append(name) or settled(df, name))

    def watched(*args):
        rounds.append(round_sums(*args))
        return rounds[-1]

    monkeypatch.setattr(toxicity, "round_sums", watched)
    _, _, d, marks = labelled(rows)
    toxicity.fitted(d, marks)
    assert stored == ["toxic-sample", "toxic-features", "toxic-places"]
    plans = [r._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0] for r in rounds]  # as they ran
    assert len(plans) == toxicity.ROUNDS and all("Final Plan" in p and "Exchange" not in p for p in plans)


def test_states_move_by_the_average_of_the_shards_that_met_a_place():
    states = [(np.zeros(4), np.zeros(4)), (np.ones(4), np.zeros(4))]
    moved = [(0, 1, 2.0, 4.0), (0, 1, 4.0, 6.0), (0, 3, 1.0, 1.0), (1, 0, -3.0, 2.0)]
    toxicity.add_averages(states, pa.table(dict(zip(("model", "place", "dz", "dn"), map(list, zip(*moved))))))
    assert [s.tolist() for s in states[0]] == [[0, 3, 0, 1], [0, 5, 0, 1]]
    assert [s.tolist() for s in states[1]] == [[-2, 1, 1, 1], [2, 0, 0, 0]]


def test_toxicity_on_held_out_labels(spark):
    """Of the driver's documents: nearly all toxic ones, few others."""
    folder = Path("/root/testdata/sf0.1")
    if not folder.exists():
        pytest.skip("needs the driver's tables")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = toxicity.toxicity_scores(spark.read.parquet(f"{folder}/documents.parquet"), labels)
    rows = found.where("held_out").join(labels.where("toxic is not null"), "doc_id").select("predicted", "toxic").collect()
    hits = sum(r.predicted and r.toxic for r in rows)
    recall, precision = hits / sum(r.toxic for r in rows), hits / sum(r.predicted for r in rows)
    print(f"recall {recall:.3f}, precision {precision:.3f}, of {sum(r.toxic for r in rows)}")
    assert recall >= 0.88 and precision >= 0.9


def test_toxicity_without_labels(rows):
    _, _, d, marks = labelled(rows)
    assert all(r.score < 0.01 for r in toxicity.toxicity_scores(d, marks.limit(0)).collect())
    assert toxicity.toxicity_scores(d.limit(0), marks).collect() == []


def test_labels_that_are_held_out_change_nothing(rows):
    _, labels, d, marks = labelled(rows)
    flipped = [(k, q, 1 - t if k is not None and t is not None and zlib.crc32(str(k).encode()) % 4 == 2 else t) for k, q, t in labels]
    again = rows("doc_id long, quality int, toxic int", *flipped)
    scores = lambda m: sorted(str(r.score) for r in toxicity.toxicity_scores(d, m).collect())
    assert scores(marks) == scores(again)


def test_quality(rows):
    docs, _, d, marks = labelled(rows)
    found = quality.quality_scores(d, marks).collect()
    assert len(found) == len(docs)
    unlabelled = [r.kept == (r.doc_id % 6 != 1) for r in found if r.doc_id is not None and r.doc_id < 600 and r.doc_id % 10 == 9]
    assert sum(unlabelled) >= 0.98 * len(unlabelled)
    kept = quality.kept_documents(d, marks)
    assert kept.columns == d.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in found if r.kept)


def test_quality_without_labels_keeps_everything(rows):
    _, _, d, marks = labelled(rows)
    assert quality.kept_documents(d, marks.limit(0)).count() == d.count()
    assert quality.quality_scores(d.limit(0), marks).collect() == []


def test_site_rates_shrink(rows):
    """Against the same sums in plain Python."""
    data = [("a", "x", 1.0)] * 30 + [("a", "y", 0.0)] * 2 + [("b", "x", 0.2)] * 40 + [("b", "y", 0.9)] + [("c", None, 0.5)]
    data = [(h, p, min(1.0, max(0.0, s + 0.01 * (k % 7)))) for k, (h, p, s) in enumerate(data)]
    sites, path_weight = quality.site_rates(rows("source string, lang string, _p double", *data), "source", "lang")
    centre = sum(p for *_, p in data) / len(data)

    def weight(groups, centres):
        n, total = len(groups), sum(map(len, groups))
        inside = sum(sum(p * p for p in g) - sum(g) ** 2 / len(g) for g in groups)
        within = max(inside / (total - n), 1e-6)
        between = sum(len(g) * (sum(g) / len(g) - c) ** 2 for g, c in zip(groups, centres))
        spread = (between - (n - 1) * within) / max(total - sum(len(g) ** 2 for g in groups) / total, 1.0)
        return min(1e6, within / spread) if spread > 0 else 1e6

    hosts = {h: [p for x, _, p in data if x == h] for h in "abc"}
    w = weight(list(hosts.values()), [centre] * 3)
    host_rate = {h: (w * centre + sum(g)) / (w + len(g)) for h, g in hosts.items()}
    paths = {}
    for h, q, p in data:
        paths.setdefault((h, q), []).append(p)
    v = weight(list(paths.values()), [host_rate[h] for h, _ in paths])
    assert path_weight == pytest.approx(v)
    for r in sites.collect():
        g = paths[(r.source, r.lang)]
        assert r.host_rate == pytest.approx(host_rate[r.source])
        assert r.path_rate == pytest.approx((v * host_rate[r.source] + sum(g)) / (v + len(g)))
