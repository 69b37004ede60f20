"""Runs against every stretch and period tried in turn."""

import hashlib
import re
import zlib

import numpy as np
import pytest

from creaseline.llm import catalog, repeats


def plain_runs(words):
    """(start, length, period): for each period the maximal stretches, kept if no smaller period fits."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q):
                stretch = words[i : i + length]
                if not any(all(x == y for x, y in zip(stretch, stretch[p:])) for p in range(1, q)):
                    found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_collapsed(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def random_texts(count, rng):
    for _ in range(count):
        parts = []
        for _ in range(rng.integers(0, 6)):
            unit = rng.choice(list("abc"), rng.integers(1, 9)).tolist()
            parts += unit * rng.integers(1, 9)
            parts += rng.choice(list("abc"), rng.integers(0, 5)).tolist()
        yield " ".join(parts)


CASES = [
    None, "", " \n ", "a", "a a a a a", "a a a a a a", "a b " * 3, "a b " * 4, "a b a b a b a b a", "a a a a a a b a a a a a a b a a a a a a b a a a a a a b",
    "x " * 5000, "a b c d e f g " * 700 + "tail", "é x é x é x é x é x é x", "A a A a A a A a", "a\x1cb " * 7, "a\tb\x0bc\r\n" * 5,
]


@pytest.fixture(scope="module")
def texts():
    return CASES + list(random_texts(400, np.random.default_rng(9)))


def test_runs_and_collapsed_text(rows, texts):
    docs = rows("doc_id long, text string, runs string, row int, collapsed int", *((k, t, "r", k, 1) for k, t in enumerate(texts)))
    got = repeats.word_runs(docs.repartition(3)).collect()
    assert len(got) == len(texts)
    for r in got:
        words = words_of(texts[r.row.doc_id])
        runs = [(x.start, x["length"], x.period) for x in r.runs]
        if len(words) < 2000:
            assert runs == plain_runs(words), words
        assert r.collapsed == plain_collapsed(words, runs)
        assert r.row.runs == "r" and r.row.row == r.row.doc_id


def test_long_texts_have_one_run(rows):
    docs = rows("doc_id long, text string", (1, "x " * 300_000), (2, " ".join(f"w{k % 977}" for k in range(100_000))))
    got = {r.row.doc_id: [tuple(x) for x in r.runs] for r in repeats.word_runs(docs).collect()}
    assert got == {1: [(0, 300_000, 1)], 2: [(0, 100_000, 977)]}


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def check_query(found, texts):
    assert len(found) == len(texts)
    for r in found:
        words = words_of(texts[r.doc_id]) if r.doc_id is None else planted(r.doc_id, words_of(texts[r.doc_id]))
        runs = plain_runs(words)
        assert r.n_runs == len(runs)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
        assert (r.start, r["length"], r.period) == best
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join("%d,%d,%d\n" % x for x in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(plain_collapsed(words, runs).encode()).hexdigest()


def run_query(docs):
    found = repeats.word_runs(repeats.with_planted_repeats(docs), carried=["doc_id"])
    return repeats.run_digests(found).select("row.doc_id", "*").drop("row").collect()


def test_digests_of_planted_texts(rows, texts):
    table = {k: t for k, t in enumerate(texts) if k not in (10, 11)} | {None: "a b", -7: "x y " * 9}
    check_query(run_query(rows("doc_id long, text string, h int, words int", *((k, t, 1, 1) for k, t in table.items()))), table)


def test_repeated_and_no_rows(rows):
    docs = rows("doc_id long, text string", (1, "a " * 9), (1, "a " * 9))
    got = run_query(docs)
    assert len(got) == 2 and got[0] == got[1]
    assert run_query(docs.limit(0)) == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    short = {k: t for k, t in texts.items() if len(words_of(t)) < 3000}
    got = catalog.op13_repeats(spark, folder).collect()
    assert {r.doc_id for r in got} == set(texts)
    check_query([r for r in got if r.doc_id in short], short)
