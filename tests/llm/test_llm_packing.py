"""Pieces against whole texts under the tokenizer; laws of packing."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from creaseline.llm import catalog, packing

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(VOCABULARY)
TEXTS = [
    "", None, " \t\n", "a", "The QUICK brown fox, it's over!!", "don't 'tis 'S o'clock,'s word's,then", "é́ é. ÉÈ,ß ΣΑΣ ΣΑΣ. İstanbul",
    "<|endoftext|> and <|ENDOFTEXT|>, <|startoftext|>x", "x y z\x1cq\x85r", "3.14 1,000 $5&6 a_b-c d--e ...f !!g", "日本語。テキスト, 한국어!",
    "a​b́.c", "word " * 300, "!?" * 40, "ﬁ ½ ²x", "e.́ a,̈b",
]


def plain_pieces(text, limit):
    ids = [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1]
    return [(k, a, ids[a : a + limit]) for k, a in enumerate(range(0, len(ids), limit))]


def check_laws(rows, limit):
    by = {}
    for r in rows:
        assert 1 <= r["length"] <= limit
        by.setdefault(r.sequence_id, []).append((r.offset, r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= limit
    return len(by)


@pytest.fixture(scope="module")
def found(rows):
    docs = rows("doc_id long, text string, row string, piece int, ids string", *((k, t, "r", 1, "i") for k, t in enumerate(TEXTS)), (None, "x y", "r", 2, "i"), (3, "a", "r", 1, "i"))
    return packing.token_pieces(docs, VOCABULARY, limit=64).cache()


def test_pieces_are_those_of_whole_texts(found):
    for k, text in enumerate(TEXTS):
        got = [(r.piece, r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in found.where(f"row.doc_id = {k}").orderBy("piece").collect()]
        if k == 3:
            got = got[:1]  # a repeated row
        assert got == plain_pieces(text, 64), text
    assert found.where("row.doc_id IS NULL AND row.piece = 2").count() == 1


def test_random_texts(rows):
    rng = np.random.default_rng(3)
    letters = list("aAbzÉéßñ'’.,!?-_<>|$%09 ½ΣσİñБ日́​\n\t\r\x0b\x1c\xa0\"()[]{}/\\#")
    texts = ["".join(rng.choice(letters, rng.integers(0, 60))) for _ in range(3000)]
    docs = rows("doc_id long, text string", *enumerate(texts))
    got = packing.token_pieces(docs, VOCABULARY, limit=10_000).collect()
    assert all(np.frombuffer(r.ids, "<u4").tolist() == [*TOKENIZER.encode(texts[r.row.doc_id], add_special_tokens=False).ids, 1] for r in got)
    assert len(got) == len(texts)


def test_sequences_hold_the_pieces(found):
    placed = packing.packed(found.select("row.doc_id", "piece", "start", "length", "ids"), 64, 7).cache()
    assert placed.count() == found.count()
    check_laws(placed.collect(), 64)
    whole = {r.sequence_id: r for r in packing.sequences(placed).collect()}
    for r in placed.collect():
        at = whole[r.sequence_id].ids[4 * r.offset : 4 * (r.offset + r["length"])]
        assert at == r.ids


def plain_sum_of_squares(lengths, limit):
    """Every open gap and a new sequence tried in turn, the sum written out."""
    gaps, used = [], []
    for size in lengths:
        def total(k):
            after = [*gaps, limit] if k == len(gaps) else list(gaps)
            after[k] -= size
            open_gaps = [g for g in after if 0 < g < limit]
            return sum(open_gaps.count(g) ** 2 for g in set(open_gaps))

        fitting = [k for k, g in enumerate(gaps) if g >= size]
        best = min([*((total(k), gaps[k], k) for k in fitting), (total(len(gaps)), limit, len(gaps))])
        if best[2] == len(gaps):
            gaps.append(limit)
        used.append(best[0])
        gaps[best[2]] -= size
    return used, gaps


def test_rule_against_the_sum_written_out():
    rng = np.random.default_rng(5)
    for limit in (1, 2, 10, 30):
        lengths = rng.integers(1, limit + 1, 120)
        sequence, offset = packing.sum_of_squares(lengths, limit)
        used, gaps = plain_sum_of_squares(lengths.tolist(), limit)
        fill = np.zeros(sequence.max() + 1, np.int64)
        for size, s, o, least in zip(lengths, sequence, offset, used):
            assert fill[s] == o
            fill[s] += size
            counts = np.bincount(limit - fill[(fill > 0) & (fill < limit)], minlength=1)
            assert (counts**2).sum() == least
        assert sorted(limit - fill) == sorted(gaps)


def test_few_sequences_whatever_the_lengths(rows):
    rng = np.random.default_rng(6)
    lengths = np.concatenate([np.full(3000, 700), np.clip(rng.lognormal(6, 1, 5000), 1, 4096), np.full(50, 4096)]).astype(int).tolist()
    pieces = rows("doc_id long, length int, number long, sequence_id int", *((None, x, 0, 0) for x in lengths)).select("doc_id", "length")
    n = check_laws(packing.packed(pieces).collect(), 4096)
    assert n <= 1.01 * -(-sum(lengths) // 4096) + 1


def test_hot_equal_rows_spread(rows):
    pieces = rows("doc_id long, length int", *((None, 1) for _ in range(5000)), *((k, 900) for k in range(1000)))
    placed = packing.packed(pieces, 4096, 500).collect()
    assert len(placed) == 6000
    assert len({r.sequence_id >> 32 for r in placed}) >= 12
    check_laws(placed, 4096)


def test_empty(rows):
    docs = rows("doc_id long, text string").limit(0)
    pieces = packing.token_pieces(docs, VOCABULARY, carried=["doc_id"])
    assert packing.packed(pieces.select("row.doc_id", "length", "ids")).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = catalog.op11_packing(spark, folder).collect()
    expected = {}
    for k, text in texts.items():
        for piece, start, ids in plain_pieces(text, 4096):
            expected[k, piece] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r["length"], r.ids_crc32) for r in got} == expected
    assert len(got) == len(expected)
    tokens = sum(r["length"] for r in got)
    assert check_laws(got, 4096) <= 1.01 * -(-tokens // 4096) + 1
