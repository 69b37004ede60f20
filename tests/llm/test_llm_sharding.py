"""Jump hashing against its definition; laws of shards and slots."""

import numpy as np

from creaseline.llm import sharding


def plain_jump(key: int, shards: int) -> int:
    at, nxt = -1, 0
    while nxt < shards:
        at = nxt
        key = (key * 2862933555777941757 + 1) % 2**64
        nxt = int((at + 1) * (2**31 / ((key >> 33) + 1)))
    return at


def test_jump_is_the_published_function():
    keys = np.random.default_rng(1).integers(0, 2**63, 500).astype(np.uint64)
    for shards in (1, 2, 16, 17, 1000):
        assert sharding.jump(keys, shards).tolist() == [plain_jump(int(k), shards) for k in keys]


def documents(rows):
    texts = [(k, f"text {k % 7}" if k % 5 else None, k % 3) for k in range(300)]
    return rows("doc_id long, text string, slot int", *texts, (7, "x", 0), (7, "x", 0), (None, "ü", 1), (None, "", 1))


def test_growth_gapless_slots_and_repeats(rows):
    found = sharding.shard_documents(documents(rows), 16, ["doc_id", "text"]).collect()
    assert len(found) == 304
    assert all(r.grown_shard in (r.shard, 16) for r in found)
    assert 0 < sum(r.grown_shard == 16 for r in found) < 60
    by_shard = {}
    for r in found:
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert len({r.shard for r in found if r.doc_id == 7}) == 1
    assert {r.size for r in found if r.text is None} == {1}
    assert {r["size"] for r in found if r.text == "ü"} == {3}


def test_slots_do_not_depend_on_partitions(rows):
    docs = documents(rows)
    once = sharding.shard_documents(docs, 4, ["doc_id", "text"])
    again = sharding.shard_documents(docs.repartition(5), 4, ["doc_id", "text"])
    assert sorted(map(str, once.collect())) == sorted(map(str, again.collect()))


def test_many_buckets(rows):
    found = sharding.with_slots(documents(rows).selectExpr("doc_id", "0 AS shard"), "shard", ["doc_id"], 10).collect()
    assert sorted(r.slot for r in found) == list(range(304))


def test_a_third_of_all_rows_is_equal(rows):
    """They spread over the buckets; columns with names of our own are kept."""
    data = [(5, "same", k, -k) for k in range(300)] + [(None, None, k, k) for k in range(300)] + [(k, f"t{k}", k, k) for k in range(300)]
    docs = rows("doc_id long, text string, _bucket int, _key0 int", *data)
    table = sharding.with_shards(sharding.measured(docs), "doc_id", 2)
    found = sharding.with_slots(table, "shard", ["doc_id", "size", "text_crc32"], 20).collect()
    assert sorted((r._bucket, r._key0) for r in found) == sorted(d[2:] for d in data)
    for shard in (0, 1):
        slots = sorted(r.slot for r in found if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert max(np.diff(sorted(r.slot for r in found if r.doc_id == 5))) > 1


def test_empty(rows):
    assert sharding.shard_documents(documents(rows).limit(0), 4).collect() == []
