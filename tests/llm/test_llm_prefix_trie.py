"""The trie against one built turn by turn in Python; the query also against SQL in test_llm_catalog."""

import hashlib
import zlib

import numpy as np
import pytest

from creaseline.llm import prefix_trie


def plain_trie(conversations):
    """conversations: id -> list of (role, text)."""
    root = {"members": [], "ends": [], "next": {}, "words": 0}
    for c, turns in conversations.items():
        node = root
        node["members"].append(c)
        for role, text in turns:
            node = node["next"].setdefault((role, text), {"members": [], "ends": [], "next": {}, "words": len(text.split())})
            node["members"].append(c)
        node["ends"].append(c)
    out = []

    def visit(node, depth, parent):
        saved, leaves = (len(node["members"]) - 1) * node["words"], 0 if node["next"] else 1
        least = min(node["members"])
        for child in node["next"].values():
            s, n = visit(child, depth + 1, least)
            saved, leaves = saved + s, leaves + n
        ends = hashlib.sha256(",".join(map(str, sorted(node["ends"]))).encode()).hexdigest()
        out.append((least, depth, parent, len(node["members"]), len(node["next"]), leaves, saved, ends))
        return saved, leaves

    if conversations:
        visit(root, 0, None)
    return sorted(out, key=str)


def plain_shared(table):
    """The rebuilt conversations of rows (conv_id, turn, role, text)."""
    own = {}
    for c, turn, role, text in sorted(table, key=lambda r: (r[1] is not None, r[1] or 0)):
        own.setdefault(c, []).append((role or "", text or ""))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def nodes(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in prefix_trie.trie_table(df).select(names).collect()), key=str)


SCHEMA = "conv_id long, turn long, role string, text string, key string, depth int"


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(4)
    made = []
    for c in range(150):
        if c % 20 or c % 40:
            for t in range(rng.integers(1, 7)):
                made.append((c, t if t else None, ["user", "assistant", None][t % 3], ["a b", "c", "", None, "d  e\tf"][rng.integers(0, 5)]))
    made += [(1000 + k, t, "user", f"long {t}") for k in range(3) for t in range(12 - k)]
    return made


def test_peeling_without_shared_heads(rows, table):
    df = prefix_trie.conversation_turns(rows(SCHEMA, *((*r, "k", 1) for r in table)))
    own = {}
    for c, turn, role, text in sorted(table, key=lambda r: (r[1] is not None, r[1] or 0)):
        own.setdefault(c, []).append((role or "", text or ""))
    assert nodes(df) == plain_trie(own)


def test_long_conversations_that_part_late(rows):
    own = {c: [("user", f"x {t}") for t in range(90)] + [("user", f"own {c // 2} {t}") for t in range(c)] for c in range(6)}
    own |= {10: own[0][:40], 11: own[0][:40] + [("user", "late")], 12: [("user", "alone")] * 200}
    said = [(c, k, *turn, "", 0) for c, turns in own.items() for k, turn in enumerate(turns)]
    assert nodes(prefix_trie.conversation_turns(rows(SCHEMA, *said))) == plain_trie(own)


def test_shared_heads(rows, table):
    df = prefix_trie.conversation_turns(rows(SCHEMA, *((*r, "k", 1) for r in table)))
    assert nodes(prefix_trie.with_shared_heads(df)) == plain_trie(plain_shared(table))


def test_role_and_text_are_kept_apart(rows):
    df = prefix_trie.conversation_turns(rows(SCHEMA, (1, 0, "us", "erx", "", 0), (2, 0, "user", "x", "", 0)))
    assert len(nodes(df)) == 3


def test_null_id_repeats_and_ties(rows):
    said = [(None, 0, "user", "a", "", 0), (5, 0, "user", "a", "", 0), (5, 0, "user", "a", "", 0), (6, 0, "b", "y", "", 0), (6, 0, "a", "z", "", 0)]
    found = nodes(prefix_trie.with_shared_heads(prefix_trie.conversation_turns(rows(SCHEMA, *said))))
    assert found == nodes(prefix_trie.with_shared_heads(prefix_trie.conversation_turns(rows(SCHEMA, *said[::-1]))))
    root = next(n for n in found if n[1] == 0)
    assert root[3] == 3


def test_many_equal_conversations(rows, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS_PER_RANGE", 7)
    said = [(c, t, "user", f"same {t}", "", 0) for c in range(-40, 60) for t in range(2)]
    own = {c: [("user", "same 0"), ("user", "same 1")] for c in range(-40, 60)}
    assert nodes(prefix_trie.conversation_turns(rows(SCHEMA, *said))) == plain_trie(own)


def test_conversation_without_turns_and_none(rows):
    df = prefix_trie.conversation_turns(rows(SCHEMA, (3, 0, "user", "x", "", 0)))
    cut = df.selectExpr("conv_id", "slice(turns, 1, 0) AS turns")
    assert nodes(cut) == plain_trie({3: []})
    assert nodes(df.limit(0)) == []
