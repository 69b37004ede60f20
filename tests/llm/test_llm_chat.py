"""Chat examples against a plain rewriting, with hostile texts."""

import hashlib
import random

from creaseline.llm import chat

PIECES = ["<", "|", "\\", "<|", "<\\|", "<|im_end|>", "<|im_start|>", "\n", "\\n", "a", "ü😀", "assistant", ""]


def conversations(rows):
    rng = random.Random(3)
    said = []
    for conv in range(60):
        for turn in range(rng.randint(1, 5)):
            role = rng.choice(["user", "assistant", "system", None, "a\n<|x", "\\n\\"])
            said.append((conv, turn if turn != 2 else None, role, rng.choice([None, "".join(rng.choices(PIECES, k=6))])))
    said += [(None, 0, "assistant", "x"), (5, 0, "assistant", "same"), (5, 0, "assistant", "same")]
    return said, rows("conv_id long, turn long, role string, text string, example int", *((*s, 1) for s in said))


def test_read_back(rows):
    said, table = conversations(rows)
    found = {r.conv_id: r for r in chat.conversation_digests(chat.formatted_examples(table)).collect()}
    groups = {}
    for conv, turn, role, text in said:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    assert set(found) == set(groups)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for conv, turns in groups.items():
        turns.sort(key=lambda t: (t[0], t[1], t[2].encode(), t[3].encode()))
        loss = "".join(t[3] for t in turns if t[2] == "assistant")
        r = found[conv]
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == digest("".join(f"{t[2]}\n{t[3]}\n" for t in turns))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), digest(loss))


def test_examples(rows):
    table = rows(
        "conv_id long, turn long, role string, text string",
        (1, 0, "user", "q"), (1, 1, "assistant", "a1"), (1, 2, "user", "r"), (1, 3, "assistant", "a2"), (1, 4, "user", "end"),
    )
    found = sorted(chat.formatted_examples(table).collect(), key=lambda r: r.example)
    assert [r.text[r.loss_start : r.loss_end] for r in found] == ["a1", "a2", ""]
    assert found[0].text == "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\na1<|im_end|>\n"
    assert found[1].text.startswith(found[0].text) and found[2].text.startswith(found[1].text)


def test_empty(rows):
    table = conversations(rows)[1].limit(0)
    assert chat.conversation_digests(chat.formatted_examples(table)).collect() == []
