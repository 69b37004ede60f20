"""Base spans against the contract's expressions; bootstrapped spans on a planted context."""

import random
import re

from creaseline.llm import private_data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    def luhn(d):
        total = 0
        for k, c in enumerate(reversed(d)):
            n = int(c) * (1 + k % 2)
            total += n - 9 if n > 9 else n
        return total % 10 == 0

    digits = lambda m: re.sub(r"\D", "", m[0])
    spans = [("email", *m.span()) for m in EMAIL.finditer(text)]
    spans += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    spans += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    spans += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return spans


def test_base_spans_are_those_of_the_expressions():
    rng = random.Random(5)
    pieces = ["a", "@", ".", "-", "_", "1", "25", "255", "256", "0", " ", "  ", "+", "(", ")", "ü", "😀", "4111111111111111", "x@y.z", "\n", "%"]
    for _ in range(4000):
        text = "".join(rng.choices(pieces, k=rng.randint(0, 14)))
        assert private_data.base_spans(text) == plain_spans(text), repr(text)


def test_long_runs_take_no_quadratic_time():
    for piece in ("a", "1", "1.", "@", "+1", "a@", "1-", "9 "):
        private_data.mentions(piece * 200_000, private_data.base_spans(piece * 200_000))


def planted(rows):
    texts = [(k, f"word{k % 7}x please dial +1 (21{k % 10}) 555-{1000 + 37 * k} now and mail a{k}@b.org or not", k) for k in range(40)]
    texts += [(100, "then please dial +1 (21 555-77777777777777 now", 0), (101, None, 0), (102, "", 0), (103, "plain text", 0)]
    texts += [(104, "he said mail x(at)b9 or not", 0), (105, "ü mail joe90%b.org or not 5x5x5x5", 0), (None, "card 4111111111111111", 0)]
    return rows("doc_id long, text string, spans int", *texts)


def test_spans(rows):
    found = {r.doc_id: r for r in private_data.private_spans(planted(rows)).collect()}
    assert len(found) == 47
    for r in planted(rows).collect():
        base = plain_spans(r.text or "")
        got = found[r.doc_id]
        wanted = [f"{k}:{a}:{b}" for k, a, b in base]
        assert set(wanted) <= set(got.spans.split(",")) | {""}
        assert len([s for s in got.spans.split(",") if s]) == len(base) + got.added
        assert got.n_email == sum(k == "email" for k, _, _ in base) and got.n_card == sum(k == "card" for k, _, _ in base)
    assert found[103].spans == "" == found[101].spans and found[103].added == 0


def test_a_learnt_context_adds_spans(rows):
    """Phone numbers after the same word, with the form that most of them have."""
    texts = [(k, f"x{k} fax 7{k:02d}.555.{100 + k} is") for k in range(30)]
    mentioned = [{"row": k, "kind": "phone" if k < 25 else None, "value": t[6:], "form": "9.9.9", "left": "fax", "right": "is"} for k, t in texts]
    table = rows(
        "row long, kind string, value string, form string, left string, right string",
        *((m["row"], m["kind"], m["value"], m["form"], m["left"], m["right"]) for m in mentioned),
        *((200 + k, "none", f"v{k}", "9.9.9", "the", "is") for k in range(30)),
    )
    patterns = private_data.confident_patterns(private_data.pattern_edges(table)).collect()
    assert {(r.pattern.split("\u0001")[0], r.new_kind) for r in patterns} == {("b", "phone"), ("ba", "phone")}


def test_empty(rows):
    assert private_data.private_spans(planted(rows).limit(0)).collect() == []


def test_kinds_that_a_text_can_be_of():
    wanted = {
        "555-123-4567": ["phone"], "712.555.101": ["phone"], "712 555 1010": ["phone"], "4111.1111.1111.1111": ["card"],
        "4111 1111  1111 1111": [], "4111111111111112": [], "300.1.1.1": [], "192.168.300.12": [], "10.0.0[.]1": ["ip"], "10-20-30-40": ["ip", "phone"],
        "fe80::1:2": ["ip"], "joé@b.org": ["email"], "joe[at]b.org": ["email"], "@handle": [], "a@b@c": [], "04dbebab91ab": [], "2024": [],
    }
    assert {value: private_data.possible_kinds(value) for value in wanted} == wanted


def test_candidates_span_blanks_and_leave_seeds_alone():
    def found(text):
        seen = private_data.mentions(text, private_data.base_spans(text))
        return {(text[m["start"] : m["end"]], m["kind"] or m["kinds"]) for m in seen}

    assert found("call 712 555 1010, or 2024") == {("712 555 1010", "phone")}
    assert found("+1 (826) 555-4081 190.137.223.204 du") == {("190.137.223.204", "ip"), ("+1 (826) 555-4081", "phone")}
    assert found("tel:555-123-4567. (joé@b.org) mailto:zoé@b.org") == {("555-123-4567", "phone"), ("joé@b.org", "email"), ("zoé@b.org", "email")}
    assert found("x 4111111111111112 7536784127813050 y") == {("4111111111111112", "none"), ("7536784127813050", "card")}


def test_contexts_add_spans_of_every_kind(rows):
    """Seeds after one word teach it; what the expressions miss after it is found, what fails a check is not."""
    cards = ["4111111111111111", "5500005555555559", "4012888888881881", "4222222222222", "378282246310005", "30569309025904"]
    cards += ["5105105105105100", "6011111111111117", "6011000990139424", "3530111333300000", "3566002020360505", "371449635398431"]
    seeds = [f"x mail ann{k}@b{k}.org or" for k in range(12)] + [f"x from 10.1.2.{k} at" for k in range(12)]
    seeds += [f"x charge {c} for" for c in cards] + [f"x dial +1 (212) 555-10{k:02d} now" for k in range(12)]
    missed = {
        "x mail joé@b.org or": "email:7:16", "x mail joe[at]b.org or": "email:7:19", "x from 10.1.2[.]77 at": "ip:7:18", "x from fe80::17 at": "ip:7:15",
        "x charge 4111.1111.1111.1111 for": "card:9:28", "x charge 4111  1111 1111 1111 for": None, "x charge 4111111111111112 for": None,
        "x dial 712.555.101 now": "phone:7:18", "x dial 555-123-4567 now": "phone:7:19", "x dial 712 555 1010 now": "phone:7:19",
        "x from 300.1.1.1 at": None, "x dial 04dbebab91ab85 now": None, "y other 555-123-9999 words": None,
    }
    table = rows("doc_id long, text string", *enumerate([*seeds, *missed]))
    found = {r.doc_id: r for r in private_data.private_spans(table).collect()}
    assert {text: found[k].spans or None for k, text in enumerate(missed, len(seeds))} == missed
    assert [found[k].added for k in range(len(seeds))] == [0] * len(seeds)
    assert all(found[k].added == (span is not None) for k, span in enumerate(missed.values(), len(seeds)))


def test_long_chunks_and_many_pieces_are_candidates():
    def found(text):
        seen = private_data.mentions(text, private_data.base_spans(text))
        return {(text[m["start"] : m["end"]], m["kind"] or m["kinds"]) for m in seen}

    long = "josé." * 30 + "[at]example.org"
    assert found(f"mail {long} or") == {(long, "email")}
    nine = "4 00 00 00 00.00 00 00 00 06"
    assert found(f"charge {nine} for") == {(nine, "card")}
    assert found("x " + "1" * 300 + " y") == set()
