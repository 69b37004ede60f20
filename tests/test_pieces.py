"""Documents that are read and written in pieces are the same as whole ones."""

import json
import os

import pytest
from pyspark.sql import functions as F

from creaseline.operators import flatten
from creaseline.sources import documents, ingest, pieces, versions

LAYERS = {"matches": flatten.match_rows, "deliveries": flatten.ball_rows}
BALL = {"batter": 'a "q" \\ {x}, [y]', "bowler": "é", "runs": {"batter": 1, "extras": 0, "total": 1}, "wickets": [{"player_out": "a", "fielders": [{"name": "f"}]}]}
INFO = {"season": "2020/21", "venue": "v", "teams": ["x", "y"], "dates": ["2020-01-01"], "more": {"innings": [{"overs": [{"deliveries": [{}]}]}]}}


def over(number, *balls):
    return {"over": number, "deliveries": list(balls)}


def document(*innings):
    return {"info": INFO, "innings": list(innings)}


LONG = document(
    {"team": "x", "overs": [over(0, *(BALL | {"non_striker": str(n)} for n in range(2500))), over(None, BALL), {"over": 3}, over(4), None, over(5, None, BALL)]},
    None,
    {"overs": [{"deliveries": [BALL, BALL], "over": 7}, over(8, {})], "team": "y"},
    {"team": "none"},
)
READABLE = {
    "long": json.dumps(LONG, indent=2),
    "long in one line": json.dumps(LONG, ensure_ascii=False),
    "long and backwards": json.dumps({"innings": LONG["innings"], "info": INFO}, indent=1) + "\n",
    "no innings": json.dumps({"info": INFO}),
    "empty innings": json.dumps(document()),
    "innings twice": '{"innings": [{"team": "lost", "overs": [{"deliveries": [{"batter": "no"}]}]}], "info": {"venue": "w"}, "innings": [{"team": "x", "overs": [{"deliveries": [{"batter": "yes"}]}]}]}',
    "something after it": json.dumps(document({"team": "x", "overs": [over(0, BALL)]})) + ' , {"innings": [{"overs": [{"deliveries": [{"runs": 1}, ]}]}]}',
    "hidden key": '{"info": {"venue": "a, \\"innings\\" : [{"}, "inn\\u0069ngs" : [{"team": "z", "overs": [{"deliveries": [{"batter": "b"}]}]}]}',
    "apostrophe": json.dumps(document({"team": "x's {", "overs": [over(0, *[{"batter": "O'Brien"}] * 3)]})),
    "single quotes": "{'info': {'venue': 'a \"b {'}, 'innings': [{\"team\": 'x', 'overs': [{'deliveries': [{'batter': 'it'}, {}]}]}]}",
    "some single quotes": '{"innings": [{"team": "x", "overs": [{"deliveries": [{"batter": "it"}, {"bowler": \'"}\'}]}]}]}',
    "much between": '{"info": {"venue": "w"}, "innings" ' + " " * 5000 + ': [{"team": "x", "overs": [{"deliveries": [{"batter": "b"}]}]}]}',
}
UNREADABLE = {
    "cut": READABLE["long"][:-2] + "\n",
    "cut in a ball": READABLE["long"][:5000],
    "cut at a bracket": READABLE["long"][: READABLE["long"].index("{", 5000) + 1],
    "ends in a bracket": "{",
    "brackets": "{}{".replace("}", "") * 3,
    "trailing comma": '{"innings": [{"overs": [{"deliveries": [{}, ]}]}]}',
    "only a comma": '{"innings": [{"overs": [{"deliveries": [,]}]}]}',
    "first comma": '{"innings": [{"overs": [{"deliveries": [ , {}]}]}]}',
    "wrong bracket": '{"innings": [{"overs": [{"deliveries": [{}}}]}]}',
    "wrong type": json.dumps(document({"team": "x", "overs": [over(0, BALL, {"runs": {"total": "many"}})]})),
    "line end in a text": '{"info": {"venue": "a\r\nb"}}\r\n',
    "in a list": json.dumps([document({"team": "x", "overs": [over(0, BALL)]})]),
    "blank": " \r\n\n",
}


def scanned(text, size):
    scanner, cuts = pieces.Scanner(), []
    for at in range(0, len(text), size):
        cuts += scanner.feed(text[at : at + size])
    return cuts, scanner.end()


@pytest.mark.parametrize("size", [1, 7, 1000, 1 << 20])
def test_cuts_and_frame_make_the_document(monkeypatch, size):
    monkeypatch.setattr(pieces, "CUT_BALLS", 3)
    balls = [BALL | {"non_striker": str(n)} for n in range(10)]
    whole = document({"team": "x", "overs": [over(0, *balls), over(1)]}, {"overs": [{"deliveries": [{}], "over": 2}], "team": "y"})
    for text in (json.dumps(whole, indent=1), json.dumps(whole)):
        cuts, frame = scanned(text.encode(), size)
        found = json.loads(frame)
        assert found["info"] == INFO and found["innings"][0]["overs"][1] == over(1)
        assert [six["deliveries"][0]["batter"] for six in (found["innings"][0]["overs"][0], found["innings"][1]["overs"][0])] == ["1", "3"]
        assert [(cut, at) for cut, at, _ in cuts] == [(1, 0), (1, 3), (1, 6), (1, 9), (3, 0)]
        assert [b for cut, _, body in cuts for b in json.loads(b"[" + body + b"]") if cut == 1] == balls
        assert len(frame) < len(text) / 2


def rows(spark, store, part):
    return sorted(map(str, versions.read_part(spark, store, part).drop("src_ingest_ts").collect()))


def test_documents_in_pieces_give_the_rows_of_whole_ones(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name, text in (READABLE | UNREADABLE).items():
        (folder / f"{name}.json").write_bytes(text.encode())
    for store, above in (("whole", None), ("pieces", 0), ("both", 2000)):
        done = ingest.ingest(spark, str(folder), f"{tmp_path}/{store}", LAYERS, limit_percent=100, parts_above=above)
        assert (done.good, done.bad) == (len(READABLE), len(UNREADABLE)), store
        held = {r.src_file_name: r.record for r in ingest.quarantined(spark, f"{tmp_path}/{store}").collect()}
        assert held == {f"{name}.json": text for name, text in UNREADABLE.items()}
    for part in LAYERS:
        whole = rows(spark, f"{tmp_path}/whole", part)
        assert len(whole) > len(READABLE) - 1 and whole == rows(spark, f"{tmp_path}/pieces", part) == rows(spark, f"{tmp_path}/both", part)


def test_a_changed_document_in_pieces_replaces_its_rows(spark, tmp_path):
    folder, store = tmp_path / "in", f"{tmp_path}/store"
    folder.mkdir()
    run = lambda: ingest.ingest(spark, str(folder), store, LAYERS, limit_percent=60, parts_above=0)
    for name, text in (("a", READABLE["long"]), ("b", READABLE["no innings"]), ("c", UNREADABLE["cut"])):
        (folder / f"{name}.json").write_text(text)
        os.utime(folder / f"{name}.json", (1000, 1000))
    assert (run().bad, versions.read_part(spark, store, "deliveries").where("src_file_name = 'a.json'").count()) == (1, 2511)
    for name, text in (("a", UNREADABLE["cut"]), ("c", READABLE["empty innings"])):
        (folder / f"{name}.json").write_text(text)
    assert run().replaced == 2
    assert sorted(r.src_file_name for r in versions.read_part(spark, store, "deliveries").collect()) == ["b.json", "c.json"]
    assert [r.src_file_name for r in ingest.quarantined(spark, store).collect()] == ["a.json"]


def test_texts_are_cut_anew_whatever_rows_they_come_in(spark):
    text = "0123456789é" * 5
    for width in (1, 4, 9, 100):
        cuts = [("k", n, text[n * width : (n + 1) * width]) for n in range(-(-len(text) // width))] + [("k", 1000, ""), ("other", 0, "ab"), (None, 0, "xyz")]
        found = pieces.text_pieces(spark.createDataFrame(cuts, "k string, n int, t string").repartition(3), "k", ["n"], "t", 8).collect()
        assert sorted(((r.k or "", r.piece, r.text) for r in found)) == [
            ("", 0, "xyz"), *(("k", n, text[n * 8 : n * 8 + 8]) for n in range(7)), ("other", 0, "ab"),
        ]


def test_a_file_read_in_stretches_is_refused(spark, tmp_path):
    (tmp_path / "a.json").write_text(READABLE["long"])
    with pytest.raises(Exception, match="stretches"):
        pieces.staged_pieces(spark, [f"{tmp_path}/a.json"], 1000)
    assert pieces.staged_pieces(spark, [f"{tmp_path}/a.json"], 1 << 30).where("ball_at = 2499").count() == 1


def test_no_row_of_a_large_document_is_large(spark, tmp_path):
    (tmp_path / "a.json").write_text(READABLE["long"])
    staged = pieces.staged_pieces(spark, [f"{tmp_path}/a.json"], 1 << 30)
    most = staged.select(F.length(F.to_json(F.struct("*"))).alias("n")).agg(F.max("n")).first()[0]
    assert most < 3000 < len(READABLE["long"]) / 100
    parts = pieces.document_parts(pieces.framed_documents(staged), staged)
    assert parts.agg(F.max(F.size("innings"))).first()[0] == 1
    assert documents.CORRUPT not in parts.columns
