import datetime as dt
import hashlib
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from creaseline.functions import keys, metrics, parsing, text
from creaseline.functions import text as text_fn
from creaseline.functions.text import NameRules, name_key, plain_name_key, season_label


def column(df, expression):
    return [r[0] for r in df.select(expression).collect()]


def brute_name(s, rules):
    """What the normaliser must give, one character at a time."""
    if s is None:
        return None
    if rules.remove_diacritics:
        s = "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))
    if rules.lower:
        s = s.lower()
    if rules.strip:
        s = s.strip()
    if rules.remove_trailing_commas:
        end = len(s) - 1 if s.endswith("\n") and s[:-1].endswith(",") else len(s)
        keep = end
        while keep and s[keep - 1] == ",":
            keep -= 1
        s = (s[:keep] + s[end:]).strip()
    if rules.remove_periods:
        s = s.replace(".", "")
    return " ".join(s.split()) if rules.collapse_spaces else s


RULES = [
    NameRules(),
    NameRules(remove_periods=True),
    NameRules(remove_diacritics=False),
    NameRules(lower=False, remove_trailing_commas=False),
    NameRules(strip=False),
    NameRules(strip=False, remove_trailing_commas=False, collapse_spaces=False),
    NameRules(collapse_spaces=False, remove_periods=True),
]


@pytest.mark.parametrize("rules", RULES)
def test_name_key_against_brute_force(rows, rules):
    pick = random.Random(7)
    alphabet = "aB.,, \t\n  \x1cé\u0301ﬁ½\u2028\u00a0\u3000\u1680İΣßÅ한字😀"
    texts = ["".join(pick.choices(alphabet, k=pick.randrange(12))) for _ in range(3000)]
    texts += [None, "", ",", " , ", "A A Barot,", "José", "a,\n", "a , ,", ",,a,,", "A.B. de Villiers"]
    df = rows("n int, s string", *enumerate(texts))
    found = {r.n: r.k for r in df.select("n", name_key(F.col("s"), rules).alias("k")).collect()}
    wrong = [(t, found[n], brute_name(t, rules)) for n, t in enumerate(texts) if found[n] != brute_name(t, rules)]
    assert not wrong, wrong[:5]


def test_blank_class_is_pythons():
    import re

    java = re.sub(r"\\x\{(\w+)\}", lambda m: f"\\U{m.group(1):0>8}", text.BLANK)
    blank = re.compile(java)
    assert all(bool(blank.fullmatch(chr(c))) == chr(c).isspace() for c in range(0x110000))


def test_plain_name_key_keeps_diacritics(rows):
    df = rows("s string", ("  José\t Silva ,, ",), ("JOSÉ,,",), ("\tx",), (None,))
    assert column(df, plain_name_key(F.col("s"))) == ["josé silva ", "josé", " x", None]


def test_season_label(rows):
    assert column(rows("s string", ("2007/08",), ("2010",), (None,)), season_label(F.col("s"))) == ["2007-08", "2010", None]
    assert column(rows("s int", (2010,)), season_label(F.col("s"))) == ["2010"]


def test_match_key(rows):
    df = rows("a string, b string, c string, d string, e string", ("2008", "MI", "CSK", None, "2008-04-18"))
    expected = hashlib.sha1(b"2008|mi|csk||2008-04-18").hexdigest()[:16]
    assert column(df, keys.match_key(*(F.col(c) for c in "abcde"))) == [expected]


def test_ball_key(rows):
    df = rows("m string, i int, o int, b int", ("k", 1, 2, 3), ("k", 1, 20, 11), ("k", 1, 100, 1), ("k", 1, None, 1), ("k", None, None, None))
    found = column(df, keys.ball_key(*(F.col(c) for c in "miob")))
    assert found == ["k-01-02-03", "k-01-20-11", "k-01-100-01", None, None]


def test_base_name_and_team_key(rows):
    df = rows("p string", ("file:/a/b.json",), ("C:\\a\\b.json",), ("b.json",))
    assert column(df, keys.base_name(F.col("p"))) == ["b.json"] * 3
    assert column(df.limit(1), keys.team_key(F.lit("x"))) == ["team_" + hashlib.sha1(b"x").hexdigest()[:12]]


def test_record_hash_of_null_is_that_of_an_empty_object(rows):
    df = rows("a int", (1,), (None,))
    whole = F.when(F.col("a").isNotNull(), F.struct("a"))
    expected = [hashlib.sha1(t).hexdigest()[:16] for t in (b'{"a":1}', b"{}")]
    assert column(df, keys.record_hash(whole)) == expected


def test_enum_value(rows):
    df = rows("s string", (" Bat ",), ("BOWL",), ("runs",), (None,))
    assert column(df, parsing.enum_value(F.col("s"), parsing.TOSS_DECISIONS)) == ["bat", "field", None, None]
    assert column(df, parsing.enum_value(F.col("s"), {})) == ["bat", "bowl", "runs", None]
    df = rows("s string", ("No Result",), ("match tied",), ("tie",))
    assert column(df, parsing.enum_value(F.col("s"), parsing.RESULT_KINDS)) == ["no_result", "tie", "tie"]


def test_first_date(rows):
    df = rows("s string", ("2008-04-18",), ("2008/04/18",), ("18-Apr-2008",), ("April",), ("2008-13-40",), (None,))
    day = dt.date(2008, 4, 18)
    assert column(df, parsing.first_date(F.col("s"))) == [day, day, day, None, None, None]


def test_to_flag(rows):
    df = rows("s string", ("true",), ("0",), ("maybe",), (None,))
    assert column(df, parsing.to_flag(F.col("s"))) == [True, False, None, None]


def test_phase(rows):
    df = rows("o int", (1,), (6,), (7,), (15,), (16,), (21,), (0,), (None,))
    assert column(df, metrics.phase(F.col("o"))) == ["PP", "PP", "MID", "MID", "DEATH", "DEATH", "DEATH", "DEATH"]


def test_rates(rows):
    df = rows("n bigint, d bigint", (7, 2), (7, 0), (7, None), (None, 2))
    assert column(df, metrics.ratio(F.col("n"), F.col("d"))) == [3.5, None, None, None]
    assert column(df, metrics.batting_rate(F.col("n"), F.col("d")))[0] == 350.0
    assert column(df, metrics.economy_rate(F.col("n"), F.col("d")))[0] == 21.0
    assert column(rows("b int", (15,)), metrics.overs(F.col("b"))) == [2.5]


def test_ball_rules(rows):
    df = rows(
        "runs_total int, extra_byes int, extra_legbyes int, extra_wides int, extra_noballs int, "
        "wicket_fell boolean, wicket_kind string",
        (5, 1, 2, 0, 0, True, "Caught"),
        (1, 0, 0, 1, 0, True, "run out"),
        (1, 0, 0, 0, 1, False, None),
        (None, None, None, None, None, True, None),
    )
    assert column(df, metrics.charged_runs()) == [2, 1, 1, None]
    assert column(df, metrics.faced()) == [True, False, True, None]
    assert column(df, metrics.legal()) == [True, False, False, None]
    assert column(df, metrics.credited_wicket()) == [True, False, False, None]
    assert df.agg(metrics.tally(metrics.legal())).first()[0] == 1


def test_marks_are_removed_from_every_character(spark):
    """All code points there are, in runs, against Python's decomposition."""
    import unicodedata

    codes = [chr(c) for c in (*range(1, 0xD800), *range(0xE000, 0x110000))]
    runs = ["".join(codes[k : k + 300]) for k in range(0, len(codes), 300)]
    plain = lambda t: "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))
    df = spark.createDataFrame(list(enumerate(runs)), "n int, s string").repartition(8)
    found = {r.n: r.k for r in df.select("n", text_fn.without_marks(F.col("s")).alias("k")).collect()}
    assert [n for n, run in enumerate(runs) if found[n] != plain(run)] == []


def test_names_are_compared_without_python(rows):
    df = rows("s string", ("é",))
    assert "Python" not in df.select(name_key(F.col("s")))._jdf.queryExecution().executedPlan().toString()
