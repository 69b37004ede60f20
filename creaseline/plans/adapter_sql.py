"""The view of ``plans.adapter`` in SQL, as common table expressions."""

from __future__ import annotations

LINE_BALLS = """
line_balls AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CAST(l_orderkey AS VARCHAR) AS match_id,
    CAST(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS INTEGER) AS inning_no,
    CAST(1 + (CAST(l_quantity AS INTEGER) - 1) % 20 AS INTEGER) AS over_no,
    l_linenumber AS ball_in_over,
    'P' || (l_partkey % 200) AS striker,
    'P' || ((l_partkey + 1) % 200) AS non_striker,
    CASE l_linenumber % 5
      WHEN 0 THEN 'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0')
      WHEN 1 THEN 'SUPPLIER#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') || ','
      WHEN 2 THEN '  Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') || ' '
      WHEN 3 THEN 'The  Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0')
      ELSE 'Sùpplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') END AS bowler,
    CAST(l_partkey % 200 AS VARCHAR) AS striker_id,
    CAST((l_partkey + 1) % 200 AS VARCHAR) AS non_striker_id,
    CAST(l_suppkey AS VARCHAR) AS bowler_id,
    CAST(round(l_discount * 100) AS INTEGER) % 7 AS runs_batter,
    CAST(CAST(round(l_tax * 100) AS INTEGER) >= 5 AS INTEGER) AS runs_extras,
    CAST(CAST(round(l_tax * 100) AS INTEGER) = 5 AS INTEGER) AS extra_legbyes,
    CAST(CAST(round(l_tax * 100) AS INTEGER) = 6 AS INTEGER) AS extra_byes,
    CAST(CAST(round(l_tax * 100) AS INTEGER) = 7 AS INTEGER) AS extra_noballs,
    CAST(CAST(round(l_tax * 100) AS INTEGER) = 8 AS INTEGER) AS extra_wides,
    l_returnflag = 'R' AS wicket_fell,
    CASE WHEN l_returnflag = 'R' THEN CASE l_linenumber % 4
      WHEN 0 THEN 'bowled' WHEN 1 THEN 'caught' WHEN 2 THEN 'run out' ELSE 'lbw' END END AS wicket_kind,
    CASE WHEN l_returnflag = 'R' THEN CASE WHEN l_linenumber % 2 = 0 THEN 'P' || (l_partkey % 200)
      ELSE 'P' || ((l_partkey + 1) % 200) END END AS wicket_player_out,
    CAST(round(l_discount * 100) AS INTEGER) % 7
      + CAST(CAST(round(l_tax * 100) AS INTEGER) >= 5 AS INTEGER) AS runs_total,
    printf('%d-%02d-%02d-%02d', l_orderkey, CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END,
      1 + (CAST(l_quantity AS INTEGER) - 1) % 20, l_linenumber) AS delivery_id
  FROM lineitem)"""

MATCH_SIDES = """
match_sides AS (
  SELECT o_orderkey, o_orderstatus, o_orderdate, CAST(year(o_orderdate) AS VARCHAR) AS season,
    'NATION_' || c_nationkey AS team1,
    'NATION_' || ((c_nationkey + 1 + o_orderkey % 24) % 25) AS team2,
    o_orderpriority AS venue, c_mktsegment AS city
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

BALLS = f"""{LINE_BALLS},{MATCH_SIDES},
balls AS (
  SELECT b.* EXCLUDE (l_orderkey, l_linenumber, l_partkey, l_suppkey), season,
    CASE WHEN inning_no = 1 THEN team1 ELSE team2 END AS batting_team,
    CASE WHEN inning_no = 1 THEN team2 ELSE team1 END AS bowling_team,
    CASE WHEN inning_no = 1 THEN team1 ELSE team2 END AS batting_team_id,
    CASE WHEN inning_no = 1 THEN team2 ELSE team1 END AS bowling_team_id
  FROM line_balls b JOIN match_sides ON l_orderkey = o_orderkey)"""


def noisy(team: str, number: str) -> str:
    return (
        f"CASE {number} % 3 WHEN 0 THEN {team} WHEN 1 THEN ' ' || lower({team}) || ',' "
        f"ELSE upper({team}) || '  ' END"
    )


MATCHES = f"""
matches AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS match_id, season, 'T20' AS match_type,
    CASE o_orderkey % 2 WHEN 0 THEN 'male' ELSE 'female' END AS gender, venue, city,
    CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
      WHEN 1 THEN strftime(o_orderdate, '%Y/%m/%d') ELSE strftime(o_orderdate, '%d-%b-%Y') END AS match_start_date,
    CASE WHEN o_orderkey % 5 = 0 THEN 'not a date' END AS match_end_date,
    team1, team2,
    {noisy("CASE o_orderkey % 2 WHEN 0 THEN team1 ELSE team2 END", "o_orderkey")} AS toss_winner,
    CASE o_orderkey % 4 WHEN 0 THEN ' Bat ' WHEN 1 THEN 'bowl' WHEN 2 THEN 'FIELD' ELSE 'unknown' END AS toss_decision,
    CASE o_orderstatus WHEN 'F' THEN team1 WHEN 'O' THEN team2 END AS winner,
    CASE o_orderstatus WHEN 'F' THEN 'runs' WHEN 'O' THEN 'wickets' END AS result,
    CAST(CASE WHEN o_orderstatus <> 'P' THEN 1 + o_orderkey % 90 END AS INTEGER) AS result_margin,
    'P' || (o_orderkey % 200) AS player_of_match
  FROM match_sides)"""

BATTING_ORDER = """
batting_order AS (
  SELECT match_id, min(batting_team) FILTER (inning_no = 1) AS first_batting_team,
    min(batting_team) FILTER (inning_no = 2) AS second_batting_team
  FROM balls GROUP BY match_id)"""

SILVER_MATCHES = f"""{MATCHES},{BATTING_ORDER},
silver AS (
  SELECT m.*, CASE lower(trim(toss_decision)) WHEN 'bat' THEN 'bat' WHEN 'field' THEN 'field' WHEN 'bowl' THEN 'field' END
      AS toss_decision_std, result AS result_std,
    CAST(coalesce(try_strptime(match_start_date, '%Y-%m-%d'), try_strptime(match_start_date, '%Y/%m/%d'),
      try_strptime(match_start_date, '%d-%b-%Y')) AS DATE) AS match_start_dt,
    CAST(coalesce(try_strptime(match_end_date, '%Y-%m-%d'), try_strptime(match_end_date, '%Y/%m/%d'),
      try_strptime(match_end_date, '%d-%b-%Y')) AS DATE) AS match_end_dt,
    first_batting_team, second_batting_team
  FROM matches m LEFT JOIN batting_order USING (match_id))"""

FLAWED_BALLS = """
flawed AS (
  SELECT * REPLACE (
    CASE WHEN ball_in_over = 7 THEN NULL WHEN over_no = 20 THEN 11 ELSE runs_total END AS runs_total,
    CASE ball_in_over % 4 WHEN 2 THEN batting_team WHEN 3 THEN 'Guests' ELSE bowling_team END AS bowling_team,
    CASE WHEN over_no <> 3 THEN wicket_kind END AS wicket_kind,
    CASE WHEN over_no <> 19 THEN delivery_id END AS delivery_id)
  FROM balls)"""

NOISY_BALLS = f"""
noisy_balls AS (
  SELECT * REPLACE ({noisy("batting_team", "ball_in_over")} AS batting_team,
    {noisy("bowling_team", "ball_in_over")} AS bowling_team)
  FROM balls)"""

REGISTER = """
people AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS identifier, s_name AS name, s_name || ' (' || s_nationkey || ')' AS unique_name,
    CAST(s_suppkey + 1000 AS VARCHAR) AS key_cricinfo,
    CASE WHEN s_suppkey % 3 = 0 THEN CAST(s_suppkey + 5000 AS VARCHAR) END AS key_cricbuzz
  FROM supplier),
aliases AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS identifier, unnest([
    'P' || s_suppkey,
    '  ' || upper(s_name) || ',,',
    CASE WHEN s_suppkey % 2 = 0 THEN 'The ' || chr(9) || s_name END,
    CASE WHEN s_suppkey % 10 = 0 THEN 'Süpplier#' || lpad(CAST(s_suppkey + 1 AS VARCHAR), 9, '0') END,
    CASE WHEN s_suppkey % 7 = 0 THEN 'Guest' END]) AS name
  FROM supplier)"""


def name_key(text: str) -> str:
    """Diacritics off, lower case, blanks and trailing commas off, blanks collapsed."""
    return (
        f"trim(regexp_replace(regexp_replace(regexp_replace(lower(strip_accents({text})), "
        r"'^\s+|\s+$', '', 'g'), ',+$', ''), '\s+', ' ', 'g'))"
    )


def plain_name_key(text: str) -> str:
    return rf"regexp_replace(regexp_replace(trim(lower({text})), ',+$', ''), '\s+', ' ', 'g')"


_DOCUMENTS = """
docs AS (
  SELECT k, 2007 + k % 15 AS yr,
    'NATION_' || (k % 25) AS team1, 'NATION_' || ((k + 1 + k % 24) % 25) AS team2,
    CAST(DATE '2008-01-01' + CAST(k % 5000 AS INTEGER) AS DATE) AS start_date,
    'Ground ' || k AS venue
  FROM ({keys})),
headers AS (
  SELECT *, CASE WHEN k % 5 = 0 THEN yr || '-' || lpad(CAST((yr + 1) % 100 AS VARCHAR), 2, '0')
      ELSE CAST(yr AS VARCHAR) END AS season,
    CASE WHEN k % 11 <> 0 THEN k % 4 ELSE 0 END AS n_innings
  FROM docs),
keyed AS (
  SELECT *, substr(sha1(lower(season || '|' || team1 || '|' || team2 || '|' || venue || '|' || start_date)), 1, 16)
    AS match_id
  FROM headers),
"""

_HEADS = _DOCUMENTS.replace("{keys}", "SELECT o_orderkey AS k FROM orders")
ORDER_DOCUMENTS = """
doc_lines AS (
  SELECT *, dense_rank() OVER (PARTITION BY k ORDER BY side) AS i,
    dense_rank() OVER (PARTITION BY k, side ORDER BY six) - 1 AS nth,
    row_number() OVER (PARTITION BY k, side, six ORDER BY num, p, s, l_discount, l_tax, flag) AS b
  FROM (SELECT l_orderkey AS k, CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS side,
      (CAST(l_quantity AS INTEGER) - 1) % 20 AS six, l_linenumber AS num, l_partkey AS p, l_suppkey AS s, l_returnflag AS flag, l_discount, l_tax,
      CAST(round(l_discount * 100) AS INTEGER) % 7 AS scored, CAST(round(l_tax * 100) AS INTEGER) AS tax
    FROM lineitem WHERE l_orderkey % 11 <> 0)),
doc_rows AS (
  SELECT DISTINCT k, i, side, CAST(NULL AS BIGINT) AS six, CAST(NULL AS BIGINT) AS nth, CAST(NULL AS BIGINT) AS b,
    CAST(NULL AS BIGINT) AS num, CAST(NULL AS BIGINT) AS p, CAST(NULL AS BIGINT) AS s, CAST(NULL AS VARCHAR) AS flag,
    CAST(NULL AS INTEGER) AS scored, CAST(NULL AS INTEGER) AS tax
  FROM doc_lines WHERE (k + side) % 7 = 0
  UNION ALL SELECT DISTINCT k, i, side, six, nth, NULL, NULL, NULL, NULL, NULL, NULL, NULL
  FROM doc_lines WHERE (k + side) % 7 <> 0 AND (k + six) % 13 = 0
  UNION ALL SELECT k, i, side, six, nth, b, num, p, s, flag, scored, tax
  FROM doc_lines WHERE (k + side) % 7 <> 0 AND (k + six) % 13 <> 0),
""" + _HEADS.replace("CASE WHEN k % 11 <> 0 THEN k % 4 ELSE 0 END AS n_innings", """coalesce(sides, 0) AS n_innings, first_side""").replace(
    "  FROM docs)", "  FROM docs LEFT JOIN (SELECT k, count(DISTINCT side) AS sides, min(side) AS first_side FROM doc_lines GROUP BY k) USING (k))"
) + """
doc_numbered AS (
  SELECT keyed.k AS k, match_id, season, team1, team2, i, b, num, p, s, flag, scored, tax, CASE side WHEN 1 THEN team1 WHEN 2 THEN team2 END AS batting_team,
    CASE WHEN keyed.k % 5 <> 0 THEN six ELSE nth END + 1 AS over_no
  FROM keyed LEFT JOIN doc_rows ON keyed.k = doc_rows.k),
doc_balls AS (
  SELECT match_id, season, CAST(i AS INTEGER) AS inning_no, CAST(over_no AS INTEGER) AS over_no, CAST(b AS INTEGER) AS ball_in_over,
    batting_team, CASE WHEN batting_team = team1 THEN team2 ELSE team1 END AS bowling_team,
    'P' || (p % 200) AS striker, 'P' || ((p + 1) % 200) AS non_striker, 'S' || s AS bowler,
    scored AS runs_batter, CAST(tax >= 5 AS INTEGER) AS runs_extras, scored + CAST(tax >= 5 AS INTEGER) AS runs_total,
    CAST(tax = 6 AS INTEGER) AS extra_byes, CAST(tax = 5 AS INTEGER) AS extra_legbyes,
    CAST(tax = 8 AS INTEGER) AS extra_wides, CAST(tax = 7 AS INTEGER) AS extra_noballs,
    coalesce(flag = 'R', FALSE) AS wicket_fell,
    CASE WHEN flag = 'R' THEN 'P' || (p % 200) END AS wicket_player_out,
    CASE WHEN flag = 'R' THEN CASE num % 4 WHEN 0 THEN 'bowled' WHEN 1 THEN 'caught' WHEN 2 THEN 'run out' ELSE 'lbw' END END AS wicket_kind,
    CASE WHEN flag = 'R' THEN 'P' || ((p + 9) % 200) END AS first_fielder,
    CASE WHEN flag = 'R' THEN fielders END AS fielders, substr(sha1(CASE WHEN b IS NULL THEN '{}' ELSE record END), 1, 16) AS src_record_hash,
    k || '.json' AS src_file_name,
    CASE WHEN b IS NOT NULL THEN match_id || printf('-%02d-%02d-%02d', i, over_no, b) END AS delivery_id
  FROM (SELECT *, '{"batter":"P' || (p % 200) || '","non_striker":"P' || ((p + 1) % 200) || '","bowler":"S' || s || '","runs":{"batter":' || scored
      || ',"extras":' || CAST(tax >= 5 AS INTEGER) || ',"total":' || (scored + CAST(tax >= 5 AS INTEGER)) || '}'
      || CASE tax WHEN 5 THEN ',"extras":{"legbyes":1}' WHEN 6 THEN ',"extras":{"byes":1}' WHEN 7 THEN ',"extras":{"noballs":1}'
        WHEN 8 THEN ',"extras":{"wides":1}' ELSE '' END
      || CASE flag WHEN 'N' THEN ',"wickets":[]' WHEN 'R' THEN ',"wickets":[{"player_out":"P' || (p % 200) || '","kind":"'
        || CASE num % 4 WHEN 0 THEN 'bowled' WHEN 1 THEN 'caught' WHEN 2 THEN 'run out' ELSE 'lbw' END || '","fielders":' || fielders || '}'
        || CASE WHEN num % 4 = 3 THEN ',{"player_out":"P' || ((p + 1) % 200) || '","kind":"run out","fielders":' || fielders || '}' ELSE '' END || ']'
        ELSE '' END || '}' AS record
    FROM (SELECT *, '[{"name":"P' || ((p + 9) % 200) || '","substitute":' || CASE num % 2 WHEN 0 THEN 'true' ELSE 'false' END || '}]' AS fielders
      FROM doc_numbered)))"""
MATCH_RECORD = """'{"season":"' || replace(season, '-', '/') || '","match_type":"T20","gender":"' || CASE k % 2 WHEN 0 THEN 'male' ELSE 'female' END
  || '","venue":"' || venue || '"' || CASE WHEN k % 6 <> 0 THEN ',"city":"City ' || (k % 50) || '"' ELSE '' END || ',"dates":["' || start_date
  || CASE WHEN k % 2 = 1 THEN '","' || CAST(start_date + 1 AS DATE) ELSE '' END || '"],"teams":["' || team1 || '","' || team2
  || '"],"toss":{"winner":"' || CASE WHEN k % 2 = 0 THEN team1 ELSE team2 END || '","decision":"'
  || CASE k % 3 WHEN 0 THEN 'bat' WHEN 1 THEN 'field' ELSE 'bowl' END || '"},"outcome":{'
  || CASE k % 3 WHEN 0 THEN '"winner":"' || team1 || '","by":{"runs":' || (1 + k % 90) || '}'
    WHEN 1 THEN '"winner":"' || team2 || '","by":{"wickets":' || (1 + k % 10) || '}' ELSE '' END
  || '},"player_of_match":[' || CASE WHEN k % 4 <> 0 THEN '"P' || (k % 200) || '"' ELSE '' END || '],"officials":{"umpires":["U' || (k % 40) || '"]}}'"""
DAY = "CAST(date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS BIGINT)"
WEEK = f"({DAY} // 7)"


def period_documents(period: str) -> str:
    return (
        ORDER_DOCUMENTS.replace("SELECT o_orderkey AS k FROM orders", f"SELECT DISTINCT {period} AS k FROM orders")
        .replace("SELECT l_orderkey AS k,", f"SELECT {period} AS k,")
        .replace("FROM lineitem WHERE l_orderkey % 11 <> 0", f"FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE {period} % 11 <> 0")
    )


DAILY_DOCUMENTS, WEEKLY_DOCUMENTS = period_documents(DAY), period_documents(WEEK)
