"""Nested match documents to flat match rows and ball rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from creaseline.functions.keys import ball_key, match_key
from creaseline.functions.text import season_label
from creaseline.sources.lineage import with_lineage

EXTRA_KINDS = ("byes", "legbyes", "wides", "noballs")
RUN_KINDS = ("batter", "extras", "total")


def nth(items: Column, position: int) -> Column:
    """Array element by 1-based position; null past the end."""
    return F.get(items, position - 1)


def whole_number(col: Column) -> Column:
    return col.try_cast("int")


def opponent(side: Column, team1: Column, team2: Column) -> Column:
    """The other team of the match; an unknown side gives ``team1``."""
    return F.when(side == team1, team2).otherwise(team1)


def result_kind(by: Column) -> Column:
    return F.when(by["runs"].isNotNull(), "runs").when(by["wickets"].isNotNull(), "wickets")


def result_margin(by: Column) -> Column:
    return whole_number(F.coalesce(by["runs"], by["wickets"]))


def _match_header(path_col: str) -> dict[str, Column]:
    """The document fields that identify a match."""
    info = F.col("info")
    header = {
        "season": season_label(info["season"]),
        "venue": info["venue"],
        "match_start_date": nth(info["dates"], 1).cast("string"),
        "team1": nth(info["teams"], 1),
        "team2": nth(info["teams"], 2),
        "src_file_path": F.col(path_col),
    }
    header["match_id"] = match_key(
        header["season"], header["team1"], header["team2"], header["venue"], header["match_start_date"]
    )
    return header


def match_rows(documents: DataFrame, path_col: str = "src_file_path") -> DataFrame:
    """One row per document (bronze matches). Documents may come in parts, see :mod:`sources.pieces`."""
    if "part" in documents.columns:
        documents = documents.where("part IS NULL OR part = 'head'")
    info = F.col("info")
    by = info["outcome"]["by"]
    columns = _match_header(path_col) | {
        "match_type": info["match_type"],
        "gender": info["gender"],
        "city": info["city"],
        "match_end_date": nth(info["dates"], 2).cast("string"),
        "toss_winner": info["toss"]["winner"],
        "toss_decision": info["toss"]["decision"],
        "winner": info["outcome"]["winner"],
        "result": result_kind(by),
        "result_margin": result_margin(by),
        "player_of_match": nth(info["player_of_match"], 1),
        "officials": info["officials"],
    }
    flat = documents.select(info, *(value.alias(name) for name, value in columns.items()))
    return with_lineage(flat, F.col("info")).select(
        "match_id", "season", "match_type", "gender", "venue", "city", "match_start_date", "match_end_date", "team1", "team2",
        "toss_winner", "toss_decision", "winner", "result", "result_margin", "player_of_match", "officials",
        "src_file_path", "src_file_name", "src_ingest_ts", "src_record_hash",
    )


def ball_rows(documents: DataFrame, path_col: str = "src_file_path") -> DataFrame:
    """One row per ball (bronze deliveries), document order kept as 1-based ordinals.

    A document without innings, an innings without overs and an over without
    balls each leave one placeholder row: no ``delivery_id``, no extras, so that
    it never counts as a ball. Documents may come in parts, see :mod:`sources.pieces`:
    their ordinals are those in the whole document.
    """
    header = _match_header(path_col)
    place = []
    if "part" in documents.columns:
        documents, place = documents.where("part IS NULL OR part <> 'head'"), ["at"]
    ordinal = lambda position, level: F.col(position) + (F.coalesce(F.col("at")[level], F.lit(0)) if place else 0) + 1
    named = documents.select(*(value.alias(name) for name, value in header.items()), *place, "innings")
    innings = named.select(*header, *place, F.posexplode_outer("innings").alias("innings_at", "side"))
    overs = innings.select(
        *header,
        *place,
        "innings_at",
        F.col("side.team").alias("batting_team"),
        F.posexplode_outer("side.overs").alias("over_at", "six"),
    )
    balls = overs.select(
        *header,
        *place,
        ordinal("innings_at", "innings").alias("inning_no"),
        "batting_team",
        F.coalesce(whole_number(F.col("six.over")) + 1, ordinal("over_at", "over")).alias("over_no"),
        F.posexplode_outer("six.deliveries").alias("ball_at", "ball"),
    ).withColumn("ball_in_over", ordinal("ball_at", "ball"))

    ball = F.col("ball")
    wicket = nth(ball["wickets"], 1)
    real = ball.isNotNull()
    shaped = balls.select(
        "match_id",
        "season",
        "inning_no",
        "over_no",
        "ball_in_over",
        "batting_team",
        opponent(F.col("batting_team"), F.col("team1"), F.col("team2")).alias("bowling_team"),
        ball["batter"].alias("striker"),
        ball["non_striker"].alias("non_striker"),
        ball["bowler"].alias("bowler"),
        *(whole_number(ball["runs"][kind]).alias(f"runs_{kind}") for kind in RUN_KINDS),
        *(
            F.when(real, F.coalesce(whole_number(ball["extras"][kind]), F.lit(0))).alias(f"extra_{kind}")
            for kind in EXTRA_KINDS
        ),
        wicket.isNotNull().alias("wicket_fell"),
        wicket["player_out"].alias("wicket_player_out"),
        wicket["kind"].alias("wicket_kind"),
        wicket["fielders"].alias("wicket_fielders"),
        "src_file_path",
        ball_key(
            F.col("match_id"), F.col("inning_no"), F.col("over_no"), F.col("ball_in_over")
        ).alias("delivery_id"),
        ball,
    )
    return with_lineage(shaped, ball).drop("ball")


def raw_profile(documents: DataFrame) -> DataFrame:
    """Per document: the headline fields, the number of innings (-1 for none given) and who batted first."""
    info = F.col("info")
    fields = ("season", "match_type", "gender", "city", "venue", "teams", "dates")
    return documents.select(
        *(info[name].alias(name) for name in fields),
        info["toss"].alias("toss"),
        info["outcome"].alias("outcome"),
        info["player_of_match"].alias("player_of_match"),
        info["officials"].alias("officials"),
        F.coalesce(F.size("innings"), F.lit(-1)).alias("n_innings"),
        F.get("innings", 0)["team"].alias("inning1_team"),
        "src_file_path",
    )
