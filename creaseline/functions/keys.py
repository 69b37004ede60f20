"""Deterministic keys and hashes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

HASH_CHARS = 16
TEAM_HASH_CHARS = 12


def short_sha1(text: Column, chars: int = HASH_CHARS) -> Column:
    return F.substring(F.sha1(text), 1, chars)


def match_key(season: Column, team1: Column, team2: Column, venue: Column, start_date: Column) -> Column:
    """Key of a match; a missing part counts as the empty string."""
    parts = [F.coalesce(F.lower(part.cast("string")), F.lit("")) for part in (season, team1, team2, venue, start_date)]
    return short_sha1(F.concat_ws("|", *parts))


def two_digits(n: Column) -> Column:
    """At least two digits, like ``%02d`` for the numbers that occur here."""
    return F.concat(F.when(n.between(0, 9), "0").otherwise(""), n.cast("string"))


def ball_key(match_id: Column, inning_no: Column, over_no: Column, ball_in_over: Column) -> Column:
    """``match-ii-oo-bb``, or null when any ordinal is missing (a placeholder row is no ball)."""
    dash = F.lit("-")
    return F.concat(
        match_id, dash, two_digits(inning_no), dash, two_digits(over_no), dash, two_digits(ball_in_over)
    )


def team_key(name_norm: Column) -> Column:
    return F.concat(F.lit("team_"), short_sha1(name_norm, TEAM_HASH_CHARS))


def base_name(path: Column) -> Column:
    """Last component of a path written with either slash."""
    return F.element_at(F.split(path, r"[/\\]+"), -1)


def record_hash(payload: Column) -> Column:
    """Hash of the JSON form of a struct; a null struct hashes as an empty object."""
    return short_sha1(F.coalesce(F.to_json(payload), F.lit("{}")))
