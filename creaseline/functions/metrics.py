"""Scoring rules of the game as column expressions over ball rows."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Dismissals credited to the bowler.
CREDITED_DISMISSALS = ("bowled", "caught", "lbw", "stumped", "hit wicket", "caught and bowled", "hit the ball twice")
BALLS_PER_OVER = 6.0
FULL_INNINGS_BALLS = 120


def ones(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)


def tally(condition: Column) -> Column:
    return F.sum(ones(condition))


def faced() -> Column:
    """A batter faces everything but wides."""
    return F.col("extra_wides") == 0


def legal() -> Column:
    """A ball of the over: neither wide nor no-ball."""
    return (F.col("extra_wides") == 0) & (F.col("extra_noballs") == 0)


def charged_runs() -> Column:
    """Runs against the bowler: byes and leg-byes are not, penalties are."""
    return (F.col("runs_total") - (F.col("extra_byes") + F.col("extra_legbyes"))).cast("int")


def credited_wicket() -> Column:
    return F.col("wicket_fell") & F.lower(F.col("wicket_kind")).isin(*CREDITED_DISMISSALS)


def ratio(num: Column, den: Column) -> Column:
    """Quotient as double; null for a null or zero divisor."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def batting_rate(runs: Column, balls: Column) -> Column:
    return ratio(runs * F.lit(100.0), balls)


def economy_rate(runs: Column, balls: Column) -> Column:
    return ratio(runs * F.lit(BALLS_PER_OVER), balls)


def balls_per_wicket(balls: Column, wickets: Column) -> Column:
    return ratio(balls, wickets)


def overs(balls: Column) -> Column:
    """Decimal overs: 15 balls are 2.5."""
    return balls / F.lit(BALLS_PER_OVER)


def phase(over_no: Column) -> Column:
    """Powerplay, middle or death; an unknown over counts as death."""
    return F.when(over_no.between(1, 6), "PP").when(over_no.between(7, 15), "MID").otherwise("DEATH")
