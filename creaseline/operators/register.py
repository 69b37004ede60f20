"""People and team dimensions, and the resolution of names to their ids."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from creaseline.functions.keys import team_key
from creaseline.functions.parsing import lookup
from creaseline.functions.text import NameRules, name_key, strip_marks
from creaseline.sources.schemas import DIM_PLAYER

# Historic or variant team names and the name each is filed under.
TEAM_OVERRIDES = {
    "Delhi Daredevils": "Delhi Capitals",
    "Kings XI Punjab": "Punjab Kings",
    "Rising Pune Supergiants": "Rising Pune Supergiant",
}
# Which kind of name decides when one key leads to several people.
KEY_ORDER = ("unique_name", "name", "alias")

MATCH_TEAM_COLUMNS = ("team1", "team2", "toss_winner", "winner", "first_batting_team", "second_batting_team")
BALL_TEAM_COLUMNS = ("batting_team", "bowling_team")
BALL_PLAYER_ROLES = {"striker": "striker_id", "non_striker": "non_striker_id", "bowler": "bowler_id"}
BALL_TEAM_ROLES = {name: f"{name}_id" for name in BALL_TEAM_COLUMNS}
MATCH_TEAM_ROLES = {name: f"{name}_id" for name in MATCH_TEAM_COLUMNS}
AWARD_ROLE = {"player_of_match": "player_of_match_id"}


def _name_set(col: str) -> Column:
    return F.sort_array(F.collect_set(col))


def dim_player(
    people: DataFrame,
    aliases: DataFrame,
    rules: NameRules = NameRules(),
    id_cricinfo: str | None = "key_cricinfo",
    id_cricbuzz: str | None = "key_cricbuzz",
) -> DataFrame:
    """One row per person with every name it goes by in comparison form.

    The names are those of :func:`register_keys`, spread over a column per kind; repeated
    copies of one alias are removed before they meet. Blank names are no names.
    """
    of_kind = {kind: F.when(F.col("kind") == kind, F.col("key")) for kind in KEY_ORDER}
    names = register_keys(people, aliases, rules).distinct().groupBy(F.col("id").alias("player_id")).agg(
        F.min(of_kind["name"]).alias("name_norm"),
        F.min(of_kind["unique_name"]).alias("unique_name_norm"),
        F.sort_array(F.collect_set(of_kind["alias"])).alias("aliases_norm"),
    )
    unset = F.lit(None).cast("string")
    ids = {"id_cricinfo": id_cricinfo, "id_cricbuzz": id_cricbuzz}
    persons = people.withColumnRenamed("identifier", "player_id").withColumns(
        {target: F.col(source) if source else unset for target, source in ids.items()}
    )
    known = persons.join(names, "player_id", "left").withColumn(
        "aliases_norm", F.coalesce("aliases_norm", F.array().cast("array<string>"))
    )
    every = F.array_union(F.array("name_norm", "unique_name_norm"), F.col("aliases_norm"))
    return known.withColumn("all_keys_norm", every).select(*DIM_PLAYER.fieldNames())


def player_alias_keys(dim: DataFrame) -> DataFrame:
    """Every (player, key) pair of the dimension."""
    return dim.select("player_id", F.explode("all_keys_norm").alias("key")).where("key is not null")


def team_alias_keys(dim: DataFrame) -> DataFrame:
    """Every (team, key) pair of the dimension."""
    known_as = F.array_union(
        F.array("name_canonical_norm"), F.coalesce("aliases_norm", F.array().cast("array<string>"))
    )
    return dim.select("team_id", F.explode(known_as).alias("key"))


def register_keys(people: DataFrame, aliases: DataFrame, rules: NameRules = NameRules()) -> DataFrame:
    """(id, key, kind) rows straight from the register, without gathering names per person."""
    names = people.select(
        F.col("identifier").alias("id"),
        F.explode(
            F.array(
                F.struct(F.lit("unique_name").alias("kind"), F.col("unique_name").alias("text")),
                F.struct(F.lit("name").alias("kind"), F.col("name").alias("text")),
            )
        ).alias("entry"),
    ).select("id", "entry.kind", "entry.text")
    known_as = aliases.select(F.col("identifier").alias("id"), F.lit("alias").alias("kind"), F.col("name").alias("text"))
    return (
        names.unionByName(known_as)
        .select("id", name_key(F.col("text"), rules).alias("key"), "kind")
        .where("key <> ''")
    )


def one_id_per_key(keys: DataFrame, order: Sequence[str] = KEY_ORDER) -> DataFrame:
    """The id each key stands for: the earliest kind in ``order`` wins, then the smallest id.

    Kinds that are not in ``order`` do not count.
    """
    ranks = lookup(F.col("kind"), {kind: f"{at:02d}" for at, kind in enumerate(order)})
    return keys.where(F.col("kind").isin(*order)).groupBy("key").agg(F.min(F.struct(ranks.alias("rank"), "id"))["id"].alias("id"))


def resolve_roles(
    facts: DataFrame,
    keys: DataFrame,
    roles: Mapping[str, str],
    comparison: Callable[[Column], Column] = name_key,
    settle: Callable[[DataFrame], DataFrame] = lambda table: table,
    deal: int | None = None,
) -> DataFrame:
    """Add an id column for each name column of ``roles``.

    ``keys`` has columns (id, key). The facts are shuffled once, whatever the number of
    roles: the distinct combinations of names are resolved role by role, from the
    distinct names brought to comparison form once, and the facts then join on their
    combination. Combinations are found by an aggregate, which one name in a third of all
    rows shortens, and are unique, so that the join can be split where one is frequent.
    Rows without any name are dealt by their other columns and meet nothing. Pass a table
    writer as ``settle`` to store names and combinations first: Spark then knows their size
    when it plans the joins, and broadcasts them only below its own threshold. ``deal`` is the
    number of parts in which facts and combinations then meet, for facts of which the session's
    number of shuffle partitions would make parts beyond a task's memory.

    Target columns that exist already are replaced, so a second run changes
    nothing. With several ids per key every match is kept, which repeats the row.
    """
    facts = facts.drop(*roles.values())
    columns, names = facts.columns, list(roles)
    named = reduce(Column.__or__, (F.col(name).isNotNull() for name in names))
    combined = settle(facts.where(named).select(*names).distinct())
    in_use = combined.select(F.explode(F.array(*names)).alias("text")).where("text is not null").distinct()
    folded = settle(in_use.withColumn("key", comparison(F.col("text"))))  # stored, so no filter on the form moves below the distinct
    known = folded.join(keys, "key").select("text", "id")
    for name, target in roles.items():
        side = known.select(F.col("text").alias(name), F.col("id").alias(target))
        combined = combined.join(side, name, "left")
    mark = F.xxhash64(*names)
    combined = settle(combined.select(mark.alias("_mark"), *(F.col(c).alias(f"_{c}") for c in names), *roles.values()))
    same = reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in names))
    marked = facts.withColumn("_own", F.when(named, mark).otherwise(F.xxhash64(*columns)))
    if deal:
        marked, combined = marked.repartition(deal, "_own"), combined.repartition(deal, "_mark")
    return marked.join(combined, (F.col("_own") == F.col("_mark")) & same, "left").select(*columns, *roles.values())


def team_names(matches: DataFrame, balls: DataFrame) -> DataFrame:
    """Distinct team names over all team columns of both tables."""

    def names(df: DataFrame, columns: Sequence[str]) -> DataFrame:
        combinations = df.select(*columns).distinct()
        return combinations.select(F.explode(F.array(*columns)).alias("team")).where("team is not null").distinct()

    return names(matches, MATCH_TEAM_COLUMNS).union(names(balls, BALL_TEAM_COLUMNS)).distinct()


def canonical_team(team: Column, overrides: Mapping[str, str]) -> Column:
    """The override for a variant spelling, else the name itself."""
    return F.coalesce(lookup(name_key(team), override_keys(overrides)), team)


def override_keys(overrides: Mapping[str, str]) -> dict[str, str]:
    """Override table keyed by comparison form: a literal table of the driver program."""
    return {" ".join(strip_marks(v).lower().split()).rstrip(",").rstrip(): name for v, name in overrides.items()}


def dim_team(names: DataFrame, overrides: Mapping[str, str] = TEAM_OVERRIDES) -> DataFrame:
    """One row per team, grouped by the comparison form of its canonical name."""
    filed = names.select(
        name_key(F.col("team")).alias("alias"), canonical_team(F.col("team"), overrides).alias("filed_as")
    ).withColumn("name_canonical_norm", name_key(F.col("filed_as")))
    return (
        filed.groupBy("name_canonical_norm", "alias")
        .agg(F.min("filed_as").alias("filed_as"))
        .groupBy("name_canonical_norm")
        .agg(F.min("filed_as").alias("name_canonical"), _name_set("alias").alias("aliases_norm"))
        .select(
            team_key(F.col("name_canonical_norm")).alias("team_id"),
            "name_canonical",
            "name_canonical_norm",
            "aliases_norm",
        )
    )
