"""The driver's tables seen as match data.

Orders act as matches, their lines as balls, nations as teams and suppliers as
people. Every column is computed from the row itself, so the only joins are
line to order to customer. ``plans.adapter_sql`` states the same view in SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from creaseline.functions.keys import ball_key
from creaseline.operators.flatten import opponent


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


PART_BYTES = 4 << 20  # of the lines as they are stored, some 300,000 rows
LEAST_PARTS = 8


def parts(spark: SparkSession, folder: str) -> int:
    """In how many parts the lines are dealt by a key: a number that grows with them, so that a part does not.

    It is not below the session's number of shuffle partitions: where two tables dealt in fewer parts meet, Spark deals
    both in that number instead, and every task would then write into many buckets.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/lineitem.parquet")
    stored = path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    return max(LEAST_PARTS, int(spark.conf.get("spark.sql.shuffle.partitions")), 1 << (stored // PART_BYTES).bit_length())


def text(col: Column) -> Column:
    return col.cast("string")


def pick(number: Column, *choices: str | Column | None) -> Column:
    """The choice at position ``number``."""
    first, *others = choices
    chosen = F.when(number == 0, first)
    for at, choice in enumerate(others, 1):
        chosen = chosen.when(number == at, choice)
    return chosen


def padded(number: Column) -> Column:
    return F.lpad(text(number), 9, "0")


# ---------------------------------------------------------------- balls

# What the balls are made of; the lines' other columns are not stored with them.
BALL_SOURCE = (
    "l_orderkey", "l_linestatus", "l_quantity", "l_linenumber", "l_partkey", "l_suppkey", "l_discount", "l_tax", "l_returnflag",
)


def dealt_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The lines dealt by match, before anything is made of them: joins and sums by match need no further shuffle."""
    lines = table(spark, folder, "lineitem").select(*BALL_SOURCE, text(F.col("l_orderkey")).alias("match_id"))
    return lines.repartition(parts(spark, folder), "match_id")


def line_balls(spark: SparkSession, folder: str) -> DataFrame:
    """What a line alone says about its ball: no join, no season, no teams."""
    return balls_of(table(spark, folder, "lineitem").withColumn("match_id", text(F.col("l_orderkey"))))


def balls_of(lines: DataFrame, *kept: str) -> DataFrame:
    """Lines, with their match, as balls; ``kept`` columns stay."""
    maker = "lpad(string(l_suppkey), 9, '0')"
    extra = "int(rint(l_tax * 100))"
    parts = lines.selectExpr(
        "l_orderkey",
        "match_id",
        *kept,
        "if(l_linestatus = 'F', 1, 2) AS inning_no",
        "1 + (int(l_quantity) - 1) % 20 AS over_no",
        "l_linenumber AS ball_in_over",
        "concat('P', l_partkey % 200) AS striker",
        "concat('P', (l_partkey + 1) % 200) AS non_striker",
        f"""CASE l_linenumber % 5
            WHEN 0 THEN concat('Supplier#', {maker})
            WHEN 1 THEN concat('SUPPLIER#', {maker}, ',')
            WHEN 2 THEN concat('  Supplier#', {maker}, ' ')
            WHEN 3 THEN concat('The  Supplier#', {maker})
            WHEN 4 THEN concat('Sùpplier#', {maker}) END AS bowler""",
        "string(l_partkey % 200) AS striker_id",
        "string((l_partkey + 1) % 200) AS non_striker_id",
        "string(l_suppkey) AS bowler_id",
        "int(rint(l_discount * 100)) % 7 AS runs_batter",
        f"int({extra} >= 5) AS runs_extras",
        f"int({extra} = 5) AS extra_legbyes",
        f"int({extra} = 6) AS extra_byes",
        f"int({extra} = 7) AS extra_noballs",
        f"int({extra} = 8) AS extra_wides",
        "l_returnflag = 'R' AS wicket_fell",
        """CASE WHEN l_returnflag = 'R' THEN
            CASE l_linenumber % 4 WHEN 0 THEN 'bowled' WHEN 1 THEN 'caught' WHEN 2 THEN 'run out' ELSE 'lbw' END
            END AS wicket_kind""",
        """CASE WHEN l_returnflag = 'R' THEN concat('P', (l_partkey + l_linenumber % 2) % 200) END
            AS wicket_player_out""",
    )
    place = (F.col(c) for c in ("match_id", "inning_no", "over_no", "ball_in_over"))
    return parts.withColumns(
        {"runs_total": F.col("runs_batter") + F.col("runs_extras"), "delivery_id": ball_key(*place)}
    )


# What the matches are made of.
MATCH_SOURCE = ("o_orderkey", "o_orderstatus", "o_orderdate", "o_orderpriority", "c_nationkey", "c_mktsegment")


def match_sides(spark: SparkSession, folder: str, dealt: bool = False) -> DataFrame:
    """Orders with season and both teams; where they are to be ``dealt`` by match, this is done before anything is made of them."""
    orders, customers = table(spark, folder, "orders"), table(spark, folder, "customer")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    if dealt:
        joined = joined.select(*MATCH_SOURCE).repartition(parts(spark, folder), text(F.col("o_orderkey")))
    return joined.selectExpr(
        "o_orderkey",
        "string(year(o_orderdate)) AS season",
        "concat('NATION_', c_nationkey) AS team1",
        "concat('NATION_', (c_nationkey + 1 + o_orderkey % 24) % 25) AS team2",
        "o_orderstatus",
        "o_orderdate",
        "o_orderpriority AS venue",
        "c_mktsegment AS city",
    )


def balls(spark: SparkSession, folder: str, lines: DataFrame | None = None) -> DataFrame:
    """Ball rows with season, teams and ids; of ``lines``, which are dealt by match, where they are stored already."""
    sides = match_sides(spark, folder).select(text(F.col("o_orderkey")).alias("match_id"), "season", "team1", "team2")
    first = F.col("inning_no") == 1
    batting = F.when(first, F.col("team1")).otherwise(F.col("team2"))
    lines = dealt_lines(spark, folder) if lines is None else lines
    joined = lines.join(sides.repartition(parts(spark, folder), "match_id"), "match_id")
    return (
        balls_of(joined, "season", "team1", "team2")
        .withColumn("batting_team", batting)
        .withColumn("bowling_team", opponent(F.col("batting_team"), F.col("team1"), F.col("team2")))
        .withColumns({"batting_team_id": F.col("batting_team"), "bowling_team_id": F.col("bowling_team")})
        .drop("l_orderkey", "team1", "team2")
    )


def season_balls(spark: SparkSession, folder: str, lines: DataFrame | None = None) -> DataFrame:
    """Ball rows with season but without teams: customers are not needed."""
    orders = table(spark, folder, "orders").select(text(F.col("o_orderkey")).alias("match_id"), text(F.year("o_orderdate")).alias("season"))
    lines = dealt_lines(spark, folder) if lines is None else lines
    joined = lines.join(orders.repartition(parts(spark, folder), "match_id"), "match_id")
    return balls_of(joined, "season").drop("l_orderkey")


def noisy(team: Column, number: Column) -> Column:
    """A team name as people type it."""
    return pick(
        number % 3,
        team,
        F.concat(F.lit(" "), F.lower(team), F.lit(",")),
        F.concat(F.upper(team), F.lit("  ")),
    )


def noisy_balls(spark: SparkSession, folder: str, lines: DataFrame | None = None) -> DataFrame:
    """Ball rows whose team names are typed in three ways and not resolved."""
    number = F.col("ball_in_over")
    return (
        balls(spark, folder, lines)
        .drop("batting_team_id", "bowling_team_id")
        .withColumns({c: noisy(F.col(c), number) for c in ("batting_team", "bowling_team")})
    )


def flawed_balls(spark: SparkSession, folder: str) -> DataFrame:
    """Ball rows with known defects, for the quality checks."""
    number, over = F.col("ball_in_over"), F.col("over_no")
    return balls(spark, folder).withColumns(
        {
            "runs_total": F.when(number == 7, F.lit(None)).when(over == 20, F.lit(11)).otherwise(F.col("runs_total")),
            "bowling_team": pick(
                number % 4, F.col("bowling_team"), F.col("bowling_team"), F.col("batting_team"), F.lit("Guests")
            ),
            "wicket_kind": F.when(over != 3, F.col("wicket_kind")),
            "delivery_id": F.when(over != 19, F.col("delivery_id")),
        }
    )


# -------------------------------------------------------------- matches


def bronze_matches(spark: SparkSession, folder: str, dealt: bool = False) -> DataFrame:
    """Match rows before standardisation: raw dates, toss and result; ``dealt`` by match for a join or buckets."""
    sides = match_sides(spark, folder, dealt).withColumn(
        "toss_winner", noisy(F.expr("if(o_orderkey % 2 = 0, team1, team2)"), F.col("o_orderkey"))
    )
    return sides.selectExpr(
        "string(o_orderkey) AS match_id",
        "season",
        "'T20' AS match_type",
        "if(o_orderkey % 2 = 0, 'male', 'female') AS gender",
        "venue",
        "city",
        """CASE o_orderkey % 3
            WHEN 0 THEN date_format(o_orderdate, 'yyyy-MM-dd')
            WHEN 1 THEN date_format(o_orderdate, 'yyyy/MM/dd')
            ELSE date_format(o_orderdate, 'dd-MMM-yyyy') END AS match_start_date""",
        "if(o_orderkey % 5 = 0, 'not a date', NULL) AS match_end_date",
        "team1",
        "team2",
        "toss_winner",
        "CASE o_orderkey % 4 WHEN 0 THEN ' Bat ' WHEN 1 THEN 'bowl' WHEN 2 THEN 'FIELD' ELSE 'unknown' END AS toss_decision",
        "CASE o_orderstatus WHEN 'F' THEN team1 WHEN 'O' THEN team2 END AS winner",
        "CASE o_orderstatus WHEN 'F' THEN 'runs' WHEN 'O' THEN 'wickets' END AS result",
        "if(o_orderstatus <> 'P', int(1 + o_orderkey % 90), NULL) AS result_margin",
        "concat('P', o_orderkey % 200) AS player_of_match",
        "string(NULL) AS src_file_path",
        "string(NULL) AS src_file_name",
        "timestamp(NULL) AS src_ingest_ts",
        "string(NULL) AS src_record_hash",
    )


# ------------------------------------------------------------- register


def people(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as the people file."""
    key = F.col("s_suppkey")
    return table(spark, folder, "supplier").select(
        text(key).alias("identifier"),
        F.col("s_name").alias("name"),
        F.concat("s_name", F.lit(" ("), text(F.col("s_nationkey")), F.lit(")")).alias("unique_name"),
        text(key + 1000).alias("key_cricinfo"),
        F.when(key % 3 == 0, text(key + 5000)).alias("key_cricbuzz"),
    )


def people_aliases(spark: SparkSession, folder: str) -> DataFrame:
    """Further names: short form, shouting with commas, a prefix, a neighbour's name, a shared one, none."""
    key, name = F.col("s_suppkey"), F.col("s_name")
    variants = F.array(
        F.concat(F.lit("P"), text(key)),
        F.concat(F.lit("  "), F.upper(name), F.lit(",,")),
        F.when(key % 2 == 0, F.concat(F.lit("The \t"), name)),
        F.when(key % 10 == 0, F.concat(F.lit("Süpplier#"), padded(key + 1))),
        F.when(key % 7 == 0, F.lit("Guest")),
    )
    return table(spark, folder, "supplier").select(text(key).alias("identifier"), F.explode(variants).alias("name"))


def teams(spark: SparkSession, folder: str) -> DataFrame:
    """Nations as the team dimension of the resolved balls."""
    return table(spark, folder, "nation").select(
        F.col("n_name").alias("team_id"), F.concat(F.lit("Team "), text(F.col("n_nationkey"))).alias("name_canonical")
    )


# Variant team names of this view and the name each is filed under.
NATION_OVERRIDES = {"NATION_3": "NATION_4", "NATION_7": "NATION_8"}


# ------------------------------------------------------------ documents


def player(n: Column) -> Column:
    return F.concat(F.lit("P"), text(n % 200))


def sides_of(k: Column) -> tuple[Column, Column]:
    """Both teams of the match with key ``k``."""
    return F.concat(F.lit("NATION_"), text(k % 25)), F.concat(F.lit("NATION_"), text((k + 1 + k % 24) % 25))


def document_head(k: Column) -> Column:
    """The info part of a document: one date or two, a season written with a slash, no result, no star."""
    home, away = sides_of(k)
    year = 2007 + k % 15
    season = F.when(
        k % 5 == 0, F.concat(text(year), F.lit("/"), F.lpad(text((year + 1) % 100), 2, "0"))
    ).otherwise(text(year))
    start = F.date_add(F.lit("2008-01-01").cast("date"), (k % 5000).cast("int"))
    nothing = F.lit(None).cast("bigint")
    by = F.when(k % 3 == 0, F.struct((1 + k % 90).alias("runs"), nothing.alias("wickets"))).when(
        k % 3 == 1, F.struct(nothing.alias("runs"), (1 + k % 10).alias("wickets"))
    )
    stars = F.when(k % 4 == 0, F.array().cast("array<string>")).otherwise(F.array(player(k)))
    info = F.struct(
        season.alias("season"),
        F.lit("T20").alias("match_type"),
        pick(k % 2, "male", "female").alias("gender"),
        F.concat(F.lit("Ground "), text(k)).alias("venue"),
        F.when(k % 6 != 0, F.concat(F.lit("City "), text(k % 50))).alias("city"),
        F.when(k % 2 == 0, F.array(text(start)))
        .otherwise(F.array(text(start), text(F.date_add(start, 1))))
        .alias("dates"),
        F.array(home, away).alias("teams"),
        F.struct(
            F.when(k % 2 == 0, home).otherwise(away).alias("winner"), pick(k % 3, "bat", "field", "bowl").alias("decision")
        ).alias("toss"),
        F.struct(F.when(k % 3 == 0, home).when(k % 3 == 1, away).alias("winner"), by.alias("by")).alias("outcome"),
        stars.alias("player_of_match"),
        F.struct(
            F.array(F.concat(F.lit("U"), text(k % 40))).alias("umpires"),
            F.lit(None).cast("array<string>").alias("tv_umpires"),
            F.lit(None).cast("array<string>").alias("reserve_umpires"),
            F.lit(None).cast("array<string>").alias("match_referees"),
        ).alias("officials"),
    )
    return info


def document(k: Column, innings: Column) -> list[Column]:
    return [
        F.concat(F.lit("file:/matches/"), text(k), F.lit(".json")).alias("src_file_path"),
        document_head(k).alias("info"),
        innings.alias("innings"),
    ]


def line_ball(line: Column) -> Column:
    """A line as a ball of a document: extras where there are any; no, one or two wickets, or an empty list."""
    tax, number = F.rint(line["l_tax"] * 100).cast("bigint"), line["l_linenumber"].cast("bigint")
    scored, part = F.rint(line["l_discount"] * 100).cast("bigint") % 7, line["l_partkey"]
    extra = F.when(tax >= 5, F.lit(1)).otherwise(0).cast("bigint")
    of_kind = lambda rate: F.when(tax == rate, extra)
    fielder = F.struct(player(part + 9).alias("name"), (number % 2 == 0).alias("substitute"))
    wicket = F.struct(
        player(part).alias("player_out"),
        pick(number % 4, "bowled", "caught", "run out", "lbw").alias("kind"),
        F.array(fielder).alias("fielders"),
    )
    second = F.struct(player(part + 1).alias("player_out"), F.lit("run out").alias("kind"), F.array(fielder).alias("fielders"))
    return F.struct(
        player(part).alias("batter"),
        player(part + 1).alias("non_striker"),
        F.concat(F.lit("S"), text(line["l_suppkey"])).alias("bowler"),
        F.struct(scored.alias("batter"), extra.alias("extras"), (scored + extra).alias("total")).alias("runs"),
        F.when(
            tax >= 5,
            F.struct(of_kind(6).alias("byes"), of_kind(5).alias("legbyes"), of_kind(8).alias("wides"), of_kind(7).alias("noballs")),
        ).alias("extras"),
        F.when(line["l_returnflag"] == "R", F.when(number % 4 == 3, F.array(wicket, second)).otherwise(F.array(wicket)))
        .when(line["l_returnflag"] == "N", F.slice(F.array(wicket), 1, 0))
        .alias("wickets"),
    )


LINE_FIELDS = ("l_linenumber", "l_partkey", "l_suppkey", "l_discount", "l_tax", "l_returnflag")


def dealt_by_key(lines: DataFrame, deal: int) -> DataFrame:
    """What documents are made of, dealt by their key ``k`` before anything is nested."""
    return lines.select("k", "l_linestatus", "l_quantity", *LINE_FIELDS).repartition(deal, "k")


def line_place() -> list[Column]:
    """side, over: where a line's ball stands in its document."""
    side = F.when(F.col("l_linestatus") == "F", 1).otherwise(2)
    over = ((F.col("l_quantity").cast("int") - 1) % 20).cast("bigint")
    return [side.alias("side"), over.alias("over")]


def gathered_lines(dealt: DataFrame) -> DataFrame:
    """k, sixes: the lines of each key ``k``, by which they are dealt, by side and over."""
    entry = F.struct(*LINE_FIELDS)  # several lines may have one number
    overs = dealt.groupBy("k", *line_place()).agg(F.sort_array(F.collect_list(entry)).alias("lines"))
    return overs.groupBy("k").agg(F.sort_array(F.collect_list(F.struct("side", "over", "lines"))).alias("sixes"))


def has_innings(k: Column) -> Column:
    return k % 11 != 0


def has_overs(k: Column, side: Column) -> Column:
    return (k + side) % 7 != 0


def has_balls(k: Column, over: Column) -> Column:
    return (k + over) % 13 != 0


def nested_innings(k: Column, sixes: Column, ball: Callable[[Column], Column] = line_ball) -> Column:
    """The overs of a key, nested by side.

    Some innings have no overs, some overs no balls, and some matches no over numbers.
    """
    home, away = sides_of(k)

    def six(entry: Column) -> Column:
        over, balls = entry["over"], F.transform(entry["lines"], ball)
        balls = F.when(has_balls(k, over), balls).otherwise(F.slice(balls, 1, 0))
        return F.struct(F.when(k % 5 != 0, over).alias("over"), balls.alias("deliveries"))

    def innings(side: Column) -> Column:
        overs = F.transform(F.filter(sixes, lambda x: x["side"] == side), six)
        return F.struct(F.when(side == 1, home).otherwise(away).alias("team"), F.when(has_overs(k, side), overs).alias("overs"))

    return F.transform(F.array_distinct(F.transform(sixes, lambda x: x["side"])), innings)


def nested_documents(keys: DataFrame, sixes: DataFrame, deal: int, ball: Callable[[Column], Column] = line_ball) -> DataFrame:
    """A document per key, its balls the key's lines, which are dealt in so many parts; every eleventh has no innings."""
    joined = keys.repartition(deal, "k").join(sixes, "k", "left")
    k = F.col("k")
    return joined.select("k", *document(k, F.when(has_innings(k), nested_innings(k, F.col("sixes"), ball))))


def order_documents(spark: SparkSession, folder: str) -> DataFrame:
    """A document per order. An order has few lines, so that no nested value is large."""
    keys = table(spark, folder, "orders").select(F.col("o_orderkey").alias("k"))
    lines, deal = table(spark, folder, "lineitem").withColumn("k", F.col("l_orderkey")), parts(spark, folder)
    return nested_documents(keys, gathered_lines(dealt_by_key(lines, deal)), deal).drop("k")


def period_orders(spark: SparkSession, folder: str, days: int) -> DataFrame:
    """Orders with the number of their period of so many days as ``k``."""
    day = F.date_diff(F.col("o_orderdate").cast("date"), F.lit("1992-01-01").cast("date"))
    return table(spark, folder, "orders").select("o_orderkey", F.floor(day / days).cast("bigint").alias("k"))


def period_lines(spark: SparkSession, folder: str, days: int = 1) -> DataFrame:
    """The lines dealt by the period of their order."""
    deal, orders = parts(spark, folder), period_orders(spark, folder, days)
    lines = table(spark, folder, "lineitem").repartition(deal, "l_orderkey")
    joined = lines.join(orders.repartition(deal, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return dealt_by_key(joined, deal)


def period_documents(spark: SparkSession, folder: str, days: int = 1, lines: DataFrame | None = None) -> DataFrame:
    """A document per period of so many days of orders, with the period's number as ``k``; of ``lines``, dealt by it, where they are stored.

    There are some 2,400 days, and a day has about as many lines as a match has balls at 600,000 lines.
    """
    keys = period_orders(spark, folder, days).select("k").distinct()
    dealt = period_lines(spark, folder, days) if lines is None else lines
    return nested_documents(keys, gathered_lines(dealt), parts(spark, folder))


# The line that stands for the balls of an over in a document's indented text, with the over's place.
BALLS_MARK = r'\n +"batter" : "#(\d+:-?\d+)"\n'
BALL_INDENT = " " * 6
BALL_ORDER = ("side", "over", "step", *LINE_FIELDS)


def ball_text(line: Column) -> Column:
    """The fields of a ball as lines of its document's text; a ball always has runs."""
    alone = F.to_json(line_ball(line), {"pretty": "true"})
    fields = F.substring(F.replace(alone, F.lit("\n}")), 3, 1 << 30)  # only the last line has a bracket at its start; the text is made once
    return F.concat(F.lit(BALL_INDENT), F.replace(fields, F.lit("\n"), F.lit("\n" + BALL_INDENT)))


def period_texts(
    spark: SparkSession, folder: str, days: int, lines: DataFrame, where: str = "true", change: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """k, n, value, last: the indented texts of the period's documents, a ball or what stands between the balls of two overs at a time.

    The rows of a key, joined by line ends in the order of ``n``, are its document's text; they lie in one
    partition, in that order. So a document may be larger than what a task can hold. ``where`` picks keys, and ``change`` alters
    documents, but for their balls.
    """
    keys = period_orders(spark, folder, days).select("k").distinct().where(where)
    lines = lines.where(where).withColumns({c: place for c, place in zip(("side", "over"), line_place())})
    places = F.transform(F.sort_array(F.collect_set(F.struct("side", "over"))), lambda x: F.struct(x["side"], x["over"], F.array(x).alias("lines")))
    mark = lambda place: F.struct(F.concat(F.lit("#"), text(place["side"]), F.lit(":"), text(place["over"])).alias("batter"))
    without_balls = nested_documents(keys, lines.groupBy("k").agg(places.alias("sixes")), parts(spark, folder), mark)
    without_balls = change(without_balls) if change else without_balls
    whole = without_balls.select("k", F.to_json(F.struct("info", "innings"), {"pretty": "true"}).alias("whole"))
    cut = whole.select("k", F.split("whole", BALLS_MARK, -1).alias("between"), F.regexp_extract_all("whole", F.lit(BALLS_MARK)).alias("marks"))
    cut = cut.select("k", F.size("marks").alias("overs"), "marks", F.posexplode("between").alias("at", "between"))
    after = F.split(F.get("marks", F.col("at") - 1), ":")
    between = cut.select(
        "k",
        F.coalesce(after[0].cast("int"), F.lit(0)).alias("side"),
        after[1].cast("bigint").alias("over"),
        F.lit(2).alias("step"),
        "between",
        (F.col("at") == F.col("overs")).alias("last"),
    )
    k = F.col("k")
    balls = lines.where(has_innings(k) & has_overs(k, F.col("side")) & has_balls(k, F.col("over"))).select(
        "k", "side", "over", F.lit(1).alias("step"), *LINE_FIELDS, F.lit(False).alias("last")
    )
    pieces = balls.unionByName(between, allowMissingColumns=True)
    ordered = Window.partitionBy("k").orderBy(*BALL_ORDER)
    numbered = pieces.withColumns({"n": F.row_number().over(ordered), "before": F.lag("step").over(ordered)})
    parted = F.when(F.col("before") == 1, F.lit(BALL_INDENT + "}, {\n")).otherwise("")
    value = F.when(F.col("step") == 1, F.concat(parted, ball_text(F.struct(*LINE_FIELDS)))).otherwise(F.col("between"))
    return numbered.sortWithinPartitions("k", *BALL_ORDER).select("k", "n", value.alias("value"), "last")


def changed_documents(documents: DataFrame, shift: int = 5000) -> DataFrame:
    """The same matches after a correction of their heads, which are those of a later key."""
    return documents.withColumn("info", document_head(F.col("k") + shift))
