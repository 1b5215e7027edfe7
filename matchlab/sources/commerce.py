"""Order tables read as match tables, so that every operator has whole tables of any size to run on.

An order is a match; its odd lines are the home side, its even lines the away side. A part is a player,
its type the position. A side's team is the nation of its smallest supplier key. Matches need both
sides and two different teams. The measures of a side and of a player come from the line columns.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchlab.functions.fixed_values import PLAYER_STATS, TEAM_STATS

# part type -> position
POSITION_OF_TYPE = {
    "SMALL": "Wing",
    "MEDIUM": "Centre",
    "LARGE": "Prop",
    "ECONOMY": "Hooker",
    "STANDARD": "Lock",
    "PROMO": "Interchange",
}

# team statistic -> SQL over the lines of one side; q, d, t are whole numbers, e is a price
TEAM_STAT_SQL = {
    "score": "sum(q)",
    "completion_rate_percentage": "sum(t) * 100.0 / sum(q)",
    "possession_percentage": "sum(t)",
    "time_in_own_half": "sum(d)",
    "time_in_opp_half": "count(q)",
    "time_in_own20": "max(q)",
    "time_in_opp20": "min(q)",
    "set_restarts": "max(n)",
    "goal_line_dropouts": "sum(e) / 1000",
}

# player statistic -> SQL over one line
PLAYER_STAT_SQL = {
    "points": "q",
    "tries": "q % 5",
    "conversion_attempts": "t",
    "conversions": "least(t, d)",
    "penalty_goal_attempts": "d",
    "penalty_goals": "least(d, n)",
    "try_assists": "q % 3",
    "line_break_assists": "q % 4",
    "passes": "q + d",
    "kick_metres": "e / 100",
    "kicks_general_play": "t % 4",
    "possessions": "q - 1",
    "runs": "d",
    "runs_hitup": "d % 3",
    "runs_normal": "d - d % 3",
    "run_metres": "e / 50",
    "runs_hitup_metres": "e / 150",
    "runs_normal_metres": "e / 75",
    "post_contact_metres": "e / 200",
    "offloads": "t % 3",
    "line_breaks": "d % 4",
    "tackle_breaks": "t",
    "tackleds": "q % 7",
    "tackles": "t * 3",
    "tackles_ineffective": "t % 5",
    "missed_tackles": "d % 5",
    "try_saves": "t % 2",
    "handling_errors": "d % 2",
    "errors": "q % 2",
    "penalties_conceded": "n % 3",
}



# declared, so that reading a table starts no job for its footers
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def row_bound(spark: SparkSession, sf_dir: str, name: str = "lineitem") -> int:
    """Row count from the parquet footers: an upper bound for every group derived from the table."""
    return table(spark, sf_dir, name).count()


def player_bound(spark: SparkSession, sf_dir: str) -> int:
    """Most lines of one part: an upper bound of a player's rows, from one narrow column."""
    return table(spark, sf_dir, "lineitem").groupBy("l_partkey").count().agg(F.max("count")).first()[0] or 0


def group_bound(teams: DataFrame) -> int:
    """An upper bound of the groups (competition, round, position) of players: a position is one of the types or missing."""
    return teams.select("competition_id", "round").distinct().count() * (len(POSITION_OF_TYPE) + 1)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "IF(l_linenumber % 2 = 1, 'home', 'away') AS team_location",
        "CAST(l_quantity AS INT) AS q",
        "CAST(round(l_discount * 100) AS INT) AS d",
        "CAST(round(l_tax * 100) AS INT) AS t",
        "l_linenumber AS n",
        "l_extendedprice AS e",
    )


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("match_id"),
        day.alias("date"),
        F.year(day).alias("season"),
        F.month(day).alias("round"),
    )


def team_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rows per match.

    Lines are aggregated once per order, both sides in the same row and on primitive columns (hash
    aggregation, partial per map task); that exchange on the order key also serves the orders join.
    """
    aggs = []
    for s in ("home", "away"):
        aggs.append(f"min(l_suppkey) FILTER (WHERE team_location = '{s}') AS {s}_supp")
        for stat, sql in TEAM_STAT_SQL.items():
            at_side = re.sub(r"(\w+\(\w\))", rf"\1 FILTER (WHERE team_location = '{s}')", sql)
            aggs.append(f"CAST({at_side} AS DOUBLE) AS {s}_{stat}")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    wide = (
        _lines(spark, sf_dir)
        .groupBy(F.col("l_orderkey").alias("match_id"))
        .agg(*[F.expr(a) for a in aggs])
        .filter("home_supp IS NOT NULL AND away_supp IS NOT NULL")
        .join(_orders(spark, sf_dir), "match_id")
        .join(supplier.toDF("home_supp", "home_nation"), "home_supp")
        .join(supplier.toDF("away_supp", "away_nation"), "away_supp")
        .filter("home_nation <> away_nation")
    )
    sides = [
        f"named_struct('team_location', '{s}', 'n_nationkey', {s}_nation, "
        + ", ".join(f"'{c}', {s}_{c}" for c in TEAM_STATS)
        + ")"
        for s in ("home", "away")
    ]
    ids = ["match_id", "season", "round", "date"]
    long = wide.selectExpr(*ids, f"inline(array({', '.join(sides)}))").join(_nations(spark, sf_dir), "n_nationkey")
    return long.selectExpr(
        "CAST(season AS BIGINT) AS competition_id", *ids, "team_location", "team_name", *TEAM_STATS
    )


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation key -> full team name ("<region> <nation>")."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    joined = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select("n_nationkey", F.concat_ws(" ", "r_name", "n_name").alias("team_name"))


def player_match(spark: SparkSession, sf_dir: str, teams: DataFrame | None = None) -> DataFrame:
    """One row per line of a kept match, with the 30 player statistics."""
    teams = team_match(spark, sf_dir) if teams is None else teams
    position = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in POSITION_OF_TYPE.items())
    part = table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS l_partkey",
        "split(p_name, ' ')[0] AS firstname",
        "split(p_name, ' ')[1] AS surname",
        f"CASE p_type {position} END AS position",
    )
    lines = _lines(spark, sf_dir).drop("team_location")
    of_match = teams.select("match_id", "team_location", "team_name", "date", "season", "round", "competition_id")
    # the side follows from the line's number, so the lines travel without it
    side = F.when(lines["n"] % 2 == 1, "home").otherwise("away")
    on = (lines["l_orderkey"] == of_match["match_id"]) & (side == of_match["team_location"])
    rows = lines.join(of_match, on).join(part, "l_partkey")
    return rows.selectExpr(
        "l_partkey AS player_id",
        "firstname",
        "surname",
        "team_name",
        "l_suppkey AS squad_id",
        "position",
        "n AS jumper_number",
        "date",
        "match_id",
        "competition_id",
        "season",
        "round",
        "team_location",
        *[f"CAST({PLAYER_STAT_SQL[c]} AS DOUBLE) AS {c}" for c in PLAYER_STATS],
        "e AS price",
    )


# total order of a player's rows
PLAYER_ORDER = ["date", "match_id", "jumper_number", "squad_id", "points", "price"]


def player_order() -> list:
    return [F.col(c) for c in PLAYER_ORDER]


def ladder(teams: DataFrame) -> DataFrame:
    """League table per (season, round): running points (2 win, 1 draw), for, against, difference.

    Rows are first summed per (team, season, round); the running window then sees at most twelve rows.
    """
    wide = teams.groupBy("match_id", "season", "round").agg(
        *[
            F.max(F.when(F.col("team_location") == s, F.struct("team_name", "score"))).alias(s)
            for s in ("home", "away")
        ]
    )

    def view(me: str, other: str):
        mine, theirs = F.col(f"{me}.score"), F.col(f"{other}.score")
        return F.struct(
            F.regexp_extract(f"{me}.team_name", r"(\w+)$", 1).alias("team"),
            F.when(mine > theirs, 2.0).when(mine == theirs, 1.0).otherwise(0.0).alias("p"),
            mine.alias("f"),
            theirs.alias("a"),
        )

    rows = wide.select(
        "season", "round", F.explode(F.array(view("home", "away"), view("away", "home"))).alias("v")
    ).select("season", "round", "v.*")
    monthly = rows.groupBy("team", "season", "round").agg(
        F.sum("p").alias("p"), F.sum("f").alias("f"), F.sum("a").alias("a")
    )
    w = Window.partitionBy("team", "season").orderBy("round")
    return monthly.select(
        "team",
        F.sum("p").over(w).alias("ladder_points"),
        F.sum("f").over(w).alias("points_for"),
        F.sum("a").over(w).alias("points_against"),
        (F.sum("f").over(w) - F.sum("a").over(w)).alias("points_diff"),
        "season",
        "round",
    )


def events_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long single-key histories with gaps: the value of an error event counts as missing."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("player_id"),
        "event_id",
        "ts",
        "event_type",
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
    )


def odds(teams: DataFrame) -> DataFrame:
    """Closing odds of both sides from the scores: 1 + other / own."""
    wide = teams.groupBy("match_id").agg(
        *[F.max(F.when(F.col("team_location") == s, F.col("score"))).alias(f"{s}_score") for s in ("home", "away")]
    )
    return wide.select(
        "match_id",
        (1 + F.try_divide("away_score", "home_score")).alias("home_odds_close"),
        (1 + F.try_divide("home_score", "away_score")).alias("away_odds_close"),
        "home_score",
        "away_score",
    )
