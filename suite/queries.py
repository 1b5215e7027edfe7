"""Registered queries: each runs one operator (or one plan) over the whole order tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlab.functions.columns import result_code, week_floor
from matchlab.functions.fixed_values import LADDER_COLUMNS, PLAYER_FEATURES, ROLE_ALIASES, TEAM_STATS, UNUSED_ROLE
from matchlab.operators import form, frame, metrics, model, names, preprocess, ratings, resample, teams
from matchlab.operators.keyed import first_per_key, player_key
from matchlab.operators.ordered import carried_ewma, lagged_ewma
from matchlab.plans.carried import carried_rest
from matchlab.plans.features import training_frame
from matchlab.plans.load import load, stored_schema
from matchlab.plans.weekly import Week, week_frame
from matchlab.session import cut, ensure_checkpoint_dir
from matchlab.sources import commerce as C
from matchlab.sources import versions as V
from matchlab.sources.tables import (
    append_log,
    collect_extracts,
    log_experiment,
    played_rounds,
    read_table,
    select_competitions,
    upsert,
    upsert_table,
    write_table,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

LINE_IDS = ["player_id", "match_id", "jumper_number", "squad_id", "points", "price"]


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def q(col: Column | str, digits: int = 6) -> Column:
    """Value on a decimal grid; the offset keeps decimal ties away from the cell edges."""
    col = F.col(col) if isinstance(col, str) else col
    return F.floor(col * float(10**digits) + 0.31831) / F.lit(float(10**digits))


def on_grid(cols, digits=6):
    unit = f"1e{digits}D"
    return [F.expr(f"floor(`{c}` * {unit} + 0.31831D) / {unit} AS `{c}`") for c in cols]


def matches(tm: DataFrame) -> DataFrame:
    return teams.pair_matches(tm, keys=["match_id", "season", "round", "date"])


# ---------------------------------------------------------------- team rows


def _rest(spark, sf, **scale):
    out = teams.rest_days(C.team_match(spark, sf), **scale)
    return out.select("match_id", "team_name", "competition_id", "date", "days_rest")


@query
def rest_days(spark, sf):
    return _rest(spark, sf, rows_bound=C.row_bound(spark, sf))


@query
def rest_days_hot_keys(spark, sf):
    """Same rows with every larger team treated as a hot key."""
    return _rest(spark, sf, hot_rows=100)


@query
def first_per_key_(spark, sf):
    pm = C.player_match(spark, sf)
    return first_per_key(pm, ["player_id"], C.player_order()).select(
        "player_id", "match_id", "date", "team_name", "jumper_number", "points"
    )


QUERIES["first_per_key"] = QUERIES.pop("first_per_key_")


@query
def ladder_position(spark, sf):
    return teams.ladder_position(C.ladder(C.team_match(spark, sf)), rows_bound=C.row_bound(spark, sf))


@query
def ladder_position_hot_keys(spark, sf):
    return teams.ladder_position(C.ladder(C.team_match(spark, sf)), hot_rows=10)


def _ladder_lag(spark, sf, **scale):
    tm = cut(C.team_match(spark, sf))
    table = teams.ladder_position(C.ladder(tm), **scale)
    return teams.attach_prior_ladder(tm, table).select("match_id", "team_name", *LADDER_COLUMNS)


@query
def ladder_join_lag(spark, sf):
    return _ladder_lag(spark, sf, rows_bound=C.row_bound(spark, sf))


@query
def ladder_lag_hot_keys(spark, sf):
    return _ladder_lag(spark, sf, hot_rows=10)


@query
def pair_matches(spark, sf):
    return teams.pair_matches(C.team_match(spark, sf))


@query
def result_code_(spark, sf):
    home, away = F.col("score_home"), F.col("score_away")
    return matches(C.team_match(spark, sf)).select(
        "match_id", *[result_code(home, away, s).alias(s) for s in ("elo", "label", "odds")]
    )


QUERIES["result_code"] = QUERIES.pop("result_code_")


@query
def unpivot_sides(spark, sf):
    wide = teams.pair_matches(C.team_match(spark, sf), keys=["match_id", "date"])
    return teams.unpivot_sides(wide, ["team", "score"])


def _team_form(spark, sf, **scale):
    out = form.team_form(C.team_match(spark, sf), **scale)
    return out.select("match_id", "team_name", *on_grid(TEAM_STATS, 4))


@query
def ewma_team_lagged(spark, sf):
    return _team_form(spark, sf, rows_bound=C.row_bound(spark, sf))


@query
def ewma_team_hot_keys(spark, sf):
    return _team_form(spark, sf, hot_rows=100)


# ---------------------------------------------------------------- player rows


def _event_form(spark, sf, nulls, **scale):
    rows = C.events_history(spark, sf)
    order = [F.col("ts"), F.col("event_id")]
    out = lagged_ewma(rows, ["player_id"], order, ["value"], nulls=nulls, **scale)
    return out.select("player_id", "event_id", q("value", 5).alias("form"))


@query
def ewma_player_poison(spark, sf):
    return _event_form(spark, sf, "poison", rows_bound=C.row_bound(spark, sf, "events"))


@query
def ewma_player_skip(spark, sf):
    return _event_form(spark, sf, "skip", rows_bound=C.row_bound(spark, sf, "events"))


def _stats_skip(spark, sf, **scale):
    """All statistics at once, zeros read as missing."""
    tm = C.team_match(spark, sf)
    rows = tm.select("match_id", "team_name", "date", *[F.nullif(F.col(c) % 3, F.lit(0.0)).alias(c) for c in TEAM_STATS])
    out = lagged_ewma(rows, ["team_name"], [F.col("date"), F.col("match_id")], TEAM_STATS, nulls="skip", **scale)
    return out.select("match_id", "team_name", *on_grid(TEAM_STATS, 4))


@query
def ewma_stats_skip(spark, sf):
    return _stats_skip(spark, sf, rows_bound=C.row_bound(spark, sf))


@query
def ewma_stats_skip_hot_keys(spark, sf):
    return _stats_skip(spark, sf, hot_rows=100)


@query
def ewma_poison_hot_keys(spark, sf):
    return _event_form(spark, sf, "poison", hot_rows=60)


@query
def ewma_skip_hot_keys(spark, sf):
    return _event_form(spark, sf, "skip", hot_rows=60)


def _rates(spark, sf):
    keep = [c for c in C.PLAYER_ORDER if c not in ("date", "match_id", "jumper_number", "squad_id")]
    return form.player_rates(C.player_match(spark, sf), keep=keep)


@query
def player_rates(spark, sf):
    return _rates(spark, sf).select(*LINE_IDS, "name", *on_grid(PLAYER_FEATURES, 5))


@query
def ewma_player_rates(spark, sf):
    bound = C.player_bound(spark, sf)
    out = lagged_ewma(_rates(spark, sf), ["player_id"], C.player_order(), PLAYER_FEATURES, rows_bound=bound)
    return out.select(*LINE_IDS, "name", *on_grid(PLAYER_FEATURES, 4))


@query
def group_scale(spark, sf):
    by = ["competition_id", "round", "position"]
    rows = _rates(spark, sf).select(*LINE_IDS, *by, *PLAYER_FEATURES)  # they are stored
    out = form.group_scale(rows, by, PLAYER_FEATURES)
    return out.select(*LINE_IDS, *on_grid(PLAYER_FEATURES, 5))


@query
def team_rollup(spark, sf):
    out = frame.team_rollup(_rates(spark, sf))
    ids = [c for c in out.columns if c not in PLAYER_FEATURES]
    return out.select(*ids, *on_grid(PLAYER_FEATURES, 5))


# ---------------------------------------------------------------- the model frame


def build_frame(spark: SparkSession, sf: str) -> DataFrame:
    bound = C.row_bound(spark, sf)
    tm = cut(C.team_match(spark, sf))
    pm = C.player_match(spark, sf, tm)
    ladder = teams.ladder_position(C.ladder(tm), rows_bound=bound)
    bounds = {"match_bound": C.row_bound(spark, sf, "orders"), "player_bound": C.player_bound(spark, sf), "groups_bound": C.group_bound(tm)}
    return training_frame(tm, pm, ladder, C.PLAYER_ORDER, rows_bound=bound, **bounds)


@query
def model_frame(spark, sf):
    out = build_frame(spark, sf)
    diffs = [c for c in out.columns if c.endswith("_diff")]
    probs = [c for c in out.columns if c.endswith("prhome")]
    ids = [c for c in out.columns if c not in diffs + probs]
    return out.select(*ids, *on_grid(diffs, 3), *on_grid(probs, 6))


# ---------------------------------------------------------------- ratings


def _elo_matches(spark, sf):
    return teams.with_result(matches(C.team_match(spark, sf)), "elo")


def _elo(spark, sf, **kw):
    out = ratings.elo(_elo_matches(spark, sf), [22.0], **kw)
    return out.select(
        "match_id",
        *[q(F.col(c)[0], d).alias(c) for c, d in (("elo_home", 4), ("elo_away", 4), ("pr_home", 6))],
    )


@query
def elo_ratings(spark, sf):
    return _elo(spark, sf, rows_bound=C.row_bound(spark, sf, "orders"))


@query
def elo_time_blocks(spark, sf):
    """Same ratings from about eight blocks of matches rated side by side."""
    return _elo(spark, sf, block_rows=max(500, C.row_bound(spark, sf, "orders") // 8))


@query
def elo_variants(spark, sf):
    out = ratings.elo_variants(_elo_matches(spark, sf), rows_bound=C.row_bound(spark, sf, "orders"))
    return out.select("match_id", *[q(c, 6 if c.endswith("pr_home") else 4).alias(c) for c in out.columns[1:]])


def _grid(spark, sf):
    return ratings.elo_grid(_elo_matches(spark, sf), rows_bound=C.row_bound(spark, sf, "orders"))


@query
def elo_grid_logloss(spark, sf):
    return _grid(spark, sf).select(F.col("k").cast("double").alias("k"), "n", q("logloss", 8).alias("logloss"))


@query
def elo_best_k(spark, sf):
    return ratings.best_k(_grid(spark, sf)).select("k", q("logloss", 8).alias("logloss"))


@query
def elo_by_pool(spark, sf):
    """A rating pool of its own per season."""
    bound = C.row_bound(spark, sf, "orders")
    out = ratings.elo(_elo_matches(spark, sf), [22.0], pool=["season"], rows_bound=bound, arrays=False)
    return out.select("match_id", *[q(f"{c}_0", d).alias(c) for c, d in (("elo_home", 4), ("elo_away", 4), ("pr_home", 6))])


# ---------------------------------------------------------------- bulk load


def _landed(spark, sf) -> str:
    """Matches and league tables as CSV folders by season and round; odd rounds have their columns in reverse order."""
    path = _scratch(spark)
    tm = cut(C.team_match(spark, sf))
    tables = {"team_match": tm.withColumnRenamed("date", "utc_start"), "ladder": C.ladder(tm)}
    for name, df in tables.items():
        own = [c for c in stored_schema(name).names if c not in ("season", "round", "ladder_position")]
        for odd, cols in ((0, own), (1, own[::-1])):
            part = df.filter(F.col("round") % 2 == odd).select(*cols, "season", "round").repartition("season", "round")
            part.write.mode("append").partitionBy("season", "round").option("header", True).option("nullValue", "NA").csv(f"{path}/landed/{name}")
    for _ in range(2):  # the second call finds all files in its ledger
        load(spark, f"{path}/landed", path)
    return path


@query
def bulk_load(spark, sf):
    tm = V.read(spark, f"{_landed(spark, sf)}/tables/team_match", stored_schema("team_match"))
    return tm.select("match_id", "team_name", "season", "round", F.col("utc_start").alias("date"), "score")


@query
def bulk_load_ladder(spark, sf):
    return V.read(spark, f"{_landed(spark, sf)}/tables/ladder", stored_schema("ladder"))


# ---------------------------------------------------------------- continued from a stored state

_STOPS = [dt.date(1997, 1, 1), dt.date(2000, 2, 3)]


def _continued(rows: DataFrame, step: Callable) -> DataFrame:
    """Union of three spans of time, each continued from the state that the one before left; ``step`` gives (rows, state)."""
    rows = cut(rows)  # every span reads them
    edges, state, out = [None, *_STOPS, None], None, None
    for low, high in zip(edges, edges[1:]):
        part = rows if low is None else rows.filter(F.col("date") >= F.lit(low))
        part = part if high is None else part.filter(F.col("date") < F.lit(high))
        done, state = step(part, state)
        state = cut(state)
        out = done if out is None else out.unionByName(done)
    return out


@query
def carried_ratings(spark, sf):
    bound = C.row_bound(spark, sf, "orders")

    def step(part, state):
        part, kw = cut(part), {"rows_bound": bound, "state": state}
        return ratings.elo(part, [22.0], **kw), ratings.closing_ratings(part, [22.0], **kw)

    out = _continued(_elo_matches(spark, sf), step)
    return out.select("match_id", *[q(F.col(c)[0], d).alias(c) for c, d in (("elo_home", 4), ("elo_away", 4), ("pr_home", 6))])


@query
def carried_form(spark, sf):
    bound = C.row_bound(spark, sf)
    step = lambda part, state: carried_ewma(part, state, ["team_name"], ["date", "match_id"], TEAM_STATS, rows_bound=bound)
    return _continued(C.team_match(spark, sf), step).select("match_id", "team_name", *on_grid(TEAM_STATS, 4))


@query
def carried_rest_days(spark, sf):
    bound = C.row_bound(spark, sf)
    out = _continued(C.team_match(spark, sf), lambda part, last: carried_rest(part, last, rows_bound=bound + 1))
    return out.select("match_id", "team_name", "competition_id", "date", "days_rest")


# ---------------------------------------------------------------- names and fixtures


@query
def map_values_(spark, sf):
    """Fixed mapping for the part types, an alias table for the nations of the suppliers."""
    nation, region = C.table(spark, sf, "nation"), C.table(spark, sf, "region")
    aliases = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("value"), F.col("r_name").alias("mapped")
    ).filter("mapped <> 'ASIA'")
    rows = (
        C.table(spark, sf, "lineitem")
        .join(C.table(spark, sf, "part"), F.col("p_partkey") == F.col("l_partkey"))
        .join(C.table(spark, sf, "supplier"), F.col("s_suppkey") == F.col("l_suppkey"))
        .join(nation, F.col("n_nationkey") == F.col("s_nationkey"))
        .groupBy(F.col("p_type").alias("position"), F.col("n_name").alias("team"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = {k: v for k, v in C.POSITION_OF_TYPE.items() if k != "PROMO"}
    out = names.map_values(names.map_values(rows, "position", known), "team", aliases)
    return out.groupBy("position", "team").agg(F.sum("n").alias("n"))


QUERIES["map_values"] = QUERIES.pop("map_values_")


@query
def canonical_team(spark, sf):
    tm = C.team_match(spark, sf)
    counts = tm.groupBy("team_name").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("team_name", names.canonical_team(F.col("team_name")).alias("team"), "n")


@query
def player_key_(spark, sf):
    return player_key(C.player_match(spark, sf), C.player_order())


QUERIES["player_key"] = QUERIES.pop("player_key_")


def _name_parts(col: str):
    return [F.split(col, " ").getItem(i) for i in (0, 1)]


def _name_key(spark, sf):
    first, last = _name_parts("p_name")
    by_name = C.table(spark, sf, "part").groupBy("p_name").agg(F.min("p_partkey").alias("player_id"))
    return by_name.select("player_id", first.alias("firstname"), last.alias("surname"))


@query
def fuzzy_left_join(spark, sf):
    first, last = _name_parts("p_name")
    written = C.table(spark, sf, "part").select(
        "p_partkey",
        F.concat(first, F.lower(F.substring("p_type", 1, 1))).alias("firstname"),
        F.concat(last, F.when(F.col("p_size") % 2 == 0, "s").otherwise("")).alias("surname"),
    )
    out = names.fuzzy_left_join(written, _name_key(spark, sf), ["surname", "firstname"])
    dist = ["firstname_distance", "surname_distance"]
    return out.select(*[c for c in out.columns if c not in dist], *on_grid(dist, 6))


@query
def fuzzy_vocabulary(spark, sf):
    """All different words of the texts against themselves: 10^5 and more."""
    texts = spark.read.parquet(f"{sf}/documents.parquet")
    words = texts.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]+)"))).alias("word")).distinct()
    pairs = names.similar_values(words, words, 0.05)
    return pairs.filter(F.col("value") < F.col("value_right")).select("value", "value_right", *on_grid(["distance"], 6))


@query
def lineup_resolution(spark, sf):
    wing, second_row = ROLE_ALIASES
    first, last = _name_parts("p_name")
    nation, region = C.table(spark, sf, "nation"), C.table(spark, sf, "region")
    role = (
        F.when(F.col("p_type") == "SMALL", wing)
        .when(F.col("p_type") == "LARGE", second_row)
        .when(F.col("p_type") == "PROMO", UNUSED_ROLE)
        .otherwise("Prop")
    )
    suppliers = C.row_bound(spark, sf, "supplier")
    raw = (
        C.table(spark, sf, "supplier")
        .join(C.table(spark, sf, "part"), F.col("p_partkey") % suppliers + 1 == F.col("s_suppkey"))
        .join(nation, F.col("n_nationkey") == F.col("s_nationkey"))
        .select(
            first.alias("firstname"),
            F.concat(last, F.when(F.col("s_nationkey") % 3 == 0, "s").otherwise("")).alias("surname"),
            role.alias("position"),
            F.col("n_name").alias("team"),
        )
    )
    games = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.concat_ws(" ", "r_name", "n_name").alias("team_name"),
        F.col("n_nationkey").cast("long").alias("match_id"),
        F.lit(1).alias("round"),
        F.lit("home").alias("team_location"),
        F.current_date().alias("date"),
    )
    out = names.resolve_lineup(raw, _name_key(spark, sf), games)
    return out.select("player_id", "firstname", "surname", "team", "position", "team_name", "match_id")


FIXTURE_SLOTS = 100_000_000


def _results(spark, sf):
    return matches(C.team_match(spark, sf)).select(
        "season",
        "round",
        "date",
        F.col("team_home").alias("home_team"),
        F.col("team_away").alias("away_team"),
        "score_home",
    )


def _fixture_ids(spark, sf, **scale):
    # a round of these tables is a month with more than a hundred matches
    return teams.build_fixtures(_results(spark, sf), competition=F.col("season"), slots=FIXTURE_SLOTS, **scale)


@query
def fixture_ids(spark, sf):
    return _fixture_ids(spark, sf, rows_bound=C.row_bound(spark, sf))


@query
def fixture_ids_hot_keys(spark, sf):
    return _fixture_ids(spark, sf, hot_rows=100)


# ---------------------------------------------------------------- splits and metrics


@query
def week_floor_split(spark, sf):
    games = matches(C.team_match(spark, sf)).select("match_id", "date")
    cutoff = games.agg(week_floor(F.max("date")).alias("c")).first()["c"]
    train, coming = resample.time_split(games.withColumn("week", week_floor(F.col("date"))), F.lit(cutoff))
    return train.withColumn("role", F.lit("train")).unionByName(coming.withColumn("role", F.lit("predict")))


@query
def rolling_origin_folds(spark, sf):
    return resample.rolling_origin(matches(C.team_match(spark, sf)))


@query
def metrics_logloss_acc_f1(spark, sf):
    poss = {"possession_percentage": "poss", "score": "score"}
    wide = teams.pair_matches(C.team_match(spark, sf), poss, ["match_id", "season"])
    scored = wide.select(
        "season",
        ((F.col("poss_home") + 1) / (F.col("poss_home") + F.col("poss_away") + 2)).alias("pred_h"),
        result_code(F.col("score_home"), F.col("score_away"), "label").alias("result"),
    )
    out = metrics.forecast_metrics(scored, by=["season"])
    return out.select("season", *on_grid(["logloss", "accuracy", "f_meas"], 8), "n")


@query
def tuning_metrics(spark, sf):
    """Out-of-fold metrics per configuration: rounds as configurations, seasons as folds."""
    poss = {"possession_percentage": "poss", "score": "score"}
    wide = teams.pair_matches(C.team_match(spark, sf), poss, ["match_id", "season", "round"])
    predictions = wide.select(
        F.col("round").alias("config_id"),
        F.col("season").alias("fold"),
        ((F.col("poss_home") + 1) / (F.col("poss_home") + F.col("poss_away") + 2)).alias("pred_h"),
        result_code(F.col("score_home"), F.col("score_away"), "label").alias("result"),
    )
    out = model.collect_metrics(predictions)
    return out.select("config_id", "metric", *on_grid(["mean"], 8), *on_grid(["std_err"], 8), "n")


@query
def odds_devig_logloss(spark, sf):
    out = metrics.odds_logloss(C.odds(C.team_match(spark, sf)))
    return out.select(q("logloss", 8).alias("logloss"), "n")


# ---------------------------------------------------------------- ingestion


@query
def upsert_idempotent(spark, sf):
    hist = C.team_match(spark, sf).select("match_id", "team_name", "season", "round", "date", "score")
    fixed = hist.filter(F.col("round") == 12).withColumn("score", F.col("score") + 1)
    once = upsert(hist, fixed, ["match_id", "team_name"])
    return upsert(once, fixed, ["match_id", "team_name"])


def _scratch(spark: SparkSession) -> str:
    """New folder next to the checkpoints, on storage every executor reaches."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"


_STORED = ["match_id", "team_name", "season", "round", "date", "score"]
_STORED_SCHEMA = "match_id bigint, team_name string, season int, round int, date date, score double"


@query
def csv_round_trip(spark, sf):
    """Written as CSV, appended to, and read back with the declared schema."""
    path = _scratch(spark)
    tm = C.team_match(spark, sf).select(*_STORED)
    write_table(tm, path, "csv")
    append_log(tm.withColumn("round", F.col("round") + 100), path, "csv")
    return read_table(spark, T.StructType.fromDDL(_STORED_SCHEMA), path, "csv")


@query
def upsert_table_(spark, sf):
    """Stored history, one corrected round upserted twice into its season partitions."""
    path, schema = _scratch(spark), T.StructType.fromDDL(_STORED_SCHEMA)
    tm = C.team_match(spark, sf).select(*_STORED)
    fixed = tm.filter(F.col("round") == 12).withColumn("score", F.col("score") + 1)
    for extract in (tm, fixed, fixed):
        upsert_table(spark, path, schema, extract, ["match_id", "team_name"])
    return spark.read.schema(schema).parquet(path).select(*_STORED)


QUERIES["upsert_table"] = QUERIES.pop("upsert_table_")


def _versioned(spark, sf) -> tuple[str, T.StructType]:
    """Four extracts: every key twice in one, the correction last; round 12 corrected; an older extract late; the correction once more."""
    path, schema = f"{_scratch(spark)}/t", T.StructType.fromDDL(_STORED_SCHEMA)
    tm = cut(C.team_match(spark, sf).select(*_STORED))  # the extracts read it five times
    raw = tm.withColumns({"score": F.col("score") - 5, "place": F.lit(1)}).unionByName(tm.withColumn("place", F.lit(2)))
    fixed = tm.filter(F.col("round") == 12).withColumn("score", F.col("score") + 1)
    extracts = [
        V.with_source(raw, F.lit("2024-01-02"), "raw", F.col("place")).drop("place"),
        V.with_source(fixed, F.lit("2024-01-03"), "fixed"),
        V.with_source(tm.withColumn("score", F.lit(-1.0)), F.lit("2024-01-01"), "late"),
        V.with_source(fixed, F.lit("2024-01-03"), "fixed"),
    ]
    for extract in extracts:
        V.merge(spark, path, schema, extract, ["match_id", "team_name"])
    return path, schema


@query
def versioned_merge(spark, sf):
    path, schema = _versioned(spark, sf)
    return V.read(spark, path, schema).select(*_STORED)


@query
def versioned_read_back(spark, sf):
    """The version before the correction."""
    path, schema = _versioned(spark, sf)
    return V.read(spark, path, schema, version=1).select(*_STORED)


@query
def select_competitions_(spark, sf):
    """Parts read as competitions: two of the nouns, from a first size on."""
    listed = C.table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_size").alias("season")
    )
    return select_competitions(listed, ["widget", "bolt"], 16)


QUERIES["select_competitions"] = QUERIES.pop("select_competitions_")


@query
def played_rounds_(spark, sf):
    """Rounds with a score, where only home wins count as scored."""
    listed = matches(C.team_match(spark, sf)).select(
        "round", F.when(F.col("score_home") > F.col("score_away"), F.col("score_home")).alias("home_score")
    )
    return played_rounds(listed)


QUERIES["played_rounds"] = QUERIES.pop("played_rounds_")


@query
def collect_extracts_(spark, sf):
    customer = C.table(spark, sf, "customer").toDF("partyKey", "partyName", "nationKey", "acctBal", "marketSegment")
    supplier = C.table(spark, sf, "supplier").toDF("partyKey", "partyName", "nationKey", "acctBal")
    tagged = [d.withColumn("extract", F.lit(n)) for d, n in ((customer, "customer"), (supplier, "supplier"))]
    return collect_extracts(tagged, required=["party_key"])


QUERIES["collect_extracts"] = QUERIES.pop("collect_extracts_")


# ---------------------------------------------------------------- models


@query
def zero_variance_filter(spark, sf):
    tm = C.team_match(spark, sf).withColumn("constant", F.lit(7.0))
    out = model.zero_variance_report(tm, [*TEAM_STATS, "constant"])
    return out.select("predictor", *on_grid(["low"], 3), *on_grid(["high"], 3), "keep")


@query
def fitted_preprocessing(spark, sf):
    """Rules of the matches before 1998 outside Europe, applied to all: a constant goes, Europe is a level not seen, missing numbers stay."""
    rows = matches(C.team_match(spark, sf)).select(
        "match_id",
        "date",
        F.nullif(F.col("score_home") % 7, F.lit(0.0)).alias("home"),
        F.lit(7.0).alias("constant"),
        F.when(F.col("score_away") % 11 != 0, F.regexp_extract("team_away", r"^(.*) \w+$", 1)).alias("region"),
    )
    past = rows.filter((F.col("date") < F.lit("1998-01-01").cast("date")) & ~F.col("region").eqNullSafe("EUROPE"))
    path = _scratch(spark)
    write_table(preprocess.fit_rules(past, ["home", "constant"], ["region"]), path)
    rules = read_table(spark, T.StructType.fromDDL(preprocess.RULES), path)
    kept = preprocess.prepare(rows, rules, ["match_id"], training=True).select("match_id", F.lit(True).alias("trainable"))
    return preprocess.prepare(rows, rules, ["match_id"]).join(kept, "match_id", "left")


STUMP_PREDICTORS = ["round", "weekday", "away_nation"]


def _stump(spark, sf):
    """One tree of depth 1 on whole-number predictors: a model whose scores SQL can state exactly."""
    rows = cut(
        matches(C.team_match(spark, sf)).select(
            "match_id",
            "date",
            F.col("team_home").alias("home_team"),
            F.col("team_away").alias("away_team"),
            F.col("round").cast("double").alias("round"),
            F.dayofweek("date").cast("double").alias("weekday"),
            F.length("team_away").cast("double").alias("away_nation"),
            result_code(F.col("score_home"), F.col("score_away"), "label").alias("result"),
        )
    )
    pipeline = model.build_pipeline(STUMP_PREDICTORS, params={"tree_depth": 1, "learn_rate": 0.1}, trees=1)
    path = _scratch(spark)
    model.save_model(model.fit(pipeline, rows, STUMP_PREDICTORS), path)
    return model.load_model(path), rows


@query
def gbt_stump_scores(spark, sf):
    """Fit, store, load, score and pick."""
    fitted, rows = _stump(spark, sf)
    out = model.score(fitted, rows)
    return out.select("match_id", "date", "home_team", "away_team", *on_grid(["pred_a", "pred_h"], 9), "pick")


@query
def gbt_predictions(spark, sf):
    """Ten trees of depth 3 on all differences of the model frame before 2000, predictions for the matches from then on."""
    past, coming = resample.time_split(cut(build_frame(spark, sf)), F.lit("2000-01-01").cast("date"))
    fitted = model.fit(model.build_pipeline(params={"tree_depth": 3, "learn_rate": 0.1}, trees=10), past)
    out = model.score(fitted, coming)
    return out.select("match_id", "date", "home_team", "away_team", *on_grid(["pred_a", "pred_h"], 6), "pick")


@query
def gbt_stump_importance(spark, sf):
    fitted, rows = _stump(spark, sf)
    return model.importance(fitted, rows)


@query
def experiment_log(spark, sf):
    """Two runs logged with the log loss of the odds, read back without their time."""
    path = _scratch(spark)
    loss = metrics.odds_logloss(C.odds(C.team_match(spark, sf))).first()["logloss"]
    for scheme in ("closing odds", "closing odds, again"):
        log_experiment(spark, path, algorithm="devig", feature_set="odds", resample_scheme=scheme, logloss=loss)
    back = read_table(spark, "experiments_log", path, "csv").filter(F.col("timestamp").isNotNull())
    return back.select("algorithm", "feature_set", "resample_scheme", *on_grid(["logloss"], 8))


def _week(spark, sf):
    """A week before the last match: the tables as stored, the rest of that round to predict."""
    bound = C.row_bound(spark, sf)
    tm = cut(C.team_match(spark, sf))
    pm = C.player_match(spark, sf, tm)
    last = tm.agg(F.max("date")).first()[0]
    day = last - dt.timedelta(days=7)
    as_of = F.lit(day)
    cutoff = week_floor(as_of)
    coming = matches(tm).filter(F.col("date") >= cutoff)
    lineup = pm.filter(F.col("date") >= cutoff).select(
        "firstname", "surname", "position", F.col("team_name").alias("team")
    )
    week = Week(
        team_match=tm.drop("season"),
        player_match=pm,
        ladder=teams.ladder_position(C.ladder(tm), rows_bound=bound),
        player_key=_name_key(spark, sf),
        results=coming.select("season", "round", "date", F.col("team_home").alias("home_team"), F.col("team_away").alias("away_team")),
        lineup=cut(lineup.distinct()),  # the steps of its resolution read it nine times
        season=day.year,
        round=day.month,
        competition=F.col("season"),
        player_order=C.PLAYER_ORDER,
        slots=FIXTURE_SLOTS,
    )
    return week, as_of


@query
def weekly_ratings(spark, sf):
    """Coming matches of a week, with the ratings and league differences of their frame rows."""
    week, as_of = _week(spark, sf)
    bound, match_bound = C.row_bound(spark, sf), C.row_bound(spark, sf, "orders")
    groups = 2 * C.group_bound(week.team_match)  # the roles of a line-up add fewer positions than there are
    frame_rows = week_frame(week, week_floor(as_of), rows_bound=bound, match_bound=match_bound, groups_bound=groups)
    out = frame_rows.filter(F.col("date") >= week_floor(as_of))
    diffs = [f"{c}_diff" for c in LADDER_COLUMNS]
    probs = [c for c in out.columns if c.endswith("prhome")]
    return out.select("match_id", "date", "home_team", "away_team", *on_grid(diffs, 6), *on_grid(probs, 6))
