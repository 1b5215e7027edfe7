"""Oracle SQL (DuckDB) for the registered queries, composed from shared CTE texts."""

from __future__ import annotations

from matchlab.functions.fixed_values import (
    LADDER_COLUMNS,
    NAME_DISTANCE,
    PLAYER_FEATURES,
    PLAYER_STATS,
    POSITION_WEIGHTS,
    TEAM_STATS,
)
from matchlab.operators.frame import DIFF_FEATURES
from matchlab.sources.commerce import PLAYER_ORDER, PLAYER_STAT_SQL, POSITION_OF_TYPE, TEAM_STAT_SQL

LAM = "0.94::DOUBLE"


def q(expr: str, digits: int = 6) -> str:
    """Value on a decimal grid; the offset keeps decimal ties away from the cell edges."""
    return f"floor(({expr})::DOUBLE * 1e{digits}::DOUBLE + 0.31831::DOUBLE) / 1e{digits}::DOUBLE"


def case(col: str, pairs: dict, default: str = "NULL") -> str:
    whens = " ".join(f"WHEN '{k}' THEN {repr(v)}" for k, v in pairs.items())
    return f"CASE {col} {whens} ELSE {default} END"


LINES = """lines AS (
  SELECT l_orderkey, l_partkey, l_suppkey,
         CASE WHEN l_linenumber % 2 = 1 THEN 'home' ELSE 'away' END AS team_location,
         CAST(l_quantity AS INTEGER) AS q, CAST(round(l_discount * 100) AS INTEGER) AS d,
         CAST(round(l_tax * 100) AS INTEGER) AS t, l_linenumber AS n, l_extendedprice AS e
  FROM lineitem)"""

TEAM = f"""{LINES},
sides AS (
  SELECT l_orderkey AS match_id, team_location, min(l_suppkey) AS s_suppkey,
         {", ".join(f"CAST({sql} AS DOUBLE) AS {c}" for c, sql in TEAM_STAT_SQL.items())}
  FROM lines GROUP BY l_orderkey, team_location),
named AS (
  SELECT sides.*, s_nationkey, r_name || ' ' || n_name AS team_name
  FROM sides JOIN supplier USING (s_suppkey)
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
team_match AS MATERIALIZED (
  SELECT CAST(year(o_orderdate) AS BIGINT) AS competition_id, a.match_id,
         CAST(year(o_orderdate) AS INTEGER) AS season, CAST(month(o_orderdate) AS INTEGER) AS round,
         CAST(o_orderdate AS DATE) AS date, a.team_location, a.team_name, a.s_nationkey,
         {", ".join(f"a.{c}" for c in TEAM_STATS)}
  FROM named a
  JOIN named b ON a.match_id = b.match_id AND a.team_location <> b.team_location
              AND a.team_name <> b.team_name
  JOIN orders ON o_orderkey = a.match_id)"""

PLAYERS = f"""player_match AS MATERIALIZED (
  SELECT l_partkey AS player_id, split_part(p_name, ' ', 1) AS firstname,
         split_part(p_name, ' ', 2) AS surname, team_name, l_suppkey AS squad_id,
         {case("p_type", POSITION_OF_TYPE)} AS position, n AS jumper_number, date, match_id,
         competition_id, season, round, lines.team_location,
         {", ".join(f"CAST({PLAYER_STAT_SQL[c]} AS DOUBLE) AS {c}" for c in PLAYER_STATS)}, e AS price
  FROM lines
  JOIN team_match ON match_id = l_orderkey AND team_match.team_location = lines.team_location
  JOIN part ON p_partkey = l_partkey)"""

LADDER = """results AS (
  SELECT regexp_extract(a.team_name, '(\\w+)$', 1) AS team, a.season, a.round, a.score AS f, b.score AS a,
         CASE WHEN a.score > b.score THEN 2.0 WHEN a.score = b.score THEN 1.0 ELSE 0.0 END::DOUBLE AS p
  FROM team_match a JOIN team_match b ON a.match_id = b.match_id AND a.team_location <> b.team_location),
monthly AS (
  SELECT team, season, round, sum(p) AS p, sum(f) AS f, sum(a) AS a FROM results GROUP BY ALL),
ladder0 AS (
  SELECT team, sum(p) OVER w AS ladder_points, sum(f) OVER w AS points_for, sum(a) OVER w AS points_against,
         sum(f) OVER w - sum(a) OVER w AS points_diff, season, round
  FROM monthly WINDOW w AS (PARTITION BY team, season ORDER BY round)),
ladder AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY season, round
            ORDER BY ladder_points DESC, points_diff DESC, team) AS INTEGER) AS ladder_position
  FROM ladder0)"""

# the league table after the team's previous round
WITH_LADDER = f"""played AS (SELECT DISTINCT team_name, year(date) AS y, round FROM team_match),
prior AS (
  SELECT p.team_name, p.y, p.round, lag(l.ladder_points) OVER w AS ladder_points, lag(l.points_for) OVER w AS ladder_points_for,
         lag(l.points_against) OVER w AS ladder_points_against, lag(l.points_diff) OVER w AS ladder_points_diff,
         lag(l.ladder_position) OVER w AS ladder_position
  FROM played p LEFT JOIN ladder l
    ON regexp_extract(p.team_name, '(\\w+)$', 1) = l.team AND p.y = l.season AND p.round = l.round
  WINDOW w AS (PARTITION BY p.team_name ORDER BY p.y, p.round)),
with_ladder AS (
  SELECT t.*, {", ".join(LADDER_COLUMNS)}
  FROM team_match t JOIN prior p ON t.team_name = p.team_name AND year(t.date) = p.y AND t.round = p.round)"""

MATCHES = """matches AS (
  SELECT h.match_id, h.season, h.round, h.date, h.team_name AS team_home, a.team_name AS team_away,
         h.score AS score_home, a.score AS score_away, h.s_nationkey + 1 AS th, a.s_nationkey + 1 AS ta,
         CASE WHEN h.score > a.score THEN 1.0 WHEN h.score < a.score THEN 0.0 ELSE 0.5 END::DOUBLE AS result,
         h.possession_percentage AS poss_home, a.possession_percentage AS poss_away
  FROM team_match h JOIN team_match a USING (match_id)
  WHERE h.team_location = 'home' AND a.team_location = 'away')"""


def elo_cte(ks: str) -> str:
    """Ratings by recursion over the match sequence; ``ks`` is a one-column relation k."""
    return f"""seq AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY date, match_id) AS i, match_id, date, th, ta, result FROM matches),
rated AS (
  SELECT k::DOUBLE AS k, 0::BIGINT AS i, 0::BIGINT AS match_id, 0::DOUBLE AS eh, 0::DOUBLE AS ea,
         0::DOUBLE AS p, 0::DOUBLE AS result, list_transform(range(25), lambda x: 1500::DOUBLE) AS s
  FROM ({ks}) AS ks(k)
  UNION ALL
  SELECT k, i, match_id, eh, ea, p, result,
         list_transform(s, lambda v, j: CASE WHEN j = th THEN v + k * (result - p)
                                             WHEN j = ta THEN v - k * (result - p) ELSE v END)
  FROM (SELECT rated.k, seq.i, seq.match_id, seq.th, seq.ta, seq.result, rated.s,
               rated.s[seq.th] AS eh, rated.s[seq.ta] AS ea,
               1 / (1 + pow(10::DOUBLE, (rated.s[seq.ta] - rated.s[seq.th]) / 400)) AS p
        FROM rated JOIN seq ON seq.i = rated.i + 1))"""


LOSS = "-(result * ln(greatest(least(p, 1 - 1e-15), 1e-15)) + (1 - result) * ln(1 - greatest(least(p, 1 - 1e-15), 1e-15)))"


def ewma(col: str, window: str) -> str:
    return (
        f"list_reduce(list({col}) OVER ({window} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), "
        f"lambda a, x: {LAM} * a + (1 - {LAM}) * x)"
    )


TEAM_W = "PARTITION BY team_name ORDER BY date, match_id"
PLAYER_W = f"PARTITION BY player_id ORDER BY {', '.join(PLAYER_ORDER)}"


def ratio(a: str, b: str) -> str:
    return f"({a})::DOUBLE / nullif(({b})::DOUBLE, 0)"


RATES = {
    "m_per_run": ratio("run_metres", "runs"),
    "tb_per_run": ratio("tackle_breaks", "runs"),
    "lb_per_run": ratio("line_breaks", "runs"),
    "offs_per_run": ratio("offloads", "runs"),
    "ta_per_touch": ratio("try_assists", "possessions"),
    "lba_per_touch": ratio("line_break_assists", "possessions"),
    "kick_per_touch": ratio("kicks_general_play", "possessions"),
    "pass_per_touch": ratio("passes", "possessions"),
    "km_per_kick": ratio("kick_metres", "kicks_general_play"),
    "goals_per_kick": "(conversions + penalty_goals) / (nullif(conversion_attempts, 0) + nullif(penalty_goal_attempts, 0))",
    "tries_per_game": "tries",
    "err_per_touch": ratio("errors", "possessions"),
    "points_per_game": "points",
    "tackles_time": f"tackles / {case('position', POSITION_WEIGHTS)}::DOUBLE",
    "saves_per_game": "try_saves",
    "miss_per_t": ratio("missed_tackles", "tackles"),
    "pen_per_t": ratio("penalties_conceded", "tackles"),
    "ineff_per_t": ratio("tackles_ineffective", "tackles"),
}
assert list(RATES) == PLAYER_FEATURES

RATE_ROWS = f"""rates AS (
  SELECT player_id, firstname || '_' || surname AS name, team_name, position, match_id, competition_id, season,
         round, team_location, date, jumper_number, squad_id, points, price,
         {", ".join(f"{sql} AS {c}" for c, sql in RATES.items())}
  FROM player_match)"""

FORM_ROWS = f"""form AS (
  SELECT * EXCLUDE ({", ".join(PLAYER_FEATURES)}),
         {", ".join(f"{ewma(c, PLAYER_W)} AS {c}" for c in PLAYER_FEATURES)}
  FROM rates)"""


def z(col: str) -> str:
    over = "OVER (PARTITION BY competition_id, round, position)"
    return f"({col} - avg({col}) {over}) / nullif(stddev_samp({col}) {over}, 0)"


SCALED = f"""scaled AS (
  SELECT * EXCLUDE ({", ".join(PLAYER_FEATURES)}), {", ".join(f"{z(c)} AS {c}" for c in PLAYER_FEATURES)}
  FROM form)"""

ROLLUP = f"""rollup_rows AS (
  SELECT match_id, team_name, min(date) AS date, min(squad_id) AS squad_id,
         min(competition_id) AS competition_id, min(season) AS season, min(round) AS round,
         min(team_location) AS team_location, {", ".join(f"avg({c}) AS {c}" for c in PLAYER_FEATURES)}
  FROM scaled GROUP BY match_id, team_name)"""

TEAM_FEATURES = f"""team_features AS (
  SELECT match_id, team_name, score AS result,
         date - lag(date) OVER (PARTITION BY competition_id, team_name ORDER BY date, match_id) AS days_rest,
         {", ".join(f"{ewma(c, TEAM_W)} AS {c}" for c in TEAM_STATS)},
         {", ".join(LADDER_COLUMNS)}
  FROM with_ladder)"""


def _frame() -> str:
    def diff(c: str) -> str:
        side = lambda s: f"coalesce(max({c}) FILTER (team_location = '{s}'), 0)"
        return f"{q(f'{side("home")} - {side("away")}', 3)} AS {c}_diff"

    at = lambda c, s: f"max({c}) FILTER (team_location = '{s}')"
    probs = [("", 22), ("short", 10), ("long", 40)]
    joins = " ".join(f"LEFT JOIN rated r{k} ON r{k}.match_id = j.match_id AND r{k}.k = {k} AND r{k}.i > 0" for _, k in probs)
    return f"""WITH RECURSIVE {TEAM}, {PLAYERS}, {LADDER}, {WITH_LADDER}, {MATCHES},
{elo_cte("VALUES (22), (10), (40)")},
{RATE_ROWS}, {FORM_ROWS}, {SCALED}, {ROLLUP}, {TEAM_FEATURES},
joined AS (SELECT r.*, f.* EXCLUDE (match_id, team_name)
           FROM rollup_rows r LEFT JOIN team_features f USING (match_id, team_name)),
wide AS (
  SELECT match_id, date, coalesce({at("result", "home")}, 0) AS home_result,
         coalesce({at("result", "away")}, 0) AS away_result,
         {at("team_name", "home")} AS home_team, {at("team_name", "away")} AS away_team,
         CASE WHEN {at("result", "home")} > {at("result", "away")} THEN 'H' ELSE 'A' END AS result,
         {", ".join(diff(c) for c in DIFF_FEATURES)}
  FROM joined GROUP BY match_id, date)
SELECT j.*, {", ".join(f"{q(f'coalesce(r{k}.p, 0)', 6)} AS {n}prhome" for n, k in probs)}
FROM wide j {joins}"""


ORACLES: dict[str, str] = {}

ORACLES["rest_days"] = ORACLES["rest_days_hot_keys"] = f"""WITH {TEAM}
SELECT match_id, team_name, competition_id, date,
       CAST(date - lag(date) OVER (PARTITION BY competition_id, team_name ORDER BY date, match_id) AS INTEGER) AS days_rest
FROM team_match"""

ORACLES["first_per_key"] = f"""WITH {TEAM}, {PLAYERS}
SELECT player_id, match_id, date, team_name, jumper_number, points FROM (
  SELECT *, row_number() OVER ({PLAYER_W}) AS rn FROM player_match) WHERE rn = 1"""

ORACLES["ladder_position"] = ORACLES["ladder_position_hot_keys"] = f"""WITH {TEAM}, {LADDER}
SELECT team, season, round, ladder_points, points_for, points_against, points_diff, ladder_position FROM ladder"""

ORACLES["ladder_join_lag"] = ORACLES["ladder_lag_hot_keys"] = f"""WITH {TEAM}, {LADDER}, {WITH_LADDER}
SELECT match_id, team_name, {", ".join(LADDER_COLUMNS)} FROM with_ladder"""

ORACLES["pair_matches"] = f"""WITH {TEAM}, {MATCHES}
SELECT match_id, round, date, team_home, team_away, score_home, score_away FROM matches"""

ORACLES["result_code"] = f"""WITH {TEAM}, {MATCHES}
SELECT match_id, result AS elo, CASE WHEN score_home > score_away THEN 'H' ELSE 'A' END AS label,
       CASE WHEN score_home > score_away THEN 1.0 ELSE 0.0 END::DOUBLE AS odds FROM matches"""

ORACLES["unpivot_sides"] = f"""WITH {TEAM}, {MATCHES}
SELECT match_id, date, 'home' AS team_location, team_home AS team, score_home AS score FROM matches
UNION ALL SELECT match_id, date, 'away', team_away, score_away FROM matches"""

ORACLES["ewma_team_lagged"] = ORACLES["ewma_team_hot_keys"] = f"""WITH {TEAM}
SELECT match_id, team_name, {", ".join(f"{q(ewma(c, TEAM_W), 4)} AS {c}" for c in TEAM_STATS)} FROM team_match"""

_EVENTS = "events_history AS (SELECT user_id AS player_id, event_id, ts, CASE WHEN event_type <> 'error' THEN value END AS value FROM events)"
_EW = "PARTITION BY player_id ORDER BY ts, event_id"
ORACLES["ewma_player_poison"] = ORACLES["ewma_poison_hot_keys"] = f"""WITH {_EVENTS}
SELECT player_id, event_id, {q(ewma("value", _EW), 5)} AS form FROM events_history"""
ORACLES["ewma_player_skip"] = ORACLES["ewma_skip_hot_keys"] = f"""WITH {_EVENTS}
SELECT player_id, event_id, {q("list_reduce(CASE WHEN len(past) > 0 THEN past END, lambda a, x: " + LAM + " * a + (1 - " + LAM + ") * x)", 5)} AS form
FROM (SELECT *, list_filter(list(value) OVER ({_EW} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                            lambda x: x IS NOT NULL) AS past FROM events_history)"""

_PAST = [f"list_filter(list(nullif({c} % 3, 0)) OVER ({TEAM_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), lambda x: x IS NOT NULL) AS {c}" for c in TEAM_STATS]
_SKIPPED = [q(f"list_reduce(CASE WHEN len({c}) > 0 THEN {c} END, lambda a, x: {LAM} * a + (1 - {LAM}) * x)", 4) + f" AS {c}" for c in TEAM_STATS]
ORACLES["ewma_stats_skip"] = ORACLES["ewma_stats_skip_hot_keys"] = f"""WITH {TEAM}
SELECT match_id, team_name, {", ".join(_SKIPPED)} FROM (SELECT match_id, team_name, {", ".join(_PAST)} FROM team_match)"""

_IDS = "player_id, match_id, jumper_number, squad_id, points, price"
ORACLES["player_rates"] = f"""WITH {TEAM}, {PLAYERS}, {RATE_ROWS}
SELECT {_IDS}, name, {", ".join(f"{q(c, 5)} AS {c}" for c in PLAYER_FEATURES)} FROM rates"""

ORACLES["ewma_player_rates"] = f"""WITH {TEAM}, {PLAYERS}, {RATE_ROWS}, {FORM_ROWS}
SELECT {_IDS}, name, {", ".join(f"{q(c, 4)} AS {c}" for c in PLAYER_FEATURES)} FROM form"""

_RAW_SCALED = SCALED.replace("FROM form", "FROM rates")
ORACLES["group_scale"] = f"""WITH {TEAM}, {PLAYERS}, {RATE_ROWS}, {_RAW_SCALED}
SELECT {_IDS}, {", ".join(f"{q(c, 5)} AS {c}" for c in PLAYER_FEATURES)} FROM scaled"""

ORACLES["team_rollup"] = f"""WITH {TEAM}, {PLAYERS}, {RATE_ROWS}, scaled AS (SELECT * FROM rates), {ROLLUP}
SELECT match_id, team_name, date, squad_id, competition_id, season, round, team_location,
       {", ".join(f"{q(c, 5)} AS {c}" for c in PLAYER_FEATURES)} FROM rollup_rows"""

ORACLES["model_frame"] = _frame()

_ELO_BASE = f"WITH RECURSIVE {TEAM}, {MATCHES}"
ORACLES["elo_ratings"] = ORACLES["elo_time_blocks"] = f"""{_ELO_BASE}, {elo_cte("VALUES (22)")}
SELECT match_id, {q("eh", 4)} AS elo_home, {q("ea", 4)} AS elo_away, {q("p")} AS pr_home FROM rated WHERE i > 0"""

ORACLES["elo_variants"] = f"""{_ELO_BASE}, {elo_cte("VALUES (22), (10), (40)")}
SELECT match_id, {", ".join(f"max({q(c, 6 if c == "p" else 4)}) FILTER (k = {k}) AS {n}{o}" for n, k in (("", 22), ("short", 10), ("long", 40)) for c, o in (("eh", "elo_home"), ("ea", "elo_away"), ("p", "pr_home")))}
FROM rated WHERE i > 0 GROUP BY match_id"""

_GRID = elo_cte("SELECT unnest(range(1, 61))")
ORACLES["elo_grid_logloss"] = f"""{_ELO_BASE}, {_GRID}
SELECT k, count(*) AS n, {q(f"avg({LOSS})", 8)} AS logloss FROM rated WHERE i > 0 GROUP BY k"""
ORACLES["elo_best_k"] = f"""{_ELO_BASE}, {_GRID}
SELECT k, {q(f"avg({LOSS})", 8)} AS logloss FROM rated WHERE i > 0 GROUP BY k ORDER BY avg({LOSS}), k LIMIT 1"""

ORACLES["canonical_team"] = f"""WITH {TEAM}
SELECT team_name, regexp_extract(team_name, '(\\w+)$', 1) AS team, count(*) AS n FROM team_match GROUP BY team_name"""

ORACLES["player_key"] = f"""WITH {TEAM}, {PLAYERS}
SELECT player_id, firstname, surname FROM (
  SELECT *, row_number() OVER ({PLAYER_W}) AS rn FROM player_match) WHERE rn = 1"""

NAME_KEY = """player_key AS (
  SELECT min(p_partkey) AS player_id, split_part(p_name, ' ', 1) AS firstname, split_part(p_name, ' ', 2) AS surname
  FROM part GROUP BY p_name)"""

ORACLES["fuzzy_left_join"] = f"""WITH {NAME_KEY},
written AS (
  SELECT p_partkey, split_part(p_name, ' ', 1) || lower(substr(p_type, 1, 1)) AS firstname,
         split_part(p_name, ' ', 2) || CASE WHEN p_size % 2 = 0 THEN 's' ELSE '' END AS surname FROM part)
SELECT w.p_partkey, w.firstname, w.surname, k.player_id, k.firstname AS firstname_right, k.surname AS surname_right,
       {q("1 - jaro_similarity(w.firstname, k.firstname)", 6)} AS firstname_distance,
       {q("1 - jaro_similarity(w.surname, k.surname)", 6)} AS surname_distance
FROM written w LEFT JOIN player_key k
  ON 1 - jaro_similarity(w.firstname, k.firstname) <= {NAME_DISTANCE} + 1e-12
 AND 1 - jaro_similarity(w.surname, k.surname) <= {NAME_DISTANCE} + 1e-12"""

ORACLES["lineup_resolution"] = f"""WITH {NAME_KEY},
raw AS (
  SELECT split_part(p_name, ' ', 1) AS firstname,
         split_part(p_name, ' ', 2) || CASE WHEN s_nationkey % 3 = 0 THEN 's' ELSE '' END AS surname,
         CASE p_type WHEN 'SMALL' THEN 'Winger' WHEN 'LARGE' THEN '2nd' WHEN 'PROMO' THEN 'Reserve' ELSE 'Prop' END AS role,
         n_name AS team
  FROM supplier JOIN part ON p_partkey % (SELECT count(*) FROM supplier) + 1 = s_suppkey JOIN nation ON n_nationkey = s_nationkey),
used AS (
  SELECT row_number() OVER () AS row_id, firstname, surname, team,
         CASE role WHEN 'Winger' THEN 'Wing' WHEN '2nd' THEN 'Second Row' ELSE role END AS position
  FROM raw WHERE role <> 'Reserve'),
exact AS (SELECT u.*, k.player_id FROM used u JOIN player_key k USING (firstname, surname)),
fuzzy AS (
  SELECT u.*, k.player_id FROM (SELECT * FROM used WHERE row_id NOT IN (SELECT row_id FROM exact)) u
  LEFT JOIN player_key k
    ON 1 - jaro_similarity(u.firstname, k.firstname) <= {NAME_DISTANCE} + 1e-12
   AND 1 - jaro_similarity(u.surname, k.surname) <= {NAME_DISTANCE} + 1e-12),
games AS (SELECT n_name AS team, r_name || ' ' || n_name AS team_name, CAST(n_nationkey AS BIGINT) AS match_id
          FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT player_id, firstname, surname, x.team, position, team_name, match_id
FROM (SELECT * FROM exact UNION ALL SELECT * FROM fuzzy) x LEFT JOIN games USING (team)"""

ORACLES["fixture_ids"] = ORACLES["fixture_ids_hot_keys"] = f"""WITH {TEAM}, {MATCHES},
numbered AS (
  SELECT CAST(season AS BIGINT) AS competition_id, season, round, date, team_home, team_away,
         CAST((season * 100 + round)::BIGINT * 100000000 + row_number() OVER (PARTITION BY season, round
              ORDER BY date, team_home, team_away) AS BIGINT) AS match_id FROM matches)
SELECT competition_id, match_id, season, round, date, 'home' AS team_location, team_home AS team_name FROM numbered
UNION ALL SELECT competition_id, match_id, season, round, date, 'away', team_away FROM numbered"""

ORACLES["week_floor_split"] = f"""WITH {TEAM}, {MATCHES},
floors AS (SELECT match_id, date, date - CAST((dayofweek(date) + 5) % 7 AS INTEGER) AS week,
           (SELECT max(date) - CAST((dayofweek(max(date)) + 5) % 7 AS INTEGER) FROM matches) AS cutoff FROM matches)
SELECT match_id, date, week, CASE WHEN date < cutoff THEN 'train' ELSE 'predict' END AS role FROM floors"""

ORACLES["rolling_origin_folds"] = f"""WITH {TEAM}, {MATCHES},
ranked AS (SELECT match_id, row_number() OVER (ORDER BY date, match_id) AS r, count(*) OVER () AS n FROM matches),
folds AS (SELECT CAST(f AS INTEGER) AS fold, (SELECT max(n) FROM ranked) - 450 + (f - 1) * 31 AS fin
          FROM range(1, 11) AS t(f))
SELECT fold, 'analysis' AS role, match_id FROM ranked JOIN folds ON r <= fin
UNION ALL
SELECT fold, 'assessment', match_id FROM ranked JOIN folds ON r > fin AND r <= fin + 150"""

ORACLES["metrics_logloss_acc_f1"] = f"""WITH {TEAM}, {MATCHES},
scored AS (
  SELECT season, (poss_home + 1) / (poss_home + poss_away + 2) AS p,
         CASE WHEN score_home > score_away THEN 1.0 ELSE 0.0 END::DOUBLE AS result FROM matches)
SELECT season, {q(f"avg({LOSS})", 8)} AS logloss,
       {q("avg(CASE WHEN (p > 0.5) = (result = 1) THEN 1.0 ELSE 0.0 END)", 8)} AS accuracy,
       {q("CASE WHEN count(*) FILTER (p <= 0.5) > 0 THEN 2.0 * count(*) FILTER (result = 0 AND p <= 0.5) / (count(*) FILTER (result = 0) + count(*) FILTER (p <= 0.5)) END", 8)} AS f_meas,
       count(*) AS n
FROM scored GROUP BY season"""

_ODDS = """odds AS (
  SELECT match_id, 1 + score_away / score_home AS home_odds_close, 1 + score_home / score_away AS away_odds_close,
         CASE WHEN score_home > score_away THEN 1.0 ELSE 0.0 END::DOUBLE AS result FROM matches)"""
ORACLES["odds_devig_logloss"] = f"""WITH {TEAM}, {MATCHES}, {_ODDS},
fair AS (SELECT result, (1 / home_odds_close) / (1 / home_odds_close + 1 / away_odds_close) AS p FROM odds)
SELECT {q(f"avg({LOSS})", 8)} AS logloss, count(*) AS n FROM fair"""

ORACLES["upsert_idempotent"] = f"""WITH {TEAM}
SELECT match_id, team_name, season, round, date,
       CASE WHEN round = 12 THEN score + 1 ELSE score END AS score FROM team_match"""

ORACLES["zero_variance_filter"] = f"""WITH {TEAM}
{" UNION ALL ".join(f"SELECT '{c}' AS predictor, {q(f'min({c})', 3)} AS low, {q(f'max({c})', 3)} AS high, min({c}) < max({c}) AS keep FROM team_match" for c in TEAM_STATS)}
UNION ALL SELECT 'constant', {q("7.0")}, {q("7.0")}, false"""

ORACLES["collect_extracts"] = """SELECT CAST(c_custkey AS BIGINT) AS party_key, c_name AS party_name, c_nationkey AS nation_key,
  c_acctbal AS acct_bal, c_mktsegment AS market_segment, 'customer' AS extract FROM customer
UNION ALL SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL, 'supplier' FROM supplier"""

ORACLES["upsert_table"] = ORACLES["upsert_idempotent"]

ORACLES["versioned_merge"] = ORACLES["upsert_idempotent"]

ORACLES["versioned_read_back"] = f"""WITH {TEAM}
SELECT match_id, team_name, season, round, date, score FROM team_match"""

ORACLES["csv_round_trip"] = f"""WITH {TEAM}
SELECT match_id, team_name, season, round, date, score FROM team_match
UNION ALL SELECT match_id, team_name, season, round + 100, date, score FROM team_match"""

ORACLES["elo_by_pool"] = f"""WITH RECURSIVE {TEAM}, {MATCHES},
seq AS MATERIALIZED (
  SELECT season AS pool, row_number() OVER (PARTITION BY season ORDER BY date, match_id) AS i, match_id, th, ta, result
  FROM matches),
rated AS (
  SELECT DISTINCT season AS pool, 0::BIGINT AS i, 0::BIGINT AS match_id, 0::DOUBLE AS eh, 0::DOUBLE AS ea, 0::DOUBLE AS p,
         list_transform(range(25), lambda x: 1500::DOUBLE) AS s FROM matches
  UNION ALL
  SELECT pool, i, match_id, eh, ea, p,
         list_transform(s, lambda v, j: CASE WHEN j = th THEN v + 22 * (result - p)
                                             WHEN j = ta THEN v - 22 * (result - p) ELSE v END)
  FROM (SELECT rated.pool, seq.i, seq.match_id, seq.th, seq.ta, seq.result, rated.s,
               rated.s[seq.th] AS eh, rated.s[seq.ta] AS ea,
               1 / (1 + pow(10::DOUBLE, (rated.s[seq.ta] - rated.s[seq.th]) / 400)) AS p
        FROM rated JOIN seq ON seq.i = rated.i + 1 AND seq.pool = rated.pool))
SELECT match_id, {q("eh", 4)} AS elo_home, {q("ea", 4)} AS elo_away, {q("p")} AS pr_home FROM rated WHERE i > 0"""

_KNOWN = {k: v for k, v in POSITION_OF_TYPE.items() if k != "PROMO"}
ORACLES["map_values"] = f"""
SELECT {case("p_type", _KNOWN, "p_type")} AS position, CASE WHEN r_name <> 'ASIA' THEN r_name ELSE n_name END AS team, count(*) AS n
FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
JOIN nation ON n_nationkey = s_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL"""

ORACLES["tuning_metrics"] = f"""WITH {TEAM}, {MATCHES},
scored AS (
  SELECT round, season, (poss_home + 1) / (poss_home + poss_away + 2) AS p,
         CASE WHEN score_home > score_away THEN 1.0 ELSE 0.0 END::DOUBLE AS result FROM matches),
folds AS (
  SELECT round, season, avg({LOSS}) AS logloss,
         avg(CASE WHEN (p > 0.5) = (result = 1) THEN 1.0 ELSE 0.0 END) AS accuracy,
         CASE WHEN count(*) FILTER (p <= 0.5) > 0 THEN 2.0 * count(*) FILTER (result = 0 AND p <= 0.5)
           / (count(*) FILTER (result = 0) + count(*) FILTER (p <= 0.5)) END AS f_meas
  FROM scored GROUP BY ALL),
long AS (
  SELECT round, 'logloss' AS metric, logloss AS v FROM folds
  UNION ALL SELECT round, 'accuracy', accuracy FROM folds UNION ALL SELECT round, 'f_meas', f_meas FROM folds)
SELECT round AS config_id, metric, {q("avg(v)", 8)} AS mean, {q("stddev_samp(v) / sqrt(count(v))", 8)} AS std_err, count(v) AS n
FROM long GROUP BY round, metric"""

ORACLES["select_competitions"] = """SELECT p_partkey AS id, p_name AS name, p_size AS season FROM part
WHERE (p_name LIKE '%widget%' OR p_name LIKE '%bolt%') AND p_size >= 16"""

ORACLES["played_rounds"] = f"""WITH {TEAM}, {MATCHES} SELECT DISTINCT round FROM matches WHERE score_home > score_away"""

STUMP = f"""{TEAM}, {MATCHES},
x AS (SELECT match_id, date, team_home, team_away, CASE WHEN score_home > score_away THEN 1.0 ELSE -1.0 END::DOUBLE AS y,
             round::DOUBLE AS round, dayofweek(date) + 1.0 AS weekday, length(team_away)::DOUBLE AS away_nation FROM matches),
long AS (SELECT 0 AS f, 'round' AS variable, round AS v, y FROM x UNION ALL SELECT 1, 'weekday', weekday, y FROM x
         UNION ALL SELECT 2, 'away_nation', away_nation, y FROM x),
per AS (SELECT f, variable, v, count(*) AS n, sum(y) AS s FROM long GROUP BY ALL),
run AS (SELECT f, variable, v, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER (PARTITION BY f) AS n, sum(s) OVER (PARTITION BY f) AS s
        FROM per WINDOW w AS (PARTITION BY f ORDER BY v)),
split AS (SELECT f, variable, v, sl / nl AS ml, (s - sl) / (n - nl) AS mr,
                 nl / n * (sl / nl) * (sl / nl) + (n - nl) / n * ((s - sl) / (n - nl)) * ((s - sl) / (n - nl)) AS gain
          FROM run WHERE nl < n ORDER BY gain DESC, f, v LIMIT 1)"""

ORACLES["gbt_stump_scores"] = f"""WITH {STUMP},
scored AS (SELECT x.*, 1 / (1 + exp(-2 * CASE WHEN CASE split.f WHEN 0 THEN round WHEN 1 THEN weekday ELSE away_nation END <= split.v
                                              THEN ml ELSE mr END)) AS pred_h FROM x, split)
SELECT match_id, date, team_home AS home_team, team_away AS away_team, {q("1 - pred_h", 9)} AS pred_a, {q("pred_h", 9)} AS pred_h,
       CASE WHEN pred_h > 1 - pred_h THEN team_home ELSE team_away END AS pick
FROM scored"""

ORACLES["gbt_stump_importance"] = f"""WITH {STUMP}
SELECT DISTINCT long.variable, (long.variable = split.variable)::INT::DOUBLE AS importance FROM long, split"""

ORACLES["experiment_log"] = f"""WITH {TEAM}, {MATCHES}, {_ODDS},
fair AS (SELECT result, (1 / home_odds_close) / (1 / home_odds_close + 1 / away_odds_close) AS p FROM odds)
SELECT 'devig' AS algorithm, 'odds' AS feature_set, unnest(['closing odds', 'closing odds, again']) AS resample_scheme, logloss
FROM (SELECT {q(f"avg({LOSS})", 8)} AS logloss FROM fair)"""


def _weekly_ratings() -> str:
    probs = [("", 22), ("short", 10), ("long", 40)]
    history = elo_cte("VALUES (22), (10), (40)").replace("FROM matches)", "FROM matches WHERE date < (SELECT cutoff FROM week))")
    side = lambda c: f"{q(f'coalesce(h.{c}, 0) - coalesce(a.{c}, 0)', 6)} AS {c}_diff"
    at = lambda s: f"l.s[f.{s}]"
    p = f"1 / (1 + pow(10::DOUBLE, ({at('ta')} - {at('th')}) / 400))"
    value = lambda k: q(f"max({p}) FILTER (l.k = {k})", 6)
    return f"""WITH RECURSIVE {TEAM}, {LADDER}, {WITH_LADDER}, {MATCHES},
day AS (SELECT max(date) - 7 AS day FROM team_match),
week AS (SELECT day, day - CAST((dayofweek(day) + 5) % 7 AS INTEGER) AS cutoff FROM day),
fixtures AS (
  SELECT CAST((season * 100 + round)::BIGINT * 100000000 + row_number() OVER (PARTITION BY season, round ORDER BY date, team_home, team_away) AS BIGINT) AS fid,
         date, season, round, team_home, team_away, th, ta
  FROM matches, week WHERE date >= cutoff AND season = year(day) AND round = month(day)),
{history},
final AS (SELECT k, s FROM rated WHERE i = (SELECT max(i) FROM rated))
SELECT f.fid AS match_id, f.date, f.team_home AS home_team, f.team_away AS away_team,
       {", ".join(side(c) for c in LADDER_COLUMNS)}, {", ".join(f"{value(k)} AS {n}prhome" for n, k in probs)}
FROM fixtures f
JOIN prior h ON h.team_name = f.team_home AND h.y = f.season AND h.round = f.round
JOIN prior a ON a.team_name = f.team_away AND a.y = f.season AND a.round = f.round
CROSS JOIN final l
GROUP BY ALL"""


ORACLES["weekly_ratings"] = _weekly_ratings()

ORACLES["carried_ratings"] = ORACLES["elo_ratings"]

ORACLES["carried_form"] = ORACLES["ewma_team_lagged"]

ORACLES["carried_rest_days"] = ORACLES["rest_days"]

ORACLES["bulk_load"] = ORACLES["versioned_read_back"]

ORACLES["bulk_load_ladder"] = ORACLES["ladder_position"]

_REGION = "CASE WHEN score_away % 11 <> 0 THEN regexp_extract(team_away, '^(.*) [A-Za-z0-9_]+$', 1) END"
ORACLES["fitted_preprocessing"] = f"""WITH {TEAM}, {MATCHES},
rows_ AS (SELECT match_id, nullif(score_home % 7, 0) AS home, {_REGION} AS region FROM matches)
SELECT match_id, home, {", ".join(f"(region = '{r}')::DOUBLE AS region_{r.lower().replace(' ', '_')}" for r in ("AMERICA", "ASIA", "MIDDLE EAST"))},
       (region = 'EUROPE')::DOUBLE AS region_new, CASE WHEN home IS NOT NULL AND region IS NOT NULL THEN true END AS trainable
FROM rows_"""

ORACLES["fuzzy_vocabulary"] = f"""WITH v AS MATERIALIZED (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM documents)
SELECT a.w AS value, b.w AS value_right, {q("1 - jaro_similarity(a.w, b.w)", 6)} AS distance
FROM v a JOIN v b ON a.w < b.w AND 1 - jaro_similarity(a.w, b.w) <= 0.05 + 1e-12"""
