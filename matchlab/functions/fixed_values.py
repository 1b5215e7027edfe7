"""Fixed values that results depend on: names, aliases, weights and model constants."""

# --- fixed values: short team names that differ between the sources
TEAM_ALIASES = {"Wests Tigers": "Tigers", "Sea Eagles": "Eagles"}

# --- fixed values: fixture list name -> full team name
FIXTURE_TEAM_NAMES = {
    "Brisbane": "Brisbane Broncos",
    "Newcastle": "Newcastle Knights",
    "Melbourne": "Melbourne Storm",
    "Cronulla": "Cronulla-Sutherland Sharks",
    "Manly": "Manly-Warringah Sea Eagles",
    "North Qld": "North Queensland Cowboys",
    "South Sydney": "South Sydney Rabbitohs",
    "Sydney": "Sydney Roosters",
    "Penrith": "Penrith Panthers",
    "Parramatta": "Parramatta Eels",
    "St Geo Illa": "St George-Illawarra Dragons",
    "Gold Coast": "Gold Coast Titans",
    "Canberra": "Canberra Raiders",
    "Canterbury": "Canterbury-Bankstown Bulldogs",
}

# --- fixed values: line-up role -> position, and the role that is left out
ROLE_ALIASES = {"Winger": "Wing", "2nd": "Second Row"}
UNUSED_ROLE = "Reserve"

# --- fixed values: names in the line-ups -> names in the player table
FIRSTNAME_ALIASES = {"KL": "Kayal", "Sebastian": "Seb", "Leka": "Selumiela"}
SURNAME_ALIASES = {"Vaimauga": "Sifakula"}

# --- fixed values: share of the game time by position
POSITION_WEIGHTS = {
    "Fullback": 1.0,
    "Wing": 1.0,
    "Centre": 1.0,
    "Five-Eighth": 1.0,
    "Halfback": 1.0,
    "Prop": 0.6,
    "Hooker": 0.8,
    "Second Row": 0.75,
    "Lock": 0.75,
    "Interchange": 0.4,
}

# --- fixed values: the statistics of a player in a match
PLAYER_STATS = [
    "points", "tries", "conversion_attempts", "conversions", "penalty_goal_attempts",
    "penalty_goals", "try_assists", "line_break_assists", "passes", "kick_metres",
    "kicks_general_play", "possessions", "runs", "runs_hitup", "runs_normal", "run_metres",
    "runs_hitup_metres", "runs_normal_metres", "post_contact_metres", "offloads", "line_breaks",
    "tackle_breaks", "tackleds", "tackles", "tackles_ineffective", "missed_tackles", "try_saves",
    "handling_errors", "errors", "penalties_conceded",
]

# --- fixed values: the statistics of a team in a match
TEAM_STATS = [
    "score", "completion_rate_percentage", "possession_percentage", "time_in_own_half",
    "time_in_opp_half", "time_in_own20", "time_in_opp20", "set_restarts", "goal_line_dropouts",
]

# --- fixed values: league table columns after the join to team rows
LADDER_COLUMNS = [
    "ladder_points", "ladder_points_for", "ladder_points_against", "ladder_points_diff",
    "ladder_position",
]

# --- fixed values: raw column names of landed league tables and line-ups -> table column
LADDER_NAMES = {"points": "ladder_points"}
LINEUP_NAMES = {"first_name": "firstname", "last_name": "surname", "role": "position"}

# --- fixed values: rate features of a player
PLAYER_FEATURES = [
    "m_per_run", "tb_per_run", "lb_per_run", "offs_per_run", "ta_per_touch", "lba_per_touch",
    "kick_per_touch", "pass_per_touch", "km_per_kick", "goals_per_kick", "tries_per_game",
    "err_per_touch", "points_per_game", "tackles_time", "saves_per_game", "miss_per_t",
    "pen_per_t", "ineff_per_t",
]

# --- fixed values: rating and form constants
START_RATING = 1500.0
RATING_SCALE = 400.0
FORM_DECAY = 0.94
LONG_RUN_K = {"": 22.0, "short": 10.0, "long": 40.0}
K_GRID = [float(k) for k in range(1, 61)]
NAME_DISTANCE = 0.22

# --- fixed values: evaluation scheme
TEST_CUTOFF = "2025-02-01"
FOLDS, ASSESS, SKIP = 10, 150, 30
TREES, GRID_SIZE = 1000, 20
# tuning ranges; the last four are exponents of ten where marked
PARAM_RANGES = {
    "mtry": (1, 36),
    "min_n": (2, 40),
    "tree_depth": (1, 15),
    "learn_rate": (-3.0, -0.5),  # power of ten
    "loss_reduction": (-10.0, 1.5),  # power of ten
    "sample_size": (0.1, 1.0),
}
