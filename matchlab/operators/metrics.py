"""Scores of probability forecasts and the bookmaker baseline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlab.functions.columns import binary_loss, result_code


def log_loss(outcome: Column, p: Column) -> Column:
    return F.avg(binary_loss(outcome, p))


def accuracy(truth: Column, guess: Column) -> Column:
    return F.avg((truth == guess).cast("double"))


def f_meas(truth: Column, guess: Column, event: str = "A") -> Column:
    """F1 of one level; null where the level is never guessed, so such a fold is left out of the mean."""
    guessed = F.sum((guess == event).cast("double"))
    hit = F.sum(((truth == event) & (guess == event)).cast("double"))
    either = F.sum((truth == event).cast("double")) + guessed
    return F.when(guessed > 0, F.try_divide(2 * hit, either))


def forecast_metrics(
    scored: DataFrame, truth: str = "result", p: str = "pred_h", by: Sequence[str] = ()
) -> DataFrame:
    """Log loss, accuracy and F1 of level A for label H/A and the probability of H."""
    guess = F.when(F.col(p) > 0.5, "H").otherwise("A")
    y = (F.col(truth) == "H").cast("double")
    return scored.groupBy(*by).agg(
        log_loss(y, F.col(p)).alias("logloss"),
        accuracy(F.col(truth), guess).alias("accuracy"),
        f_meas(F.col(truth), guess).alias("f_meas"),
        F.count(F.lit(1)).alias("n"),
    )


def devig(odds: DataFrame) -> DataFrame:
    """Win probabilities from closing odds, without the bookmaker's margin; rows with gaps are dropped."""
    need = ["home_odds_close", "away_odds_close", "home_score", "away_score"]
    home, away = (F.try_divide(F.lit(1.0), F.col(c)) for c in need[:2])
    return odds.dropna(subset=need).withColumns(
        {
            "result": result_code(F.col("home_score"), F.col("away_score"), "odds"),
            "home_pr": F.try_divide(home, home + away),
            "away_pr": F.try_divide(away, home + away),
        }
    )


def odds_logloss(odds: DataFrame) -> DataFrame:
    return devig(odds).agg(
        log_loss(F.col("result"), F.col("home_pr")).alias("logloss"), F.count(F.lit(1)).alias("n")
    )
