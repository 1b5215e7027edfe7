"""Spark jobs for paired-contest data: ratings, form, differentials, evaluation, weekly scoring."""
