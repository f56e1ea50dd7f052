"""Evaluation-data engine on Spark: prompts, answers, scores and a leaderboard as DataFrames."""
