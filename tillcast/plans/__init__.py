"""Composed jobs: the table context, the daily report and the question catalog."""
