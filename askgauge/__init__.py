"""Evaluation analytics for multiple-choice question answering, as Spark DataFrame functions."""
