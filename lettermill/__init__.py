"""Spark-native operators for curating letter corpora into instruction-tuning records.

Every public function takes and returns DataFrames or Columns, is lazy unless its docstring names an
action, and leaves partitioning to Catalyst and AQE. Rules (patterns, phrases, rewrites, weights,
templates) are values the caller passes in; they are compiled to native column expressions.
"""
