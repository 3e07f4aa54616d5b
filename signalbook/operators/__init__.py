"""Joins, windows and folds that hold when one key has a third of the rows."""
