"""Operators of a training-data pipeline: tokens, duplicates, quality, language, archives.

Nothing else in the package imports this subpackage. Functions that run inside
tasks are module level functions, found by import on the executors.
"""
