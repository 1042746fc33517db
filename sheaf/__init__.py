"""Sheaf: harvesting structured dataset metadata as Spark jobs.

Every operator is a lazy ``DataFrame -> DataFrame`` function (or a ``Column`` expression), so the
optimiser sees one plan per harvest and repositories are rows rather than loop iterations.
"""
