"""Operators: each takes DataFrames and column names and returns a DataFrame.

Modules by family: ``catalog``, ``revenue``, ``trends``, ``ranking`` and
``membership`` (reports), ``rental`` (reports with checked arguments),
``changes``, ``ledger`` and ``intake`` (table changes), ``quality`` and ``policy``.
"""
