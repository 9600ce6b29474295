"""Operators: analyzers, profiling, checks, expectations, suite generation, comparison."""
