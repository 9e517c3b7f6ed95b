"""Imports every module that registers queries."""

from workload import files, learning, outcomes, profiles, rows  # noqa: F401
