"""Registered queries over the given tables, each with its SQL twin where SQL can say the same."""

from gaugeloom.plans.queries import cleaning, evaluation, modelling, profiles, series, tables
from gaugeloom.plans.queries.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "cleaning", "evaluation", "modelling", "profiles", "series", "tables"]
