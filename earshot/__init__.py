"""Listening analytics on Spark: a raw interaction log in, a clean star schema and its metrics out."""

from earshot.plans.star import Star
from earshot.sources.inputs import Inputs

__all__ = ["Inputs", "Star"]
