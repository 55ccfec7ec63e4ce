"""All registered queries."""

from lexflume.plans import (  # noqa: F401
    answers,
    corpus,
    evaluation,
    modelling,
    profiling,
    reports,
    sequences,
    streams,
)
from lexflume.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
