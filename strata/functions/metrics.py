"""Metrics gathered by ``DataFrame.observe`` during an action."""

from __future__ import annotations

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Observation


def observed(observation: Observation) -> dict:
    """Metrics of a finished action; empty when they are not known.

    A plan without partitions runs no task and leaves no metrics row; callers
    must record that as unknown, not as zero.
    """
    try:
        return dict(observation.get)
    except (PySparkException, Py4JError, IndexError, TypeError):
        return {}
