from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, Observation
from pyspark.sql import functions as F


def col(c) -> Column:
    """Accept a column name or a Column."""
    return c if isinstance(c, Column) else F.col(c)


def observed(obs: Observation) -> dict | None:
    """What was observed, None if Spark dropped the observation together with
    an empty input."""
    try:
        return obs.get
    except PySparkException as exc:
        if "observ" not in str(exc).lower():
            raise
    except Py4JJavaError as exc:
        if "toPyRow" not in str(exc):
            raise
    return None
