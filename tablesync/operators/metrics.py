"""Row counts measured while a frame is written -- no second scan."""

from __future__ import annotations

import logging
import uuid

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


def observe_rows(df: DataFrame, name: str | None = None) -> tuple[DataFrame, Observation]:
    """Attach a row-count metric; read it with :func:`observed` after the action."""
    obs = Observation(name or f"rows_{uuid.uuid4().hex[:8]}")
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def observed(obs: Observation) -> dict:
    """The metrics of an Observation; empty, and logged, when the observed job reported
    none (a plan that Spark found to be empty runs no task that could)."""
    try:
        return dict(obs.get)
    except (Py4JError, PySparkException) as exc:
        log.warning("no metrics observed: %s", exc)
        return {}
