"""Values sent to tasks so that no package is needed where the tasks run."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import SparkSession


class Sent:
    """A broadcast value, pickled with its classes by value; ``value`` is built once per Python worker.

    A plain broadcast pickles classes by reference, and its readers would have to import this package. Workers keep
    broadcast values from task to task, so what is built from one is kept beside its bytes.
    """

    def __init__(self, spark: SparkSession, value: Any):
        self._packed = spark.sparkContext.broadcast({"packed": cloudpickle.dumps(value)})

    @property
    def value(self) -> Any:
        return self.made("value", lambda held: cloudpickle.loads(held["packed"]))

    def made(self, name: str, make: Callable[[Any], Any]) -> Any:
        """What ``make`` returned when this worker first asked for ``name``: something to reuse, the same each time."""
        held = self._packed.value
        if name not in held:
            held[name] = make(held if name == "value" else self.value)
        return held[name]
