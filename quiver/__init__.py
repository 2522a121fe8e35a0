"""quiver — many-series market analytics as Spark DataFrame plans.

Every operator is a function ``DataFrame -> DataFrame`` (or a small family of
them) that only declares a plan; actions happen in sinks, model fits and the
caller. Series are keyed by ``ticker`` and ordered by ``date``.
"""

__version__ = "0.1.0"


def _pickle_by_value() -> None:
    """Fallback for sessions that did not ship the package: functions defined
    in ``quiver`` travel inside the pickled task instead of by import."""
    try:
        import sys

        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # noqa: BLE001 - optional; shipping via addPyFile is the main path
        pass


_pickle_by_value()
