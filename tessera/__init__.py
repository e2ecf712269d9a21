"""tessera: keyed event logs, current-state tables and platform roll-ups on Spark.

Every public function is ``DataFrame -> DataFrame`` or ``Column -> Column`` so that
Catalyst plans the work; nothing is collected to the driver.
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Pickle this package's functions by value so Python workers need not import it.

    A session created by someone else (a scheduler, a notebook) has workers whose
    path does not include this checkout; shipping the few helpers used inside
    ``mapInPandas``/``applyInPandas`` with the task avoids that dependency.
    """
    import sys

    try:
        from pyspark import cloudpickle
    except Exception:  # pragma: no cover - pyspark always vendors cloudpickle
        return
    try:
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:
        pass


_ship_by_value()
