"""wattlake: electrical-grid telemetry analytics as Spark DataFrame operators.

Every operator is a plain function from DataFrame to DataFrame.  Nothing runs until
the caller acts on the result; the few places that must materialise (layer writes,
model fitting) live in ``wattlake.plans`` and say so.
"""

__version__ = "0.1.0"

import sys

from pyspark import cloudpickle

# Functions sent to executors travel with their code, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
