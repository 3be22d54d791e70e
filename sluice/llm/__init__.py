"""Training-data operators at corpus scale; see the README's table."""

import sys

from pyspark import cloudpickle

# functions that run in tasks travel with their code: executors need no
# installation of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
