"""Column functions.

Executors need no copy of this package: the two modules with Python functions
are sent with the tasks that use them.
"""

from pyspark import cloudpickle

from kliping.functions import cleanup, nodes

cloudpickle.register_pickle_by_value(cleanup)
cloudpickle.register_pickle_by_value(nodes)
