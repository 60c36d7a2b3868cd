"""Training-data operators over web-scale document tables.

One module per operator; ``registry`` exposes the queries.  Nothing outside this
subpackage (and ``corpus_pipeline.py``) imports it.
"""

import sys

from pyspark import cloudpickle

# Code of Python stages travels with the job: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
