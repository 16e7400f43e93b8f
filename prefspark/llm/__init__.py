"""Operations of a training-data pipeline, each ``DataFrame -> DataFrame``.

Nothing else in the library imports this subpackage. Rules that hold for every operator here:

* A null text counts as an empty text. Extra columns of the input are ignored (the operator
  reads only the columns named by its parameters), so names cannot clash.
* Functions that run in Python workers travel by value, so executors need no installed copy.
* Intermediate tables are Parquet below ``spark.checkpoint.dir``; every job can be re-run from
  them when executors are lost.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
