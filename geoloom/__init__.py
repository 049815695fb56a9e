"""geoloom: open geospatial and statistical tables as Spark DataFrames.

Every public operator is a plain ``DataFrame -> DataFrame`` (or ``Column -> Column``) function; the
sub-packages are

* ``functions``  - Column expressions and the Arrow functions over WKB geometry,
* ``operators``  - schema, filter, join, statistics, layout, catalog, quality and raster operators,
* ``sources``    - readers and writers,
* ``plans``      - whole jobs put together from operators,
* ``streaming``  - the same jobs run incrementally over a landing folder.
"""

import sys

from pyspark import cloudpickle

# Arrow functions travel to the executors with their code, so a job needs no package installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
