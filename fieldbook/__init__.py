"""fieldbook: a Spark-native agronomic data warehouse.

Every public function takes and returns DataFrames or Columns; nothing is
collected to the driver.  Sub-packages:

* ``functions`` - Column expressions (normalisation, parsers, calendar, ratios)
* ``operators`` - DataFrame -> DataFrame building blocks (filters, joins,
  dedup, upsert, SCD2, running balance, allocation, top-k, quality checks)
* ``sources``   - landed page/sheet readers and table sinks
* ``plans``     - staging views, dimensions, facts, metrics and reports
* ``streaming`` - Structured Streaming jobs for incremental loads
* ``registry``  - driver-table stand-ins and the registered queries
"""

__version__ = "0.1.0"
