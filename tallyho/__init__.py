"""tallyho: voucher and sensor analytics as Spark jobs.

``functions`` holds column expressions, ``operators`` DataFrame -> DataFrame steps,
``sources`` / ``sinks`` the inputs and outputs, ``streaming`` the sensor log stream,
``plans`` the query registry, its DuckDB cross-check SQL and the end-to-end jobs.
"""

__version__ = "0.1.0"
