"""nimbusmart — yearly weather data marts on plain PySpark DataFrames.

Layers: ``sources`` / ``sinks`` (I/O), ``functions`` (Column builders),
``operators`` (DataFrame -> DataFrame steps), ``plans`` (composed jobs and
the query registry) and ``streaming`` (incremental bronze feed).
"""

__version__ = "0.1.0"
