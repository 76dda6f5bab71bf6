"""stratum: layered (bronze -> silver -> gold) analytics as PySpark jobs.

Every operator is a plain function DataFrame -> DataFrame (or Column -> Column)
built from the DataFrame / SQL API so that Catalyst and AQE plan the work.
"""

__version__ = "0.1.0"
