"""tillroll: customer / product / transaction analytics as Spark DataFrame plans.

Every operator is a plain function ``DataFrame -> DataFrame`` built from
built-in Spark expressions. Nothing here collects to the driver; one-row
aggregates (percentile cut points, global maxima) stay inside the plan and
are attached with a broadcast of that single row.
"""

__version__ = "0.1.0"
