"""blotter: incident analytics as plain Spark DataFrame operators.

Layers follow the usual medallion shape:

* ``sources``   – landing JSON / GeoJSON readers, layer writers, schemas, and
  the adapter that derives incident-shaped records from the test star schema.
* ``functions`` – pure ``Column`` builders (typing, cleaning, labels).
* ``operators`` – ``DataFrame -> DataFrame`` steps: silver cleaning, gold
  model, de-duplication, marts, filterable metrics, exploration, anomaly
  detection, area polygons and data-quality checks.
* ``plans``     – the batch refresh (bronze -> silver -> gold -> marts) and the
  catalogue of registered queries with their default parameters.
* ``streaming`` – the same cleaning applied to a file stream of landing JSON.

Everything runs on Spark; no operator collects data to the driver.
"""

__all__ = ["functions", "sources", "operators", "plans", "streaming"]
