"""scorewright: customer and image scoring, clustering and model metrics as Spark DataFrame plans.

Layout
------
sources/    readers: CSV (typed or all-string), label maps, images, ZIP members, saved models,
            and the stand-in tables derived from the driver's parquet tables
functions/  column expressions (cleaning, casts, path parsing, sigmoid, dot products, formatting)
operators/  DataFrame -> DataFrame operators (cleaning, features, splits, metrics, scoring, ranks)
plans/      end-to-end jobs plus the query registry and the DuckDB oracle SQL
sinks/      writers (single-file CSV/JSON, distributed CSV, model save)
streaming/  row-wise scoring applied to a file stream (the reference has no streaming)
"""

__version__ = "0.1.0"
