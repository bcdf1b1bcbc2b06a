"""ledgerline: retail sales analytics written directly on Spark DataFrames.

Layout
------
- ``sources``   : readers (CSV with explicit schemas, Parquet, streaming) and
                  the adapter that maps the driver's tables onto the retail
                  star schema.
- ``functions`` : column expressions (money arithmetic, time buckets).
- ``operators`` : DataFrame -> DataFrame building blocks (quality rules,
                  marts, measures, dashboard visuals, star schema).
- ``streaming`` : the windowed-demand operator shared by batch and stream,
                  spike detection and the stream runner.
- ``plans``     : named queries over a table directory, the lakehouse
                  writers, and shared-folder handling.

Every operator returns a lazy DataFrame; only the lakehouse writers and the
stream runner perform actions.
"""

from ledgerline.params import RetailParams

__all__ = ["RetailParams"]
