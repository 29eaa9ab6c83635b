"""tessera: Spark-native table and stream analytics operators.

The package is a library of parameterised DataFrame / Structured Streaming
operators plus four flows composed from them (``tessera.plans``):

* ``plans.sales``        – retail sales cleaning, statistics and scoring
* ``plans.taxi``         – bronze / silver / gold trips with an expectation
* ``plans.orders_table`` – partitioned orders table in plain parquet
* ``plans.shop_daily``   – daily warehouse load with keyed upserts and checks

Every operator of these flows is a ``DataFrame -> DataFrame`` transformation built from
native Spark expressions. ``tessera.llm`` (optional) holds training-data operators.
"""

__version__ = "0.1.0"
