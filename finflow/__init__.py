"""finflow: a Spark-native pipeline and warehouse for finance and retail business data.

Landed files are discovered, typed, cleaned and judged against declarative quality
rules; clean rows are loaded idempotently into staging tables and modelled into a
star schema with type-1 / type-2 dimensions; marts and run reports sit on top.
All core work is DataFrame / SQL expressions so Catalyst and AQE plan it.
"""

__version__ = "0.1.0"
