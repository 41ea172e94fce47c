"""marketlake: a Spark-native engine for daily market data.

Prices, company profiles and benchmark series are landed append-only, deduplicated
latest-wins, enriched with partitioned window metrics, joined into a stock dimension and
a daily fact table, checked for quality, and queried for every symbol in one job.
Every transformation is a ``DataFrame -> DataFrame`` function built from Spark SQL
built-ins, so Catalyst sees (and prunes, pushes down and re-plans) the whole chain.
"""

__version__ = "0.1.0"
