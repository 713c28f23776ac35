"""vitals: a Spark-native pipeline for wearable and sensor exports.

XML export -> bronze (text) -> silver (typed, de-duplicated, validated) ->
gold (daily rollups) -> quality report and serving queries. All of it is
DataFrame code on built-in functions; ``keys`` turn every rollup into a
per-entity rollup for fleets.
"""

__version__ = "0.1.0"
