"""Price-observation to reference-rate toolkit built on Spark DataFrames.

Landed price catalogues are flattened, streamed into a raw (Bronze) table, reduced to
the latest valid quote per key (Silver) and aggregated into dated index snapshots (Gold).
Every operator is a plain ``DataFrame -> DataFrame`` function.
"""
