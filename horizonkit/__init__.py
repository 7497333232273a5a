"""horizonkit — time-series analytics and forecasting operators on Spark DataFrames.

Subpackages: ``functions`` (column expressions), ``sources`` (tables, readers,
sinks), ``operators`` (grid, quality, profile, features, backtest, metrics,
compare, stats, anomaly, models, inference; bucketed windows in ``halo``),
``plans`` (registered queries and their SQL oracles, the refresh job) and
``streaming`` (event-time resampling).
"""

__version__ = "0.1.0"
