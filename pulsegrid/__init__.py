"""pulsegrid: sliding-window feature tables over many time series, on Spark DataFrames."""

from pulsegrid.plans.features import correlate, features
from pulsegrid.plans.windows import carry_forward, window_spine, windowed

__all__ = ["carry_forward", "correlate", "features", "window_spine", "windowed"]
