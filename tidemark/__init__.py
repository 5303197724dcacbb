"""tidemark: time-series candles, window features, RSI, regression and
serving datasets as Spark DataFrame plans."""

__version__ = "0.1.0"
