"""Market-bar analytics on Spark: raw exchange data to ticks, bars, warehouse and candles."""

__version__ = "0.1.0"
