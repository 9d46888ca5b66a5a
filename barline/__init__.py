"""Candle (OHLCV) analytics on Spark: load, check, slice, compare and backtest many series at once."""
