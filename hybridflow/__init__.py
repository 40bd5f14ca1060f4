"""Analytics over live streams combined with finite historical tables, on Spark."""
