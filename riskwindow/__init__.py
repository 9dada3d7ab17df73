"""Log-window incident analytics on Spark."""
