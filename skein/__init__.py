"""skein: a Spark-first engine for time-aligned text, interval and event data."""
