"""Spark-native time-series features, quality reports and forecasting jobs over keyed observation tables."""
