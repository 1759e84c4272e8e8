"""PySpark-native analytics for multi-round, multi-channel 3-D imaging data."""
