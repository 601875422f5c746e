"""Spark-native analytics for annotated video tracks (boxes, tubes, overlaps, splits)."""
