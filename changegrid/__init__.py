"""changegrid: a Spark-native engine for land-change detection tables (pixels, scenes, points)."""
