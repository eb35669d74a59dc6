"""Files in, tables out: CSV drops, landing folders, segmented Parquet tables."""
