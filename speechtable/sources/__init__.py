"""Reading and writing corpora: catalogues, tar shards, Parquet, streams."""
