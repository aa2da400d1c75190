"""Speech-corpus tables on Spark: catalogue, cleanse, degrade, pair, audit and export."""
