"""Rule-based detection, storage and scoring of labelled record streams on Spark."""
