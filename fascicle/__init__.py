"""Text and ticket analytics as plain functions over Spark DataFrames."""
