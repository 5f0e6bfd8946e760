"""onefold: turn many unlike sources that describe the same things into one trusted table, on Spark."""
