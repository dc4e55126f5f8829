"""The given test tables mapped to raw retail tables, in Spark and (for the oracle) in SQL."""
