"""A Spark engine for the data side of document text recognition."""
