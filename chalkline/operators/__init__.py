"""DataFrame -> DataFrame operators; all take column names as parameters."""
