"""DataFrame -> DataFrame operators (joins, aggregations, windows); nothing is collected."""
