"""tableworks: DataFrame-in, DataFrame-out analytics operators on Apache Spark."""
