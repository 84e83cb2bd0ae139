"""sparkmon: machine-sensor monitoring as Spark DataFrame and Structured Streaming operators."""
