"""driftglass: a Spark-native telemetry lakehouse and live analytics engine."""
