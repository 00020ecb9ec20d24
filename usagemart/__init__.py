"""Customer usage analytics as Spark jobs: telemetry -> customer mart -> reports."""
