"""vigilake: container-security telemetry analytics as PySpark DataFrame transformations."""
