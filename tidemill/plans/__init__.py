"""Business queries and the registry behind the driver contract."""
