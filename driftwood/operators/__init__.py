"""DataFrame -> DataFrame operators (the engine's inventory)."""
