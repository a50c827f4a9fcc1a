"""Reading and writing the engine's tables."""
