"""Part of the engine; see the README."""
