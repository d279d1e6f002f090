"""Views that shape raw tables into the engine's schemas."""
