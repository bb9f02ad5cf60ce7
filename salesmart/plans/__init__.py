"""Jobs that put the building blocks together, layer by layer."""
