"""Readers: landing files, exchange rates, file manifests, warehouse tables."""
