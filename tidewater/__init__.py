"""Tidewater: a layered e-commerce warehouse as Spark jobs, batch and streaming."""
