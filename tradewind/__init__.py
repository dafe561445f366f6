"""Marketplace analytics on Spark: dimension syncs, a streamed sales fact, rollups, panels, a product catalogue."""
