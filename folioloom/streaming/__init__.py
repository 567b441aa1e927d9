"""Incremental refresh. The models themselves are batch: there is no stream to watermark."""
