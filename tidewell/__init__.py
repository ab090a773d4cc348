"""Tidewell: aligning sparse labelled anchors with dense sensor streams, on Spark."""
