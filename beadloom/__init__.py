"""Composable PySpark operators for barcoded sequencing and spatial count data."""
