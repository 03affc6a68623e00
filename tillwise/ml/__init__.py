"""Segmentation, status and spend models on the customer feature table."""
