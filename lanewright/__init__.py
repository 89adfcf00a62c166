"""Warehouse analytics operators and pipelines for supply-chain and facilities data on Spark."""
