"""Warehouse jobs: staging, core loads, marts, reads and analytics as compositions of the operators."""
