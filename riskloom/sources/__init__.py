"""Readers, writers and the driver-table views the queries run on."""
