"""Scans of landed deliveries, accounts, registries and lists."""
