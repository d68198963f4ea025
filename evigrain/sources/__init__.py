"""Readers, writers and connectors at the edges: JSON lines, JSON folders, downloads, page parsers, model clients, manifests."""
