"""Readers, file inventories, binary decoding and sinks."""
