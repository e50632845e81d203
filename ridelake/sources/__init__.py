"""Readers, writers, snapshots and the mapping from stored tables to the ride model."""
