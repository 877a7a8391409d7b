"""Reading and writing: relations, snapshots, increments, JSON and XML extracts, envelopes."""
