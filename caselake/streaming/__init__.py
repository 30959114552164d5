"""Live triage events: contract, pseudonyms, exactly-once counters, reads."""
