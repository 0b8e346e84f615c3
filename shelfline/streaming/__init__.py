"""Empty on purpose: every stage is a daily batch that overwrites its tables, so no query here is a stream."""
