"""Tables on a file system and the quarantine for bad rows."""
