"""The idempotent append as a streaming sink."""
