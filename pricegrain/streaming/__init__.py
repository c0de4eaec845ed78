"""Streams: captures merged as they arrive, and windowed prices over an event stream."""
