"""File-stream intake of staged runs."""
