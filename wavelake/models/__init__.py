"""Hooks for learned models and the closed-form layers around them; no weights are included."""
