"""Operators for text that a language model is trained on. Nothing outside this folder imports it."""
