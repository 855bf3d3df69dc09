"""Part of tidemark."""
