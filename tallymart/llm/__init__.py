"""Operators of a training-data pipeline: search, language id, token files,
quality rules, token counts, secret scans, near duplicates, byte-level BPE,
language-model scores and source mixing."""
