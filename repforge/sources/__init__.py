"""Scans and readers (catalogue, data units, FASTA, corpus, tokens)."""
