"""Operators of a training-data pipeline (fingerprints, chat formatting, token
rollups, mixing, SentencePiece, quality rules, SimHash, LM scores, quality
classifier, token files).  Nothing outside this subpackage imports it."""
