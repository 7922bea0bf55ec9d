"""Where the registered queries find their tokenizer file."""

from __future__ import annotations


def byte_bpe_path() -> str:
    """Path of the byte-level vocabulary, looked up when a query runs."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
