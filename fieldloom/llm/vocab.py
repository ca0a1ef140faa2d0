"""Public tokenizers, loaded once a Python worker."""

from __future__ import annotations

import base64

import numpy as np


def _kept() -> dict:
    import tiktoken

    return vars(tiktoken).setdefault("_fieldloom_loaded", {})


def tiktoken_bpe(path: str | None = None):
    """Byte-level BPE from a rank file; by default the 50k vocabulary of the public tokenizers."""
    kept = _kept()
    if path not in kept:
        import public_tokenizers
        import tiktoken

        with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        kept[path] = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return kept[path]


def document_ids(json_path: str | None = None, ranks_path: str | None = None):
    """text -> uint32 ids as the tokenizers file gives them without added special tokens.

    The rank file holds the same vocabulary and is several times faster; a text
    that spells a special token goes through the tokenizers file itself.
    """
    bpe, kept = tiktoken_bpe(ranks_path), _kept()

    def encode(text: str) -> np.ndarray:
        if "<|" in text and "<|endoftext|>" in text:
            if ("json", json_path) not in kept:
                import public_tokenizers
                from tokenizers import Tokenizer

                kept["json", json_path] = Tokenizer.from_file(json_path or public_tokenizers.path("byte_bpe_50k.json"))
            return np.array(kept["json", json_path].encode(text, add_special_tokens=False).ids, "<u4")
        return np.array(bpe.encode_ordinary(text), "<u4")

    return encode
