"""Token ids of whole texts by a byte-level BPE file, as little-endian unsigned 32-bit ids.

A piece of the pre-tokenizer never crosses the point before a blank unless white space lies on both
sides of that blank, so a text is cut before blanks and each chunk is encoded once and remembered.
Texts in which that does not hold, or with the name of a special token, are encoded as a whole.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np

#: Remembered chunks in one Python worker; the store is emptied when it is full.
REMEMBERED = 250_000
_RUN = re.compile(r"\s (?:\s|\Z)")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class ChunkEncoder(dict):
    """Maps a chunk, without the blank before it, to the bytes of its ids."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.byte_level = self._byte_level()
        self.fast = self._fast() if self.byte_level else None

    def _byte_level(self) -> bool:
        import json

        made = json.loads(self.tokenizer.to_str())
        pre = made["pre_tokenizer"] or {}
        return made["normalizer"] is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")

    def _fast(self):
        """The same vocabulary and merges in the library that encodes one chunk with less overhead."""
        import json

        import public_tokenizers
        import tiktoken

        model = json.loads(self.tokenizer.to_str())["model"]
        alphabet = byte_alphabet()
        known = {bytes(alphabet[c] for c in token): i for token, i in model["vocab"].items()}
        by_id = sorted(known.items(), key=lambda x: x[1])
        if [i for _, i in by_id] != list(range(len(by_id))):
            return None
        # Ids must rise with the rank of the merge that makes them, or ranks would order merges otherwise.
        made = [known[bytes(alphabet[c] for c in "".join(m))] for m in model["merges"]]
        if any(a >= b for a, b in zip(made, made[1:])):
            return None
        return tiktoken.Encoding("chunks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={})

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def piece(self, text: str) -> bytes:
        if self.fast is not None and (text.isascii() or max(text) < "ɐ"):
            return np.asarray(self.fast.encode_ordinary(text), "<u4").tobytes()
        return self.whole(text)

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        ids = self.piece(" " + chunk)
        if len(chunk) < 64:
            self[chunk] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.byte_level or any(s in text for s in self.special):
            return self.whole(text)
        if _RUN.search(text):
            return self.piece(text)
        first, *rest = text.split(" ")
        return (self.piece(first) if first else b"") + b"".join(map(self.__getitem__, rest))


def byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of the 256 byte values in byte-level vocabularies, by character."""
    printable = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


@lru_cache(maxsize=4)
def encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)
