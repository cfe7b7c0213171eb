"""Byte-pair encoding by batched numpy merge rounds, and decoding.

The new words of a batch lie as symbols in one flat array. In a round, the rank of each neighbouring
pair is found by binary search over sorted pair keys, and each word merges its pair of lowest rank.
Words without a pair to merge leave the array. Finished words are remembered per worker.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm._common import pieces, small_batches, text_or_empty
from textloom.llm.tokens import byte_alphabet

#: Remembered words in one Python worker, and their longest length; the store is emptied when it is full.
REMEMBERED, LONGEST = 300_000, 64
_NONE = np.iinfo(np.int32).max


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordBpe:
    """The vocabulary of a file: lower-cased words, byte-level symbols, a mark on a word's last symbol."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        model, split = made["model"], made["pre_tokenizer"]["pretokenizers"][0]
        if [x["type"] for x in made["normalizer"]["normalizers"]] != ["NFC", "Replace", "Lowercase"] or split["type"] != "Split" or made["decoder"] is not None:
            raise ValueError(f"not a word vocabulary of the kind that is read here: {path}")
        vocab, mark = model["vocab"], model["end_of_word_suffix"]
        special = {t["content"]: t["id"] for t in made["added_tokens"]}
        self.special = special
        self.cut = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.words = regex.compile(split["pattern"]["Regex"])
        self.tokens = [""] * (1 + max([*vocab.values(), *special.values()]))
        for token, i in (vocab | special).items():
            self.tokens[i] = token
        self.decimal = [str(i) for i in range(len(self.tokens))]
        alphabet = {b: c for c, b in byte_alphabet().items()}
        self.inner = np.array([vocab[alphabet[b]] for b in range(256)], np.int32)
        self.last = np.array([vocab[alphabet[b] + mark] for b in range(256)], np.int32)
        self.size = np.int64(len(self.tokens))
        keys = np.array([vocab[a] * int(self.size) + vocab[b] for a, b in model["merges"]], np.int64)
        merged = np.array([vocab[a + b] for a, b in model["merges"]], np.int32)
        # The lowest rank of a pair that a symbol takes part in: below the rank that makes the symbol, order matters inside a round.
        takes = np.full(len(self.tokens), _NONE, np.int64)
        ranks = np.arange(len(keys))
        np.minimum.at(takes, keys // self.size, ranks)
        np.minimum.at(takes, keys % self.size, ranks)
        self.alone = takes[merged] < ranks
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.merged = keys[order], order.astype(np.int32), merged
        self.known: dict[str, bytes] = {}

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE)

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each of these words, none of them empty."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths)
        data = np.frombuffer(b"".join(words), np.uint8)
        sym = self.inner[data]
        sym[ends - 1] = self.last[data[ends - 1]]
        word = np.repeat(np.arange(len(words)), lengths)
        rank = np.full(len(sym), _NONE, np.int32)
        inside = np.flatnonzero(word[:-1] == word[1:])
        rank[inside] = self._rank(sym[inside].astype(np.int64), sym[inside + 1])
        out: list[np.ndarray] = [None] * len(words)
        while len(sym):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            least = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.r_[starts, len(sym)])
            over = least == _NONE
            if over.any():
                for s, n, w in zip(starts[over].tolist(), sizes[over].tolist(), word[starts[over]].tolist()):
                    out[w] = sym[s : s + n]
                keep = np.repeat(~over, sizes)
                sym, word, rank = sym[keep], word[keep], rank[keep]
                least, sizes = least[~over], sizes[~over]
                if not len(sym):
                    break
            hit = np.flatnonzero(rank == np.repeat(least, sizes))
            run = np.r_[True, np.diff(hit) != 1]  # in "aaa" the pairs overlap: every second one of a run
            nth = np.arange(len(hit)) - np.flatnonzero(run)[np.cumsum(run) - 1]
            hit = hit[nth % 2 == 0]
            first = np.r_[True, word[hit[1:]] != word[hit[:-1]]]
            hit = hit[first | ~self.alone[rank[hit]]]
            sym[hit] = self.merged[rank[hit]]
            keep = np.ones(len(sym), bool)
            keep[hit + 1] = False
            hit = hit - np.arange(len(hit))
            sym, word, rank = sym[keep], word[keep], rank[keep]
            again = np.unique(np.r_[hit, np.maximum(hit - 1, 0)])
            pair = again[again + 1 < len(sym)]
            pair = pair[word[pair] == word[pair + 1]]
            rank[again] = _NONE
            rank[pair] = self._rank(sym[pair].astype(np.int64), sym[pair + 1])
        return out

    def _split(self, text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # lower() would look at what follows a sigma
        return self.words.findall(text.lower())

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts, as uint16 or uint32."""
        kind = np.uint16 if self.size <= 1 << 16 else np.uint32
        parts = []
        for text in texts:
            if self.cut is not None and "<|" in text:
                words: list = []
                for piece in self.cut.split(text):
                    words.extend([self.special[piece]] if piece in self.special else self._split(piece))
            else:
                words = self._split(text)
            parts.append(words)
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        new = list({w for words in parts for w in words if w not in known and not isinstance(w, int)})
        fresh = dict(zip(new, (x.astype(kind).tobytes() for x in self.merge([w.encode() for w in new])))) if new else {}
        known.update((w, x) for w, x in fresh.items() if len(w) <= LONGEST)
        for i in self.special.values():
            known[i] = np.array([i], kind).tobytes()
        return [np.frombuffer(b"".join([known[w] if w in known else fresh[w] for w in words]), kind) for words in parts]

    def decode(self, ids) -> str:
        """Without a decoder in the file, a text is its tokens with blanks between them."""
        return " ".join([self.tokens[i] for i in ids])


@lru_cache(maxsize=2)
def vocabulary(path: str) -> WordBpe:
    return WordBpe(path)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, digests: bool = False) -> DataFrame:
    """One row per document: id, ids (little-endian uint32), decoded text; with ``digests`` their count and hashes.

    A null or empty text has no ids and decodes to an empty text. Ids may be null or repeated, each row
    stands for itself; other columns are ignored. Encode and decode share one pass over the texts.
    """
    path = path or default_vocabulary()
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in pieces(batches):
            found = bpe.encode(batch.column(1).to_pylist())
            if not digests:
                columns = [pa.array([x.astype("<u4").tobytes() for x in found], pa.binary()), pa.array([bpe.decode(x.tolist()) for x in found], pa.string())]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", "ids", "decoded"])
                continue
            counts, of_ids, of_text = [], [], []
            for x in found:
                ids = x.tolist()
                counts.append(len(ids))
                of_ids.append(sha256(" ".join([bpe.decimal[i] for i in ids]).encode()).hexdigest())
                of_text.append(sha256(bpe.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    made = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "ids binary, decoded string"
    return rows.mapInArrow(run, f"id {kind}, {made}").withColumnRenamed("id", id_col)
