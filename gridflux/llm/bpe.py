"""BPE encoding and decoding with a pair occurrence index.

The distinct words that a batch of documents brings are laid out one symbol after another. An index
maps each adjacent pair that has a rank to all places where it occurs. The ranks that occur are
applied in ascending order, each at all its places at once; the pairs that arise are added to their
ranks' lists. A worker keeps the ids of pieces between white space that it has seen, up to a fixed
number, so each is merged once.

Defined results. Null or empty text: no ids, and the empty text. Documents with equal ids are
separate rows; an empty table gives an empty result. Columns other than the id and the text are
not read.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridflux.llm.common import text_of
from gridflux.llm.tokens import byte_alphabet, vocabulary_path

MAX_PIECES = 500_000
#: Fixed pattern of the vocabulary's pre-tokenizer.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"
#: Characters at which str.split() cuts though they aren't white space in Unicode.
_SEPARATORS = re.compile("[\x1c-\x1f]")


class PairIndexBPE:
    """Word-level BPE with an end-of-word suffix, from a file of the tokenizers library."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or not end or model["ignore_merges"] or spec["decoder"]:
            raise ValueError("a word-level vocabulary with NFC, white space folding and lower case is needed")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in [*vocab.items(), *self.special.items()]}
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.size = 1 + max(self.tokens)
        self.left = np.array([vocab[a] for a, _ in merges], np.int64)
        self.right = np.array([vocab[b] for _, b in merges], np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)
        keys = self.left * self.size + self.right
        self._by_key = np.argsort(keys, kind="stable")
        self._keys = keys[self._by_key]
        shown = {b: c for c, b in byte_alphabet().items()}
        self._inner = np.array([vocab[shown[b]] for b in range(256)], np.int64)
        self._final = np.array([vocab[shown[b] + end] for b in range(256)], np.int64)
        self._words = regex.compile(WORD_PATTERN).findall
        self._white = regex.compile(r"\p{White_Space}+")
        self._split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self._seen: dict[str, bytes] = {}

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where it has none or a symbol is gone (negative)."""
        keys = left * self.size + right
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where((self._keys[at] == keys) & (left >= 0) & (right >= 0), self._by_key[at], -1)

    def merge_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word as little-endian unsigned 32-bit integers."""
        raw = [w.encode() for w in words]
        lengths = np.array([len(r) for r in raw], np.int64)
        ends = np.cumsum(lengths)
        n = int(ends[-1]) if len(ends) else 0
        if not n:
            return [b""] * len(words)
        data = np.frombuffer(b"".join(raw), np.uint8)
        symbol = np.full(n + 1, -1, np.int64)  # place n stands for "none"
        symbol[:n] = self._inner[data]
        symbol[ends[lengths > 0] - 1] = self._final[data[ends[lengths > 0] - 1]]
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[n] = n
        after[ends[lengths > 0] - 1] = n
        before[(ends - lengths)[lengths > 0]] = n
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def note(places: np.ndarray) -> None:
            ranks = self._ranks(symbol[places], symbol[after[places]])
            has = ranks >= 0
            ranks, places = ranks[has], places[has]
            if not len(ranks):
                return
            order = np.argsort(ranks, kind="stable")
            ranks, places = ranks[order], places[order]
            cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
            for a, b in zip(cuts, cuts[1:]):
                rank = int(ranks[a])
                if rank not in index:
                    index[rank] = []
                    heapq.heappush(active, rank)
                index[rank].append(places[a:b])

        note(np.arange(n))
        while active:
            rank = heapq.heappop(active)
            lists = index.pop(rank)
            places = np.unique(np.concatenate(lists)) if len(lists) > 1 else np.unique(lists[0])
            left, right = self.left[rank], self.right[rank]
            places = places[(symbol[places] == left) & (symbol[after[places]] == right)]
            if left == right and len(places) > 1:  # in a run of one symbol, the leftmost pairs merge
                kept, gone = [], -1
                for p, q in zip(places.tolist(), after[places].tolist()):
                    if p != gone:
                        kept.append(p)
                        gone = q
                places = np.array(kept, np.int64)
            if not len(places):
                continue
            second = after[places]
            follow = after[second]
            symbol[places] = self.made[rank]
            symbol[second] = -1
            after[places] = follow
            before[follow] = places
            ahead = before[places]
            note(np.concatenate([places[follow < n], ahead[ahead < n]]))
        alive = symbol[:n] >= 0
        ids = symbol[:n][alive].astype("<u4").tobytes()
        cuts = (4 * np.concatenate([[0], np.cumsum(alive)])[np.concatenate([[0], ends])]).tolist()
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]

    def _pieces(self, text: str) -> list[str]:
        text = unicodedata.normalize("NFC", text)
        pieces = self._white.sub(" ", text).split(" ") if _SEPARATORS.search(text) else text.split()
        return pieces if text.islower() and "Σ" not in text else [p.replace("Σ", "σ").lower() for p in pieces]

    def _segments(self, text: str) -> list[str]:
        """Text between special tokens at even places, special tokens at odd ones."""
        return self._split.split(text) if self._split is not None and any(s in text for s in self.special) else [text]

    def encode_many(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        new: set[str] = set()
        for text in texts:
            for segment in self._segments(text)[::2]:
                new.update(self._pieces(segment))
        if len(self._seen) + len(new) > MAX_PIECES:
            self._seen = {p: self._seen[p] for p in new & self._seen.keys()}
        fresh = list(new - self._seen.keys())
        cut = [self._words(p) for p in fresh]
        words = list({w for c in cut for w in c})
        ids = dict(zip(words, self.merge_words(words), strict=True))
        self._seen.update((p, ids[c[0]] if len(c) == 1 else b"".join([ids[w] for w in c])) for p, c in zip(fresh, cut, strict=True))
        known = self._seen.__getitem__
        for text in texts:
            parts = self._segments(text)
            yield b"".join(self.special[p].to_bytes(4, "little") if k % 2 else b"".join(map(known, self._pieces(p))) for k, p in enumerate(parts))

    def decode(self, ids: bytes) -> str:
        """The tokens' strings with blanks between; a file without decoder asks for no more."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def pair_index_bpe(path: str) -> PairIndexBPE:
    """One encoder for each worker and vocabulary file."""
    return PairIndexBPE(path)


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit integers) and the text decoded from them."""
    path = path or vocabulary_path("word_bpe_49k.json")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = pair_index_bpe(path)
        for batch in batches:
            texts = batch["text"].to_pylist()
            done = bpe.encode_many(texts)
            for at in range(0, len(texts), 500):
                ids = [next(done) for _ in texts[at : at + 500]]
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(at, 500), pa.array(ids, pa.binary()), pa.array(map(bpe.decode, ids), pa.string())], ["doc_id", "ids", "decoded"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text")).mapInArrow(encode, "doc_id long, ids binary, decoded string")


def encode_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the ids and of the decoded text, made beside the ids so
    that neither leaves its worker."""
    path = path or vocabulary_path("word_bpe_49k.json")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = pair_index_bpe(path)
        for batch in batches:
            n, of_ids, of_text = [], [], []
            for ids in bpe.encode_many(batch["text"].to_pylist()):
                n.append(len(ids) // 4)
                of_ids.append(sha256(ids).hexdigest())
                of_text.append(sha256(bpe.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text")).mapInArrow(digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
