"""Whole texts to token ids of a byte-level BPE vocabulary file.

The file is one that the tokenizers library reads; the ids are the ones that library gives with
add_special_tokens=False and no truncation. The merging itself is left to tiktoken, several times
faster with the same ranks.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache

#: Fixed pattern of a byte-level pre-tokenizer with "use_regex".
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same where no two white-space characters meet; without look-ahead it runs nearly twice as fast.
SINGLE_SPACE_PATTERN = BYTE_LEVEL_PATTERN.replace(r"|\s+(?!\S)|\s+", r"|\s")
_MEETING_SPACES = re.compile(r"\s\s")
#: Runs of the pattern's white space (fixed values) too long for its engine, which runs out of stack.
LONG_RUN = 4096
_LONG_SPACES = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_RUN)


def byte_alphabet() -> dict[str, int]:
    """Character that stands for each byte in a byte-level vocabulary."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    table = {chr(b): b for b in shown}
    table.update({chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)})
    return table


class ByteEncoder:
    """Encodes one text after another; special tokens within a text count as such."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        kind, vocab = spec["pre_tokenizer"] or {}, spec["model"]["vocab"]
        if spec["normalizer"] or kind.get("type") != "ByteLevel" or kind["add_prefix_space"]:
            raise ValueError("a byte-level vocabulary without normalizer or prefix blank is needed")
        made = [vocab["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in spec["model"]["merges"]]
        if made != sorted(made):
            raise ValueError("ids must rise with the merge ranks")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        alphabet = byte_alphabet()
        ranks = {bytes(alphabet[c] for c in t): i for t, i in vocab.items() if t not in self.special}
        self.vocab_size = 1 + max([*ranks.values(), *self.special.values()])
        whole, single = (tiktoken.Encoding("vocabulary", pat_str=p, mergeable_ranks=ranks, special_tokens={}) for p in (BYTE_LEVEL_PATTERN, SINGLE_SPACE_PATTERN))
        self._any, self._single, self._piece = whole.encode_ordinary, single.encode_ordinary, whole._encode_single_piece
        self._split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self._split is not None and any(s in text for s in self.special):
            parts = self._split.split(text)
            return b"".join(self.special[p].to_bytes(4, "little") if k % 2 else self._segment(p) for k, p in enumerate(parts))
        return self._segment(text)

    def _segment(self, text: str) -> bytes:
        """A very long run of white space is merged as the one piece that the pattern makes of it: all of
        it at the end, all but its last character before other text."""
        out, at = [], 0
        if len(text) >= LONG_RUN:
            for run in _LONG_SPACES.finditer(text):
                end = run.end() - (run.end() < len(text))
                out += [self._plain(text[at : run.start()]), array("I", self._piece(text[run.start() : end])).tobytes()]
                at = end
        return b"".join([*out, self._plain(text[at:])]) if out else self._plain(text)

    def _plain(self, text: str) -> bytes:
        return array("I", (self._any if _MEETING_SPACES.search(text) else self._single)(text)).tobytes()


@lru_cache(maxsize=4)
def byte_encoder(path: str) -> ByteEncoder:
    """One encoder for each worker and vocabulary file."""
    return ByteEncoder(path)


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
