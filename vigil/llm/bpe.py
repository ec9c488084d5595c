"""Byte-level BPE in a Python worker: exact ids of whole texts, and the rule
by which a text may be cut into words that are encoded one by one.

The tokenizer file is read where it lies (a parameter, never copied). Words
are merged by the ``tiktoken`` library when the file's merges rank like its
ids, which is checked on loading; texts with characters on which the two
libraries' patterns might differ, and texts with the special token, go whole
through ``tokenizers``."""

from __future__ import annotations

import functools
import json
import re

# Fixed value: the split pattern of byte-level BPE files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Characters on which the pattern engines are tested to agree (tests/llm).
ODD = re.compile("[^\t\n\r\x20-\x7e\xa1-\xac\xae-ſΑ-ΡΣ-ωЀ-ҁ"
                 "‐-‧€ぁ-ゖァ-ヺ一-龥가-힣]")

#: a space after white space: there a space is not a safe place to cut
LOOSE = ("  ", "\n ", "\t ", "\r ")

#: longest word that a worker keeps in its memo, and entries kept in all
MEMO_CHARS, MEMO_ENTRIES = 48, 400_000


def byte_letters() -> dict[str, int]:
    """Byte-level files write bytes as printable letters: printable Latin-1
    bytes stand for themselves, the others for 256, 257, ... in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    """One tokenizer file, ready to encode."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        self.specials = [t["content"] for t in data["added_tokens"]]
        letters = byte_letters()
        vocab = data["model"]["vocab"]
        special = set(self.specials)
        self.ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items() if t not in special}
        self.table = {i: b for b, i in self.ranks.items()}
        self.table |= {t["id"]: t["content"].encode() for t in data["added_tokens"]}
        made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in data["model"]["merges"]]
        self.ranked = all(a < b for a, b in zip(made, made[1:], strict=False))
        self._core = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=self.ranks,
                                       special_tokens={}) if self.ranked else None

    def plain(self, text: str) -> bool:
        """Only characters of the tested set and no special token."""
        return not ODD.search(text) and not any(s in text for s in self.specials)

    def word(self, text: str) -> list[int]:
        """Ids of a plain text."""
        if self._core is not None:
            return self._core.encode_ordinary(text)
        return self.lib.encode(text, add_special_tokens=False).ids

    def ids(self, text: str) -> list[int]:
        """Ids of any text, as ``tokenizers`` gives them."""
        return self.word(text) if self.plain(text) else self.lib.encode(text, add_special_tokens=False).ids

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token by its merges, lowest rank first."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], 1 << 60))
            pair = parts[best] + parts[best + 1]
            if pair not in self.ranks:
                break
            parts[best:best + 2] = [pair]
        return [self.ranks[p] for p in parts]

    def words(self, text: str) -> list[str] | None:
        """``text.split(" ")`` when every space may be cut before: each part
        after the first then stands for a space and itself. A space begins a
        pre-token unless white space stands on both sides of it. None: the
        text must be encoded whole."""
        if any(x in text for x in LOOSE) or not self.plain(text):
            return None
        return text.split(" ")


@functools.lru_cache(maxsize=4)
def load(path: str) -> Bpe:
    return Bpe(path)


class Memo(dict):
    """Values by word, made when first asked for; long words are not kept."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, word):
        value = self.make(word)
        if len(word) <= MEMO_CHARS:
            self[word] = value
        return value

    def trim(self):
        """Call between batches: bounds the memory."""
        if len(self) > MEMO_ENTRIES:
            self.clear()
