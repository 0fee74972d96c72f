"""Exact tokenisation of whole texts through caches of space-delimited chunks.

Both tokenizer families split a text before a space that follows a non-space character, whatever stands
around it, so the ids of a text are those of its chunks (``" word"``) joined.  Each Python worker keeps a
bounded cache from chunk to result; what the cache lacks is encoded at once for a text.  The library itself encodes
whole texts whose white space is not plain single spaces, and those that hold an added string of the vocabulary.
"""

from __future__ import annotations

import os

import numpy as np

#: Chunks that a worker's cache holds at most; later ones are encoded each time they occur.
CACHE_ENTRIES = 500_000


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable Latin-1 stands for itself, the rest follows from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteBpe:
    """A byte-level BPE tokenizer of the tokenizers library; fast paths only where they give the library's ids."""

    _open: dict[str, ByteBpe] = {}

    @classmethod
    def open(cls, path: str) -> ByteBpe:
        """One instance a Python worker."""
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def __init__(self, path: str):
        import json

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = [t["content"] for t in spec.get("added_tokens") or []]
        self.vocab = spec["model"]["vocab"]
        self.pieces = self._pieces(spec)
        self.size = self.library.get_vocab_size()

    def _pieces(self, spec):
        """A faster encoder of single chunks, where the vocabulary's ids are the merge ranks of plain byte-level BPE."""
        pre = spec.get("pre_tokenizer") or {}
        merges = [m if isinstance(m, list) else m.split(" ", 1) for m in spec["model"].get("merges", [])]
        self.pairs = merges
        in_order = all(self.vocab.get(a + b) == 256 + k for k, (a, b) in enumerate(merges))
        if spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not in_order:
            return None
        try:
            import public_tokenizers
            import tiktoken
        except ImportError:
            return None
        letters = byte_alphabet()
        ranks = {bytes(letters[c] for c in token): k for token, k in self.vocab.items() if token not in self.added}
        self.opens = np.zeros(1 + max(ranks.values()), bool)
        self.opens[[k for t, k in ranks.items() if t[:1] == b" "]] = True
        return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def merges(self) -> tuple[bytes, bytes, str] | None:
        """(left, right and joined id of each merge; ids of the 256 bytes, all as 32-bit integers; added strings), for plain byte-level vocabularies."""
        if self.pieces is None:
            return None
        letters = {b: c for c, b in byte_alphabet().items()}
        single = np.array([self.vocab[letters[b]] for b in range(256)], "<u4")
        return np.array([(self.vocab[a], self.vocab[b], self.vocab[a + b]) for a, b in self.pairs], "<u4").tobytes(), single.tobytes(), "\0".join(self.added)

    def ids(self, text: str) -> list[int]:
        """The library's ids of a whole text, its special strings handled as by default."""
        return self.library.encode(text, add_special_tokens=False).ids

    def words_ids(self, words: list[str]) -> list[bytes]:
        """The ids, as little-endian unsigned 32-bit integers, of the chunk ``" " + word`` of each word without an added string.

        Latin letters only for the fast encoder: other scripts' classes may differ by library version.
        """
        if self.pieces is None:
            return [self._packed(" " + w) for w in words]
        plain = [w for w in words if w.isascii() or max(w) <= "\u024f"]
        # Each chunk's first token, and no other, starts with the space.
        ids = np.array(self.pieces.encode_ordinary(" " + " ".join(plain)) if plain else [], "<u4")
        starts = np.flatnonzero(self.opens[ids]) * 4
        data, cuts = ids.tobytes(), [*starts.tolist(), len(ids) * 4]
        made = dict(zip(plain, (data[a:b] for a, b in zip(cuts, cuts[1:]))))
        return [made[w] if w in made else self._packed(" " + w) for w in words]

    def _packed(self, text: str) -> bytes:
        return np.array(self.ids(text), "<u4").tobytes()

    def holds_added(self, text: str) -> bool:
        return any(t in text for t in self.added)


class TextCoder:
    """Applies an encoder of words, of the chunk ``" " + word`` each, to whole texts: ``join(results)`` or ``whole(text)``.

    Results are truthy: a chunk has an id at least.  *apart* tells texts that only ``whole`` may encode.
    """

    def __init__(self, words, whole, join, apart=None, table: dict | None = None, entries: int = CACHE_ENTRIES):
        self.words, self.whole, self.join, self.apart, self.entries = words, whole, join, apart, entries
        self.cache = dict(table or {})

    def __call__(self, text: str):
        if self.apart and self.apart(text):
            return self.whole(text)
        first, *words = text.split(" ")
        found = [*map(self.cache.get, words)]
        if first and first[-1].isspace():
            return self.whole(text)
        if not all(found):
            missing = [*{w for w, f in zip(words, found) if not f}]
            if any(not w or w[-1].isspace() for w in missing):  # not plain single spaces
                return self.whole(text)
            made = dict(zip(missing, self.words(missing)))
            found = [f or made[w] for w, f in zip(words, found)]
            if len(self.cache) < self.entries:
                self.cache.update(made)
        return self.join([self.whole(first), *found] if first else found)
