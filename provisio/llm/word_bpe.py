"""Exact, cached ids of a lower-case word BPE tokenizer file (``tokenizers`` JSON).

The file's own library normalises and aligns every character, which costs about a
second of CPU per 0.8 MB.  The ids of a text are the concatenation of the ids of its
pieces between blanks, because this tokenizer drops white space and no token spans it;
so each distinct piece is encoded once per worker and then looked up.  New pieces made
of ASCII or Latin-1 letters are encoded together by ``tiktoken`` with the file's own
merges; any other piece goes to ``tokenizers`` itself.  ``tests/llm`` compares the
result with ``tokenizers`` text by text.
"""

from __future__ import annotations

import json
import re

import numpy as np

_END, _SEP = "\x00", "\x01"           # end of a word; end of a piece
_LETTERS = "a-zß-öø-ÿœ"               # after lower-casing
_UNSAFE = re.compile(r"[^!-~À-ÖØ-öø-ÿœŒ\x01]|<\|")
#: fixed value: the tokenizer file's own pre-tokenizer, for the safe characters
_WORDS = re.compile(rf"('s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\s{_LETTERS}0-9\x01]+)")
_EXPECTED = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _byte_of() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the rest follow from U+0100."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = {chr(b): b for b in keep}, 0
    for b in range(256):
        if b not in keep:
            out[chr(256 + extra)] = b
            extra += 1
    return out


class WordBpe:
    """``ids(texts)`` gives each text's ids as little-endian uint32 bytes."""

    def __init__(self, path: str, max_cached: int = 1_000_000):
        from tokenizers import Tokenizer

        self.path, self.max_cached = path, max_cached
        self.slow = Tokenizer.from_file(path)
        self.cache: dict[str, bytes] = {"": b""}
        self.fast = self._fast()

    def _fast(self):
        """A tiktoken encoder with the same merges, or None if the file is of another kind."""
        import tiktoken

        with open(self.path, encoding="utf-8") as f:
            spec = json.load(f)
        model, vocab = spec["model"], spec["model"]["vocab"]
        if model.get("end_of_word_suffix") != "</w>" or _EXPECTED not in json.dumps(spec["pre_tokenizer"]).replace("\\\\", "\\"):
            return None
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        if any(vocab[a + b] != 512 + i for i, (a, b) in enumerate(merges)):
            return None
        byte, ranks = _byte_of(), {}
        specials = {t["content"] for t in spec["added_tokens"]}
        for token, i in vocab.items():
            if token in specials:
                continue
            body, end = (token[:-4], b"\x00") if token.endswith("</w>") else (token, b"")
            key = bytes(byte[c] for c in body)
            if end and (b"\x00" in key or b"\x01" in key):
                continue
            ranks[key + end] = i
        self.sep_id = ranks[b"\x01"]
        return tiktoken.Encoding("word_bpe", pat_str=r"[^\x00\x01]+\x00|\x01", mergeable_ranks=ranks, special_tokens={})

    def _learn(self, pieces: list[str]) -> None:
        if len(self.cache) > self.max_cached:
            self.cache = {"": b""}
        joined = _SEP.join(pieces)
        if not self.fast:
            quick = []
        elif _UNSAFE.search(joined) or joined.count(_SEP) != len(pieces) - 1:
            quick = [p for p in pieces if not _UNSAFE.search(p) and _SEP not in p]
            joined = _SEP.join(quick)
        else:
            quick = pieces
        if quick:
            marked = _WORDS.sub("\\1" + _END, joined.lower()) + _SEP
            ids = self.fast.encode_to_numpy(marked, disallowed_special=()).astype("<u4", copy=False)
            ends = (np.flatnonzero(ids == self.sep_id) * 4).tolist()
            raw = ids.tobytes()
            self.cache.update(zip(quick, [raw[a:b] for a, b in zip([0, *[e + 4 for e in ends]], ends)], strict=True))
        if len(quick) < len(pieces):
            for p in set(pieces).difference(quick):
                self.cache[p] = np.array(self.slow.encode(p, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def ids(self, texts: list[str | None], chars: int = 1_000_000) -> list[bytes]:
        out: list[bytes] = []
        at = 0
        while at < len(texts):
            split, n = [], 0
            while at < len(texts) and (not split or n < chars):
                t = texts[at] or ""
                split.append(t.replace("\n", " ").split(" "))
                n += len(t)
                at += 1
            words = set().union(*split)
            cache = self.cache
            if fresh := list(words.difference(cache)):
                self._learn(fresh)
                if self.cache is not cache:  # it was emptied: the rest of this slice is needed too
                    self._learn(list(words.difference(self.cache)))
            get = self.cache.__getitem__
            out.extend(b"".join(map(get, words)) for words in split)
        return out


_loaded: dict[str, WordBpe] = {}


def tokenizer(path: str) -> WordBpe:
    """One encoder per worker process."""
    if path not in _loaded:
        _loaded[path] = WordBpe(path)
    return _loaded[path]
