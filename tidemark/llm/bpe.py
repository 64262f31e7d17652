"""Byte-level BPE ids of whole texts, in batches.

A piece of text that the vocabulary's pattern cuts out is encoded once and then looked up by a
64-bit hash: the
cuts are found with array operations over code points, and only pieces not seen before go to the
tokenizer. Texts with characters whose class is not settled here, or with the string of a special
token, go to the tokenizer whole. Either way the ids are the tokenizer's own.
"""

from __future__ import annotations

import unicodedata
from itertools import chain

import numpy as np

from .arrays import span_hashes

DEFAULT = "byte_bpe_50k.json"
CACHE = 1 << 19  # pieces remembered by a task; then it starts afresh
_CHUNK = 1 << 19  # code points held as arrays at once
_LETTER, _NUMBER, _SPACE, _OTHER, _UNSETTLED = range(5)
_APOSTROPHE = ord("'")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(DEFAULT)


def _classes() -> np.ndarray:
    """Class of each code point: the blocks whose assignments are old and settled."""
    table = np.full(0x110000, _UNSETTLED, np.uint8)
    for c in [*range(0x0530), *range(0x2010, 0x2028), *range(0x2030, 0x205F), *range(0x20A0, 0x20B0), *range(0x4E00, 0x9F00), *range(0x3041, 0x3097), *range(0x30A1, 0x30FB), *range(0xAC00, 0xD7A4)]:
        kind = unicodedata.category(chr(c))
        if kind == "Cn":
            continue
        table[c] = _LETTER if kind[0] == "L" else _NUMBER if kind[0] == "N" else _OTHER
    table[[*range(9, 14), 32, 0x85, 0xA0]] = _SPACE
    table[0x1C:0x20] = _UNSETTLED  # separators on which pattern engines differ
    return table


class Encoder:
    """encode(texts) gives a flat array of ids and the number of ids of each text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [t.content for t in added]
        self.plain = self.tokenizer.pre_tokenizer is not None and _is_byte_level(path)
        self.classes = _classes()
        self.merger = _merger(path) if self.plain else None
        self._forget()

    def _forget(self):
        """Known pieces by hash (ascending), where their ids stand in ``flat`` and how many they are."""
        self.hashes, self.start, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _learn(self, hashes: np.ndarray, pieces: list[str]) -> None:
        if self.merger is not None:
            found = list(map(self.merger.encode_ordinary, pieces))
        else:
            found = [f.ids for f in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        size = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(found), np.uint32, int(size.sum()))
        start = len(self.flat) + np.cumsum(size) - size
        self.flat = np.concatenate([self.flat, ids])
        at = np.searchsorted(self.hashes, hashes)  # both ascend
        self.hashes, self.start, self.size = (
            np.insert(old, at, new)
            for old, new in ((self.hashes, hashes), (self.start, start), (self.size, size))
        )

    def _pieces(self, cp: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Starts of the pattern's pieces in the code points of several texts, none empty."""
        kind = self.classes[cp]
        n = len(cp)
        head = np.zeros(n, bool)
        head[offsets[:-1]] = True
        new = head.copy()
        new[1:] |= kind[1:] != kind[:-1]  # runs of one class
        blank = kind == _SPACE
        # A space joins the run after it: the last blank of a run starts a piece of its own ...
        last = np.zeros(n, bool)
        last[:-1] = blank[:-1] & ~blank[1:] & ~head[1:]
        starts = new | last
        # ... and takes the run after it along, if it is an ordinary space.
        after = np.flatnonzero(last) + 1
        starts[after[cp[after - 1] == 32]] = False
        # Apostrophes: 's 't 're 've 'm 'll 'd, where a piece may begin.
        at = np.flatnonzero(cp == _APOSTROPHE)
        if len(at):
            self._contractions(cp, kind, head, starts, at)
        return np.flatnonzero(starts)

    def _contractions(self, cp, kind, head, starts, at) -> None:
        n = len(cp)
        for i in at.tolist():
            if not starts[i]:
                continue  # inside a run of other signs, or taken along by a space
            if i + 1 >= n or head[i + 1]:
                continue
            one = chr(cp[i + 1])
            two = one + (chr(cp[i + 2]) if i + 2 < n and not head[i + 2] else "")
            length = 2 if two in ("re", "ve", "ll") else 1 if one in "stmd" else 0
            if not length:
                continue
            starts[i + 1 : i + 1 + length] = False
            if i + 1 + length < n:
                starts[i + 1 + length] = True

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the count per text."""
        out, counts, group, size = [], [], [], 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size >= _CHUNK:
                self._group(group, out, counts)
                group, size = [], 0
        if group:
            self._group(group, out, counts)
        return (np.concatenate(out) if out else np.zeros(0, np.uint32)), np.concatenate(counts or [np.zeros(0, np.int64)])

    def _group(self, texts: list[str], out: list, counts: list) -> None:
        raw = "".join(texts)
        cp = np.frombuffer(raw.encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        odd = np.flatnonzero(self.classes[cp] == _UNSETTLED) if self.plain else np.arange(len(cp))
        slow = np.zeros(len(texts), bool)
        slow[np.searchsorted(offsets, odd, "right") - 1] = True
        if any(s in raw for s in self.special):
            slow |= np.array([any(s in t for s in self.special) for t in texts])
        whole = {}
        if slow.any():
            index = np.flatnonzero(slow)
            found = self.tokenizer.encode_batch_fast([texts[i] for i in index], add_special_tokens=False)
            whole = {int(i): np.array(f.ids, np.uint32) for i, f in zip(index, found)}
            keep = [t for t, s in zip(texts, slow.tolist()) if not s]
            raw = "".join(keep)
            cp = np.frombuffer(raw.encode("utf-32-le", "surrogatepass"), np.uint32)
            lengths = np.where(slow, 0, lengths)
            offsets = np.concatenate([[0], np.cumsum(lengths)])
        fast, sizes = self._fast(raw, cp, offsets)
        if not whole:
            out.append(fast)
            counts.append(sizes)
            return
        ends = np.concatenate([[0], np.cumsum(sizes)])
        for i in range(len(texts)):
            ids = whole[i] if i in whole else fast[ends[i] : ends[i + 1]]
            out.append(ids)
            counts.append(np.array([len(ids)], np.int64))

    def _fast(self, raw: str, cp: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(cp):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        starts = self._pieces(cp, offsets[np.concatenate([[True], np.diff(offsets) > 0])] if len(offsets) > 1 else offsets)
        ends = np.concatenate([starts[1:], [len(cp)]])
        h = span_hashes(cp.astype(np.uint64) + np.uint64(1), starts, ends)
        unique, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        if len(self.hashes) > CACHE:
            self._forget()
        at = np.searchsorted(self.hashes, unique)
        new = np.ones(len(unique), bool)
        inside = at < len(self.hashes)
        new[inside] = self.hashes[at[inside]] != unique[inside]
        if new.any():
            pick = first[new]
            self._learn(unique[new], [raw[a:b] for a, b in zip(starts[pick].tolist(), ends[pick].tolist())])
            at = np.searchsorted(self.hashes, unique)
        known = at[inverse]
        size = self.size[known]
        upto = np.concatenate([[0], np.cumsum(size)])
        ids = self.flat[np.repeat(self.start[known] - upto[:-1], size) + np.arange(upto[-1])]
        per = upto[np.searchsorted(starts, offsets)]
        return ids, np.diff(per)


def _is_byte_level(path: str) -> bool:
    """Whether the vocabulary's pre-tokenizer is the byte-level pattern that is cut here."""
    import json

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    return (
        pre.get("type") == "ByteLevel"
        and not pre.get("add_prefix_space", False)
        and pre.get("use_regex", True)
        and not spec.get("normalizer")
    )


def _merger(path: str):
    """The same merges in a library that is quicker on single pieces, or None if ids are no ranks."""
    import json

    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
    hidden = [b for b in range(256) if b not in set(shown)]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    vocab = model["vocab"]
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    order = [vocab.get("".join(p), -1) for p in pairs]
    if order != sorted(order) or (order and order[0] < 0) or model.get("ignore_merges") or not set(byte) <= set(vocab):
        return None
    tokens = set(byte) | {"".join(p) for p in pairs}
    ranks = {bytes(byte[c] for c in t): vocab[t] for t in tokens}
    return tiktoken.Encoding("pieces", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process and vocabulary."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
