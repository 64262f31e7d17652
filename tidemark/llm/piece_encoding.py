"""SentencePiece ids of whole texts by vectorised merge rounds, and their text again.

A text is cut wherever no piece of the vocabulary holds the two characters at the cut, so that no merge
can cross it. The distinct stretches of a batch become flat arrays of symbols that are merged together: in a
round each stretch takes its best-ranked pair, merges its places from the left, and the arrays are compacted.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .letters import chunks

DEFAULT = "piece_bpe_32k.model"
CACHE = 1 << 18  # stretches remembered by a task; then it starts afresh
_SPACE = "▁"
_REPLACEMENT = "�".encode()
_NONE = np.iinfo(np.int64).max
_SLOTS = 20  # bits of a pair's slot
_ODD = np.uint64(0x9E3779B97F4A7C15)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(DEFAULT)


def _fields(data: bytes):
    """(number, value) of the fields of one serialized message."""

    def varint(i: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[i] & 127) << shift
            shift += 7
            i += 1
            if data[i - 1] < 128:
                return value, i

    i = 0
    while i < len(data):
        key, i = varint(i)
        if key & 7 == 0:
            value, i = varint(i)
        else:
            size, i = varint(i) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], i)
            value, i = data[i : i + size], i + size
        yield key >> 3, value


class Pieces:
    """A BPE vocabulary with byte fallback: encode(texts) and decode(ids, counts)."""

    # Field numbers and defaults of the model file.
    TRAINER, NORMALIZER = 2, 3
    MODEL_TYPE, BPE = 3, 2
    NAME, DUMMY_PREFIX, EXTRA_SPACES, ESCAPE = 1, 3, 4, 5

    def __init__(self, path: str):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = defaultdict(dict)
        for number, value in _fields(library.serialized_model_proto()):
            if number in (self.TRAINER, self.NORMALIZER):
                spec[number] = dict(_fields(value))
        norm = spec[self.NORMALIZER]
        size = library.get_piece_size()
        ids = range(size)
        self.end, self.unknown = library.eos_id(), library.unk_id()
        self.dummy = bool(norm.get(self.DUMMY_PREFIX, 1))
        self.byte_ids = np.array([library.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int64)
        if (
            spec[self.TRAINER].get(self.MODEL_TYPE, 1) != self.BPE
            or norm.get(self.NAME) != b"identity"
            or norm.get(self.EXTRA_SPACES, 1)
            or not norm.get(self.ESCAPE, 1)
            or any(library.is_unused(i) for i in ids)
            or not all(library.is_byte(int(i)) for i in self.byte_ids)
        ):
            raise ValueError("only BPE models with byte fallback and identity normalisation, without unused pieces, are read")
        plain = [i for i in ids if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i))]
        names = {library.id_to_piece(i): i for i in plain}
        letters = sorted(set(chain.from_iterable(names)))
        symbol = {**names, **{c: size + k for k, c in enumerate(c for c in letters if c not in names)}}
        self.size = size
        # Pairs of symbols that make a piece: the piece and its rank by score.
        rank = {score: r for r, score in enumerate(sorted({library.get_score(i) for i in plain}, reverse=True))}
        pairs = sorted(
            (symbol[name[:k]], symbol[name[k:]], i, rank[library.get_score(i)])
            for name, i in names.items() for k in range(1, len(name)) if name[:k] in symbol and name[k:] in symbol
        )
        left, right, self.made, self.rank = np.array(pairs, np.int64).reshape(-1, 4).T.copy()
        self.width = size + len(letters) + 1
        self.keys = left * self.width + right
        self._slots()
        made = {}
        for _, _, i, r in pairs:
            made.setdefault(r, set()).add(i)
        self.shared = np.zeros(len(rank), bool)  # ranks of several pieces
        self.shared[[r for r, own in made.items() if len(own) > 1]] = True
        # Characters by number, and which of them stand side by side within a piece.
        self.number = np.zeros(0x110000, np.int32)
        self.number[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.beside = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        for name in names:
            at = self.number[[ord(c) for c in name]]
            self.beside[at[:-1], at[1:]] = True
        self.symbol = np.array([-1, *(symbol[c] for c in letters)], np.int64)
        # What each id decodes to.
        surface = [library.id_to_piece(i).replace(_SPACE, " ").encode() for i in ids]
        for b, i in enumerate(self.byte_ids.tolist()):
            surface[i] = bytes([b])
        for i in ids:
            if library.is_control(i):
                surface[i] = b""
            elif library.is_unknown(i):
                surface[i] = library.decode([i]).encode()
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.bounds = np.concatenate([[0], np.cumsum([len(s) for s in surface])])
        self.is_byte = np.zeros(size, bool)
        self.is_byte[self.byte_ids] = True
        self.leads = np.zeros(size, bool)  # pieces that begin with a blank
        self.leads[[i for name, i in names.items() if name.startswith(_SPACE)]] = True
        self.silent = np.array([not s for s in surface])
        self._forget()

    def _slots(self) -> None:
        """Where each pair stands in ``keys``: by its hash, or in the next free slot after it."""
        self.bits = max(_SLOTS, int(len(self.keys)).bit_length() + 2)
        self.slot_key = np.full((1 << self.bits) + len(self.keys), -1, np.int64)
        self.slot_at = np.zeros(len(self.slot_key), np.int32)
        for i, (key, slot) in enumerate(zip(self.keys.tolist(), self._hash(self.keys).tolist())):
            while self.slot_key[slot] >= 0:
                slot += 1
            self.slot_key[slot], self.slot_at[slot] = key, i

    def _hash(self, key: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((key.astype(np.uint64) * _ODD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _forget(self):
        self.known: dict[str, int] = {}
        self.seen: dict[tuple[int, int], tuple[int, int]] = {}
        self.flat, self.upto = np.zeros(0, np.int32), np.zeros(1, np.int64)

    # -- merging ---------------------------------------------------------------------------

    def _pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of adjacent symbols; no rank if they make none."""
        key = np.where((left >= 0) & (right >= 0), left * self.width + right, -2)
        slot = self._hash(key)
        there = self.slot_key[slot]
        open_ = np.flatnonzero((there != key) & (there >= 0))
        while len(open_):
            slot[open_] += 1
            there[open_] = self.slot_key[slot[open_]]
            open_ = open_[(there[open_] != key[open_]) & (there[open_] >= 0)]
        rank, made = np.full(len(key), _NONE), np.full(len(key), -1, np.int64)
        hit = np.flatnonzero(there == key)
        at = self.slot_at[slot[hit]]
        rank[hit], made[hit] = self.rank[at], self.made[at]
        return rank, made

    def merge(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merged symbols of all words and their number per word; words stand one after another, none empty.

        The library merges one pair at a time, the best score first, then the leftmost. A round does the same
        merges: those of a word's best rank, from the left, up to the first whose new symbol makes a
        pair of the same rank or a better one with a neighbour. Words whose best rank belongs to several
        pieces (runs of blanks) would take a round a merge; they are finished by an ordered agenda instead.
        """
        out: list = [None] * len(sizes)
        word = np.arange(len(sizes))
        start = np.concatenate([[0], np.cumsum(sizes)])
        rank, made = np.full(len(symbols), _NONE), np.full(len(symbols), -1, np.int64)  # of each symbol with the next
        rank[:-1], made[:-1] = self._pair(symbols[:-1], symbols[1:])
        rank[start[1:] - 1] = _NONE
        while len(word):
            best = np.minimum.reduceat(rank, start[:-1])
            live = best != _NONE
            live[live] = ~self.shared[best[live]]
            if not live.all():
                for i in np.flatnonzero(~live).tolist():
                    own = symbols[start[i] : start[i + 1]]
                    out[word[i]] = own if best[i] == _NONE else np.array(self._agenda(own.tolist()), np.int64)
                stay = np.repeat(live, sizes)
                symbols, rank, made = symbols[stay], rank[stay], made[stay]
                word, sizes, best = word[live], sizes[live], best[live]
                start = np.concatenate([[0], np.cumsum(sizes)])
                if not len(word):
                    break
            n = len(symbols)
            own = np.repeat(np.arange(len(sizes)), sizes)
            at = np.flatnonzero(rank == best[own])
            # Of overlapping places every second one, from the left.
            fresh = np.ones(len(at), bool)
            fresh[1:] = np.diff(at) != 1
            head = np.flatnonzero(fresh)
            at = at[(np.arange(len(at)) - head[np.cumsum(fresh) - 1]) % 2 == 0]
            new, mine = made[at], own[at]
            # Pairs of each new symbol with what stands beside it when it is made.
            joined = np.zeros(len(at), bool)
            joined[1:] = (np.diff(at) == 2) & (mine[1:] == mine[:-1])
            before = np.where(at > start[mine], symbols[at - 1], -1)
            before[joined] = new[:-1][joined[1:]]
            after = np.where(at + 2 < start[mine + 1], symbols[np.minimum(at + 2, n - 1)], -1)
            stop = np.minimum(self._pair(before, new)[0], self._pair(new, after)[0]) <= best[mine]
            if stop.any():
                passed = np.cumsum(stop) - stop
                first = np.concatenate([[True], mine[1:] != mine[:-1]])
                take = passed == passed[np.flatnonzero(first)[np.cumsum(first) - 1]]
                at, new, mine = at[take], new[take], mine[take]
            symbols[at] = new
            stay = np.ones(n, bool)
            stay[at + 1] = False
            place = np.cumsum(stay) - 1
            symbols, rank, made = symbols[stay], rank[stay], made[stay]
            sizes = sizes - np.bincount(mine, minlength=len(sizes))
            start = np.concatenate([[0], np.cumsum(sizes)])
            # Only pairs beside a new symbol change.
            at = place[at]
            rank[at] = _NONE
            changed = np.zeros(len(symbols), bool)
            changed[at] = True
            changed[at[at > 0] - 1] = True
            changed[start[1:] - 1] = False
            changed = np.flatnonzero(changed)
            rank[changed], made[changed] = self._pair(symbols[changed], symbols[changed + 1])
        return np.concatenate(out), np.fromiter(map(len, out), np.int64, len(out))

    def _one(self, left: int, right: int) -> tuple[int, int]:
        if (left, right) not in self.seen:
            rank, made = self._pair(np.array([left]), np.array([right]))
            self.seen[left, right] = int(rank[0]), int(made[0])
        return self.seen[left, right]

    def _agenda(self, symbols: list[int]) -> list[int]:
        """Merge one word pair by pair, best rank first, then leftmost."""
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank, made = self._pair(np.array(symbols[:-1], np.int64), np.array(symbols[1:], np.int64))
        agenda = [(r, i, symbols[i], symbols[i + 1], m) for i, (r, m) in enumerate(zip(rank.tolist(), made.tolist())) if m >= 0]
        heapq.heapify(agenda)
        while agenda:
            _, i, left, right, new = heapq.heappop(agenda)
            j = after[i] if symbols[i] is not None else n
            if j >= n or symbols[i] != left or symbols[j] != right:
                continue
            symbols[i], symbols[j], after[i] = new, None, after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n:
                    r, m = self._one(symbols[a], symbols[b])
                    if m >= 0:
                        heapq.heappush(agenda, (r, a, symbols[a], symbols[b], m))
        return [s for s in symbols if s is not None]

    def _learn(self, words: list[str]) -> None:
        """Encode words not seen before and remember them, in the order of their numbers."""
        cp = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        symbols, sizes = self.merge(self.symbol[self.number[cp]], sizes)
        # Symbols that are no piece become the bytes of their characters; unknown ones stand for themselves.
        odd = (symbols < 0) | (symbols >= self.size)
        if odd.any():
            symbols, sizes = self._bytes(words, symbols, sizes, odd)
        self.flat = np.concatenate([self.flat, symbols.astype(np.int32)])
        self.upto = np.concatenate([self.upto, self.upto[-1] + np.cumsum(sizes)])

    def _bytes(self, words, symbols, sizes, odd) -> tuple[np.ndarray, np.ndarray]:
        start = np.concatenate([[0], np.cumsum(sizes)])
        out = np.split(symbols, start[1:-1])
        for i in np.unique(np.searchsorted(start, np.flatnonzero(odd), "right") - 1).tolist():
            at, made = 0, []
            for s in out[i].tolist():
                if 0 <= s < self.size:
                    made.append(s)
                    at += self._letters(s)
                else:
                    made += self.byte_ids[list(words[i][at].encode())].tolist()
                    at += 1
            out[i] = np.array(made, np.int64)
        return np.concatenate(out), np.fromiter(map(len, out), np.int64, len(out))

    def _letters(self, piece: int) -> int:
        return len(bytes(self.surface[self.bounds[piece] : self.bounds[piece + 1]]).decode())

    # -- texts -----------------------------------------------------------------------------

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, each with the end id, and their number per text."""
        out, counts = [], []
        shown = [((_SPACE if self.dummy else "") + t).replace(" ", _SPACE) if t else "" for t in texts]
        for first, last, cp, offsets in chunks(shown):
            number = self.number[cp]
            cut = np.ones(len(cp), bool)
            cut[1:] = ~self.beside[number[:-1], number[1:]]
            cut[offsets[:-1][offsets[:-1] < len(cp)]] = True
            starts = np.flatnonzero(cut)
            raw = "".join(shown[first:last])
            bounds = [*starts.tolist(), len(cp)]
            words = [raw[a:b] for a, b in zip(bounds, bounds[1:])]
            if len(self.known) > CACHE:
                self._forget()
            fresh = list(set(words).difference(self.known))
            if fresh:
                self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh))))
                self._learn(fresh)
            at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
            sizes = self.upto[at + 1] - self.upto[at]
            upto = np.concatenate([[0], np.cumsum(sizes)])
            ids = self.flat[np.arange(upto[-1]) + np.repeat(self.upto[at] - upto[:-1], sizes)]
            ends = upto[np.searchsorted(starts, offsets)]
            out.append(np.insert(ids, ends[1:], self.end))
            counts.append(np.diff(ends) + 1)
        return (np.concatenate(out) if out else np.zeros(0, np.int32)), np.concatenate(counts or [np.zeros(0, np.int64)])

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The text of each row of ids: bytes gathered at once, without the blank put before the text."""
        start = np.concatenate([[0], np.cumsum(counts)])
        if len(ids) and not (0 <= ids.min() and ids.max() < self.size):
            raise ValueError("an id is not in the vocabulary")
        first, size = self.bounds[ids], self.bounds[ids + 1] - self.bounds[ids]
        if self.dummy and len(ids):
            said = np.flatnonzero(~self.silent[ids])
            row = np.searchsorted(start, said, "right") - 1
            lead = said[np.concatenate([[True], row[1:] != row[:-1]])[: len(said)]]
            lead = lead[self.leads[ids[lead]]]
            first[lead] += 1
            size[lead] -= 1
        upto = np.concatenate([[0], np.cumsum(size)])
        data = self.surface[np.arange(upto[-1]) + np.repeat(first - upto[:-1], size)].tobytes()
        out = []
        for i, (a, b) in enumerate(zip(upto[start[:-1]].tolist(), upto[start[1:]].tolist())):
            try:
                out.append(data[a:b].decode())
            except UnicodeDecodeError:
                own = slice(int(start[i]), int(start[i + 1]))
                out.append(self._mended(data, ids[own], upto[own], size[own]))
        return out

    def _mended(self, data: bytes, ids: np.ndarray, at: np.ndarray, size: np.ndarray) -> str:
        """Text of ids whose byte pieces are no UTF-8: each byte that cannot be read becomes U+FFFD."""
        out, part = [], b""

        def flush(part: bytes) -> None:
            while part:
                try:
                    out.append(part.decode())
                    return
                except UnicodeDecodeError as exc:
                    out.append(part[: exc.start].decode() + _REPLACEMENT.decode())
                    part = part[exc.start + 1 :]

        for i, a, n in zip(ids.tolist(), at.tolist(), size.tolist()):
            if self.is_byte[i]:
                part += data[a : a + n]
                continue
            flush(part)
            part = b""
            out.append(data[a : a + n].decode())
        flush(part)
        return "".join(out)


_pieces: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """One per worker process and vocabulary."""
    if path not in _pieces:
        _pieces[path] = Pieces(path)
    return _pieces[path]


_ROWS = 1000  # rows whose ids are held at once


def _encode(path: str, decoded: bool):
    def go(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, _ROWS):
                part = batch.slice(k, _ROWS)
                ids, counts = pieces(path).encode([t or "" for t in part.column("text").to_pylist()])
                ends = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
                columns = [part.column("doc_id"), pa.ListArray.from_arrays(ends, pa.array(ids, pa.int32()))]
                if decoded:
                    columns.append(pa.array(pieces(path).decode(ids, counts), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"][: len(columns)])

    return go


def encode(docs: DataFrame, tokenizer: str | None = None, with_decoded: bool = False) -> DataFrame:
    """doc_id, ids (array<int>, the end id last) of every whole text; ``with_decoded`` adds the text of the ids.

    Ids are those of the library for the same model. Null and empty texts give the end id alone, which decodes to
    an empty text. Repeated rows and null ids are returned as they are; nothing is shuffled. A stretch of
    characters that cannot be cut takes as many rounds as it has distinct merges.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _encode(tokenizer or default_path(), with_decoded),
        "doc_id long, ids array<int>" + (", decoded string" if with_decoded else ""),
    )


def _decode(path: str, column: str):
    def go(batches):
        for batch in batches:
            lists = batch.column(column)
            counts = np.array(lists.value_lengths().fill_null(0), np.int64)
            ids = np.array(lists.flatten().fill_null(pieces(path).unknown), np.int64)
            columns = [batch.column(c) for c in batch.schema.names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(pieces(path).decode(ids, counts), pa.string())], names=[*batch.schema.names, "decoded"]
            )

    return go


def decode(rows: DataFrame, column: str = "ids", tokenizer: str | None = None) -> DataFrame:
    """``rows`` with ``decoded``, the text of the ids in ``column``; a former ``decoded`` goes.

    Control ids say nothing, a null id counts as unknown, bytes that are no UTF-8 become U+FFFD, and an id
    outside the vocabulary raises. Null and empty lists decode to an empty text.
    """
    kept = rows.drop("decoded").withColumn(column, F.col(column).cast("array<int>"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(_decode(tokenizer or default_path(), column), f"{fields}, decoded string")
