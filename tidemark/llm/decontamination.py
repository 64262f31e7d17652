"""Benchmark passages in documents: q-gram counts in diagonal bands, then banded alignment.

Texts and items are folded: lower-case letters and digits, everything else one blank. An item of m
characters has an edit budget k = floor(rate * m). By the q-gram lemma a place in a document
that matches it within k edits shares at least m + 1 - q * (k + 1) of the item's q-grams with it,
and they lie on diagonals (document position minus item position) that differ by at most k. So the
hits of an item are counted in overlapping bands of diagonals, each 2k + 1 wide and starting every
k + 1, so that any k + 1 neighbouring diagonals lie in one band whole. Bands with
enough hits are verified by a banded alignment of the whole item; all else cannot match.

q is chosen per item: the largest up to 8 for which the lemma filters at the item's full budget. Items whose
beginning many share (a common stem) hit every place of that stem; such hits are counted for some items at a
time, and the bands they leave are first tried together by bit-parallel columns.
"""

from __future__ import annotations

from bisect import bisect
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .arrays import combine
from .letters import chunks, fold_table

Q = 8
SHORT = 4  # characters of the grams that regions of many bands are counted by once more
RATE = 0.1
HITS = 1 << 21  # hits counted at once, but for one item
TOGETHER = 1 << 13  # bands tried at once, by words of 64 characters
GROUP_BYTES = 8 << 20  # folded benchmark text in one broadcast; more items go in further groups
_FILTER_BITS, _COUNTER_BITS = 22, 20
_NAMES = ["doc_id", "item_id", "start", "end", "distance", "item_length"]
_OUT = ", ".join(f"{n} long" for n in _NAMES)


def _fold(cp: np.ndarray, offsets: np.ndarray):
    """Folded characters with runs of other signs as one blank, their source positions, new offsets."""
    folded = fold_table(True)[cp]
    n = len(folded)
    head = np.zeros(n + 1, bool)
    head[offsets] = True
    keep = folded != 0
    keep[1:] |= (folded[:-1] != 0) & ~head[1:n]  # the first other sign after a letter
    at = np.flatnonzero(keep)
    out = folded[at]
    out[out == 0] = 32
    return out, at, np.searchsorted(at, offsets)


def fold_text(text: str) -> str:
    """The folded form of one text, without outer blanks."""
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(cp):
        return ""
    out, _, _ = _fold(cp, np.array([0, len(cp)]))
    return out.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").strip()


def threshold(m: int, k: int, q: int) -> int:
    """q-grams that a match of m characters within k edits shares at least."""
    return m + 1 - q * (k + 1)


def _width(m: int, rate: float, q: int) -> int:
    """The largest gram of at most ``q`` characters that filters an item of m at its whole budget."""
    return min(q, m // (int(rate * m) + 1))


def _positions(codes: np.ndarray) -> dict[int, int]:
    """Per character a bit set of its places."""
    out: dict[int, int] = {}
    for i, c in enumerate(codes.tolist()):
        out[c] = out.get(c, 0) | 1 << i
    return out


def _within(sets: dict[int, int], m: int, text: np.ndarray, k: int) -> bool:
    """Whether some part of ``text`` is within k edits of the item (bit-parallel columns, Myers 1999)."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    for c in text.tolist():
        eq = sets.get(c, 0)
        x = eq | down
        d = ((((eq & up) + up) ^ up) | x) & full
        rise = down | (full & ~(d | up))
        fall = up & d
        score += bool(rise & top) - bool(fall & top)
        rise, fall = rise << 1 & full, fall << 1 & full
        up = fall | (full & ~(d | rise))
        down = rise & d
        if score <= k:
            return True
    return False


def _any_within(bits: np.ndarray, rows: np.ndarray, m: np.ndarray, windows: np.ndarray, k: np.ndarray) -> np.ndarray:
    """``_within`` for many items at once.

    bits[item, sign, word] are 64-bit words of the places of each sign in each item; rows name the
    item of a pair, windows[column, pair] the signs of its text, m and k its length and budget.
    """
    n, words = len(rows), bits.shape[2]
    one, last = np.uint64(1), np.uint64(63)
    full = np.full((words, n), ~np.uint64(0))
    up, down = full.copy(), np.zeros((words, n), np.uint64)
    top_word, top_bit = (m - 1) // 64, ((m - 1) % 64).astype(np.uint64)
    pair = np.arange(n)
    score, found = m.copy(), np.zeros(n, bool)
    with np.errstate(over="ignore"):
        for signs in windows:
            eq_all = bits[rows, signs].T
            carry = rise_in = fall_in = np.zeros(n, np.uint64)
            rises, falls = np.empty_like(up), np.empty_like(up)
            for w in range(words):
                eq, u, d = eq_all[w], up[w], down[w]
                x = eq | d
                a = eq & u
                part = a + u
                total = part + carry
                carry = ((part < a) | (total < part)).astype(np.uint64)
                diagonal = (total ^ u) | x
                rises[w] = rise = d | ~(diagonal | u)
                falls[w] = fall = u & diagonal
                rise, rise_in = (rise << one) | rise_in, rise >> last
                fall, fall_in = (fall << one) | fall_in, fall >> last
                up[w] = fall | ~(diagonal | rise)
                down[w] = rise & diagonal
            score += ((rises[top_word, pair] >> top_bit) & one).astype(np.int64)
            score -= ((falls[top_word, pair] >> top_bit) & one).astype(np.int64)
            found |= score <= k
    return found


class _Items:
    """Folded items of one group and one q: their q-grams as sorted hashes with item and position."""

    def __init__(self, rows: list[tuple[int, str]], q: int, rate: float):
        self.q, self.ids, self.codes, self.k = q, [], [], []
        grams, owner, place = [], [], []
        for item_id, text in rows:
            codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
            k = int(rate * len(codes))
            h = combine(codes.astype(np.uint64), q, 5)
            grams.append(h)
            owner.append(np.full(len(h), len(self.ids)))
            place.append(np.arange(len(h)))
            self.ids.append(item_id)
            self.codes.append(codes)
            self.k.append(k)
        none = np.zeros(0, np.int64)
        h = np.concatenate(grams or [none.view(np.uint64)])
        order = np.argsort(h, kind="stable")
        self.h = h[order]
        self.owner = np.concatenate(owner or [none])[order]
        self.place = np.concatenate(place or [none])[order]
        self.k = np.array(self.k, np.int64)
        self.longest = max(map(len, self.codes), default=0)
        self.need = np.array([threshold(len(c), k, q) for c, k in zip(self.codes, self.k)], np.int64)
        slot = (self.h >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[slot] = True
        self.first = np.searchsorted(slot, np.arange((1 << _FILTER_BITS) + 1)).astype(np.int32)
        self.owner, self.place = self.owner.astype(np.int32), self.place.astype(np.int32)
        self.inverse = 1.0 / (self.k + 1)
        self.short: dict[int, np.ndarray] = {}
        self.sets = [_positions(c) for c in self.codes]

    def bands(self, text: np.ndarray, offsets: np.ndarray):
        """(row, item, least diagonal) of every band worth an alignment; diagonals within the chunk."""
        g = combine(text.astype(np.uint64), self.q, 5)
        slot = (g >> np.uint64(64 - _FILTER_BITS)).astype(np.int32)
        at = np.flatnonzero(self.filter[slot]).astype(np.int32)
        slot = slot[at]
        lo = self.first[slot]
        n = self.first[slot + 1] - lo
        if n.sum(dtype=np.int64) <= HITS:
            yield from self._likely(text, offsets, self._banded(self.h, self.owner, self.place, g, at, lo, n, offsets))
            return
        # A gram that many items share: exact counts per item, then ranges of items with few hits each.
        left, right = np.searchsorted(self.h, g[at], "left"), np.searchsorted(self.h, g[at], "right")
        use = right > left
        at, left, right = at[use], left[use], right[use]
        times = np.zeros(len(self.h) + 1, np.int64)
        np.add.at(times, left, 1)
        np.add.at(times, right, -1)
        hits = np.bincount(self.owner, np.cumsum(times[:-1]), len(self.ids)).astype(np.int64)
        part = (np.cumsum(hits) - hits) // HITS
        own = part[self.owner]
        for p in np.unique(part[hits > 0]).tolist():
            mine = np.flatnonzero(own == p)
            h = self.h[mine]
            left, right = np.searchsorted(h, g[at], "left"), np.searchsorted(h, g[at], "right")
            found = self._banded(h, self.owner[mine], self.place[mine], g, at, left, right - left, offsets)
            yield from self._likely(text, offsets, found)

    def _banded(self, hashes, owner, place, g, at, lo, n, offsets):
        """Bands with enough hits, of the grams lo .. lo + n - 1 that the places ``at`` may hold."""
        pick = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()), dtype=np.int32)
        pos = np.repeat(at, n)
        same = hashes[pick] == g[pos]
        if not same.all():
            pick, pos = pick[same], pos[same]
        item = owner[pick]
        # A band starts every k + 1 diagonals and is 2k + 1 wide: a diagonal lies in at most two.
        shifted = pos - place[pick] + self.longest  # none is negative
        band = ((shifted + 0.5) * self.inverse[item]).astype(np.int32)
        # Counters that several bands may share never count too little: most bands end here.
        code = item * np.int32(40503) + band
        mask = np.int32((1 << _COUNTER_BITS) - 1)
        one, two = code & mask, (code - 1) & mask
        counter = np.bincount(one, minlength=1 << _COUNTER_BITS)
        counter += np.bincount(two, minlength=1 << _COUNTER_BITS)
        need = self.need[item]
        some = np.flatnonzero((counter[one] >= need) | (counter[two] >= need))
        return self._counted(pos[some].astype(np.int64), item[some].astype(np.int64), shifted[some].astype(np.int64),
                             band[some].astype(np.int64), offsets)

    def _counted(self, pos, item, shifted, band, offsets):
        row = np.searchsorted(offsets, pos, "right") - 1
        step = self.k[item] + 1
        inside = (band >= 1) & (shifted - (band - 1) * step < 2 * step - 1)
        bands, n = int(band.max(initial=0)) + 1, len(self.ids)
        key = (row * n + item) * bands + band
        key, group = np.unique(np.concatenate([key, key[inside] - 1]), return_inverse=True)
        if not len(key):
            return np.zeros((0, 3), np.int64)
        of = np.stack([key // (n * bands), key // bands % n, key % bands], 1)
        need, k = self.need[of[:, 1]], self.k[of[:, 1]]
        # Hits of one document place count once per band, and a match's hits lie on k + 1 diagonals.
        span = int(pos.max()) + 1
        place = np.sort(group * span + np.concatenate([pos, pos[inside]]))
        places = np.bincount(place[np.flatnonzero(np.diff(place, prepend=-1))] // span, minlength=len(key))
        span = int(shifted.max()) + int(k.max()) + 2
        flat = np.sort(group * span + np.concatenate([shifted, shifted[inside]]))
        start = np.searchsorted(flat, np.arange(len(key)) * span)
        close = np.searchsorted(flat, flat + np.repeat(k, np.diff(start, append=len(flat))), "right") - np.arange(len(flat))
        ok = (places >= need) & (np.maximum.reduceat(close, start) >= need)
        return np.stack([of[ok, 0], of[ok, 1], of[ok, 2] * (k[ok] + 1) - self.longest], 1)

    def _likely(self, text: np.ndarray, heads: np.ndarray, found: np.ndarray) -> list:
        """Of many bands, those in whose surroundings some part of the row is within the item's budget.

        Few bands are returned as they are.
        """
        if len(found) < 64:
            return found.tolist()
        row, item, low = found.T
        k, m = self.k[item], np.array([len(c) for c in self.codes], np.int64)[item]
        begin = np.maximum(low - k, heads[row])
        end = np.minimum(low + 3 * k + 1 + m, heads[row + 1])
        words = -(-m // 64)
        keep = self._counts_short(text, begin, end, item, k)
        order = np.lexsort((end - begin, words))
        for w in np.unique(words).tolist():
            mine = order[(words[order] == w) & keep[order]]
            if len(mine) < 32 * w:  # columns of single items are cheaper
                continue
            step = max(64, TOGETHER // w)
            for at in range(0, len(mine), step):
                part = mine[at : at + step]
                own, rows = np.unique(item[part], return_inverse=True)
                signs = np.unique(np.concatenate([self.codes[i] for i in own.tolist()]))
                bits = np.zeros((len(own), len(signs) + 1, w), np.uint64)  # the last sign is in no item
                for j, i in enumerate(own.tolist()):
                    places = np.arange(len(self.codes[i]))
                    np.bitwise_or.at(
                        bits[j], (np.searchsorted(signs, self.codes[i]), places // 64), np.uint64(1) << (places % 64).astype(np.uint64)
                    )
                size = end[part] - begin[part]
                place = begin[part] + np.arange(int(size.max()))[:, None]
                window = text[np.minimum(place, len(text) - 1)].astype(np.int64)
                sign = np.minimum(np.searchsorted(signs, window), len(signs) - 1)
                sign = np.where((signs[sign] == window) & (place < end[part]), sign, len(signs))
                keep[part] = _any_within(bits, rows, m[part], sign, k[part])
        return found[keep].tolist()

    def verify(self, text: np.ndarray, item: int, diagonal: int):
        """(distance, start, end) of the best alignment of the item on this band, or None.

        ``text`` is one row. The item is aligned whole; rows of the table are item characters, columns the
        diagonals of the band and k on either side, because an alignment may stray that far.
        """
        k, codes = int(self.k[item]), self.codes[item]
        begin = max(0, diagonal)
        part, plain = text[begin : diagonal + 2 * k + 1 + len(codes)].tobytes(), codes.tobytes()
        at = part.find(plain)
        while at >= 0 and at % codes.itemsize:
            at = part.find(plain, at + 1)
        if at >= 0:  # unchanged
            return 0, begin + at // codes.itemsize, begin + at // codes.itemsize + len(codes)
        if not _within(self.sets[item], len(codes), text[max(0, diagonal - k) : diagonal + 3 * k + 1 + len(codes)], k):
            return None
        first, width = diagonal - k, 4 * k + 1 + 2
        big = 1 << 40
        column = np.arange(width)
        # Cell (i, d): item characters before i against the text ending before i + first + d.
        cost = np.where((first + column >= 0) & (first + column <= len(text)), 0, big)
        origin = first + column
        for i, c in enumerate(codes.tolist()):
            at = i + first + column  # text position read by a diagonal step
            ok = (at >= 0) & (at < len(text))
            same = np.zeros(width, np.int64)
            same[ok] = text[at[ok]] != c
            step = np.where(ok, cost + same, big)
            skip = np.concatenate([cost[1:] + 1, [big]])  # an item character without counterpart
            source = np.concatenate([origin[1:], [0]])
            use = skip < step
            best, from_ = np.where(use, skip, step), np.where(use, source, origin)
            valid = (i + 1 + first + column >= 0) & (i + 1 + first + column <= len(text))
            best = np.where(valid, best, big)
            # Text characters without counterpart: cheapest cell to the left plus the steps between.
            slope = best - column
            least = np.minimum.accumulate(slope)
            lead = np.maximum.accumulate(np.where(slope == least, column, 0))
            origin = from_[lead]
            cost = np.where(valid, least + column, big)
            if cost.min() > k:
                return None
        end = int(np.argmin(cost))
        if cost[end] > k:
            return None
        return int(cost[end]), int(origin[end]), len(codes) + first + end


    def _short(self, item: int) -> np.ndarray:
        """The distinct short grams of an item, as 12 bits each."""
        if item not in self.short:
            self.short[item] = np.unique(combine(self.codes[item].astype(np.uint64), SHORT, 7) >> np.uint64(52)).astype(np.int16)
        return self.short[item]

    def _counts_short(self, text, begin, end, item, k) -> np.ndarray:
        """The lemma once more with short grams: k edits leave all but SHORT * k of an item's distinct ones in the region."""
        grams = (combine(text.astype(np.uint64), SHORT, 7) >> np.uint64(52)).astype(np.int64)
        size = end - SHORT + 1 - begin
        ok = np.ones(len(item), bool)
        order = np.argsort(size, kind="stable")
        order = order[size[order] > 0]
        for at in range(0, len(order), 1024):
            part = order[at : at + 1024]
            own, rows = np.unique(item[part], return_inverse=True)
            held = [self._short(i) for i in own.tolist()]
            asked = np.full((len(own), max(map(len, held), default=0)), 1 << 12)  # the last column is in no region
            for j, h in enumerate(held):
                asked[j, : len(h)] = h
            pair = np.arange(len(part))[:, None]
            there = np.zeros((len(part), (1 << 12) + 1), bool)
            last = size[part] - 1
            there[pair, grams[begin[part][:, None] + np.minimum(np.arange(int(last.max()) + 1), last[:, None])]] = True
            distinct = np.array([len(h) for h in held])[rows]
            ok[part] = np.count_nonzero(there[pair, asked[rows]], axis=1) >= distinct - SHORT * k[part]
        return ok


@lru_cache(maxsize=2)
def _items(rows: tuple, q: int, rate: float) -> list[_Items]:
    """Items by the q that suits them."""
    by_width: dict[int, list] = {}
    for item_id, text in rows:
        if text:
            by_width.setdefault(_width(len(text), rate, q), []).append((item_id, text))
    return [_Items(own, width, rate) for width, own in sorted(by_width.items())]


def _lone(text: np.ndarray, a: int, b: int) -> bool:
    """Whether no letter or digit stands beside text[a:b]."""
    return (a == 0 or text[a - 1] == 32) and (b == len(text) or text[b] == 32)


def _find(groups: list[_Items], texts: list[str], q: int):
    """(row, item, its length, start, end, distance) of all matches, in code points of the original texts."""
    for first, _, cp, offsets in chunks(texts):
        text, source, heads = _fold(cp, offsets)
        for items in groups:
            best = {}
            for row, item, diagonal in items.bands(text, heads):
                a, b = int(heads[row]), int(heads[row + 1])
                own = text[a:b].astype(np.int64)
                hit = items.verify(own, item, diagonal - a)
                if hit is None or hit[1] >= hit[2]:
                    continue
                if len(items.codes[item]) < q and not _lone(own, hit[1], hit[2]):
                    continue
                near = int(offsets[row])
                span = (hit[0], int(source[a + hit[1]]) - near, int(source[a + hit[2] - 1]) - near + 1)
                best.setdefault((row, item), set()).add(span)
            for (row, item), spans in best.items():
                kept = []
                for d, s, e in sorted(spans):  # of overlapping places of an item the closest
                    i = bisect(kept, (s, e))
                    if (i == 0 or kept[i - 1][1] <= s) and (i == len(kept) or kept[i][0] >= e):
                        kept.insert(i, (s, e))
                        yield first + row, items.ids[item], len(items.codes[item]), s, e, d


def _search(shared, q: int, rate: float):
    def go(batches):
        items = _items(shared.value, q, rate)
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            out = [
                (ids[row], item, s, e, d, length)
                for row, item, length, s, e, d in _find(items, [t or "" for t in batch.column("text").to_pylist()], q)
            ]
            cols = list(zip(*out)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=_NAMES)

    return go


def _clean(shared, q: int, rate: float):
    def go(batches):
        items = _items(shared.value, q, rate)
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for row, *_ in _find(items, [t or "" for t in batch.column("text").to_pylist()], q):
                keep[row] = False
            yield batch.filter(pa.array(keep))

    return go


def _groups(benchmark: DataFrame):
    """Folded items in groups that fit a broadcast each."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.where("text IS NOT NULL").distinct()
    group, size = [], 0
    for row in items.orderBy("item_id", "text").toLocalIterator():
        folded = fold_text(row["text"])
        if group and size + len(folded) > GROUP_BYTES:
            yield tuple(group)
            group, size = [], 0
        group.append((row["item_id"], folded))
        size += len(folded)
    if group:
        yield tuple(group)


def matches(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, q: int = Q) -> DataFrame:
    """Places of ``docs`` that hold a whole benchmark item within ``rate`` edits per character.

    Returns doc_id, item_id, start, end (code points of the original text), distance and
    item_length (folded characters). Of overlapping places of one item the closest is returned.
    Whole texts are searched where they stand, with one pass per 8 MB of benchmark; nothing is
    shuffled. Null and empty texts match nothing, nor do items without letters and digits. Items of
    fewer than q characters must occur unchanged, between blanks; all others are found within their
    whole budget. Null ids are returned as null. Repeated rows are searched each; without items the result is empty.
    """
    spark, out = docs.sparkSession, None
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    for group in _groups(benchmark):
        shared = spark.sparkContext.broadcast(group)
        found = rows.mapInArrow(_search(shared, q, rate), _OUT)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], _OUT)


def decontaminate(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, q: int = Q) -> DataFrame:
    """``docs``, all its columns, without the rows whose text holds a benchmark item."""
    for group in _groups(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(group)
        docs = docs.mapInArrow(_clean(shared, q, rate), docs.schema)
    return docs
