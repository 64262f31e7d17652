"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes.

The patterns (e-mail, IP, card, phone) give the base spans. The field reads every run of words that hold a
digit or an @ (all other words are O by definition, so the chain falls apart between the runs and decoding
them one by one is decoding the whole text). It is trained on a small labelled table and decoded by Viterbi,
many runs at a time. Its spans are added where no base span of their kind is, if they pass the kind's own check
(digits, Luhn, parts of an address) without regard to the separators.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
FEATURES = 1 << 14
TRAIN_DOCS, TRAIN_RUNS, TRAIN_TOKENS = 2000, 1200, 96  # bounds of the labelled table

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# The run before a match cannot end in a digit, so these start where the plain patterns do.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ACTIVE = re.compile(r"[0-9@]")
_BLANK = re.compile(r"\s")
_TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|\s+|.", re.S)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _octets(parts: list[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in parts)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, by kind, then start."""
    out, done = [], 0
    at = text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at)
        if m:
            first = at
            while first > done and text[first - 1] in _LOCAL:
                first -= 1
            if first < at:
                out.append(("email", first, m.end()))
                done = m.end()
        at = text.find("@", max(at + 1, done))
    out += [("ip", *m.span()) for m in _IP.finditer(text) if _octets(m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            d = _digits(m[0])
            if 13 <= len(d) <= 19 and luhn(d):
                out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


def runs(text: str) -> list[tuple[int, int]]:
    """Maximal runs of words with a digit or @ that single blanks join."""
    out, end = [], 0
    for m in _ACTIVE.finditer(text):
        at = m.start()
        if at < end:
            continue
        first = at
        while first > end and not text[first - 1].isspace():
            first -= 1
        stop = _BLANK.search(text, at)
        stop = stop.start() if stop else len(text)
        if out and out[-1][1] + 1 == first and text[first - 1] == " ":
            out[-1] = (out[-1][0], stop)
        else:
            out.append((first, stop))
        end = stop
    return out


def _shape(token: str) -> str:
    c = token[0]
    if "0" <= c <= "9":
        return f"d{min(len(token), 5) if len(token) < 13 else 13}"
    if c.isascii() and c.isalpha():
        return ("U" if token.isupper() else "C" if c.isupper() else "a") + str(min(len(token), 4))
    return "_" if c.isspace() else c if c.isascii() else "?"


_codes: dict[str, int] = {}


def _code(name: str) -> int:
    found = _codes.get(name)
    if found is None:
        if len(_codes) > 200_000:
            _codes.clear()
        found = _codes[name] = crc32(name.encode()) % FEATURES
    return found


def features(tokens: list[str]) -> np.ndarray:
    """Eight feature numbers per token."""
    shape = ["<2", "<1", *map(_shape, tokens), ">1", ">2"]
    n = sum(len(t) for t in tokens if "0" <= t[0] <= "9")
    size = f"n{min(n, 20)}"
    rows = []
    for i, token in enumerate(tokens, 2):
        b2, b1, c, a1, a2 = shape[i - 2 : i + 3]
        word = token.lower() if token[0].isalpha() and len(token) <= 12 else c
        rows.append([_code(x) for x in (
            f"0{c}", f"1{b1}|{c}", f"2{c}|{a1}", f"3{b1}|{c}|{a1}", f"4{b2}|{b1}|{c}", f"5{c}|{a1}|{a2}", f"6{word}", f"7{size}|{c}"
        )])
    return np.array(rows, np.int32).reshape(-1, 8)


def _allowed() -> np.ndarray:
    """0 where a label may follow another, else a prohibitive cost. Row 9 is the start."""
    cost = np.zeros((len(LABELS) + 1, len(LABELS)))
    for j, label in enumerate(LABELS):
        if label[0] == "I":
            kind = label[2:]
            for i in range(len(LABELS) + 1):
                if i == len(LABELS) or LABELS[i][2:] != kind:
                    cost[i, j] = -1e4
    return cost


@dataclass(frozen=True)
class Field:
    """Weights per feature and label, and per pair of labels (last row: at the start)."""

    emit: np.ndarray
    move: np.ndarray

    def decode(self, sequences: list[np.ndarray]) -> list[np.ndarray]:
        """Best label sequence of each; sequences of similar length run together."""
        out: list = [None] * len(sequences)
        order = sorted(range(len(sequences)), key=lambda i: len(sequences[i]))
        at = 0
        while at < len(order):
            longest = max(8, 2 * len(sequences[order[at]]))
            group = []
            while at < len(order) and len(sequences[order[at]]) <= longest and len(group) * longest < 100_000:
                group.append(order[at])
                at += 1
            for i, path in zip(group, self._viterbi([sequences[i] for i in group])):
                out[i] = path
        return out

    def _viterbi(self, group: list[np.ndarray]) -> list[np.ndarray]:
        n, k = np.array([len(s) for s in group]), len(LABELS)
        longest = int(n.max())
        x = np.zeros((len(group), longest, k))
        for i, s in enumerate(group):
            x[i, : len(s)] = self.emit[s].sum(1)
        score = self.move[k] + x[:, 0]
        back = np.zeros((longest, len(group), k), np.int8)
        for t in range(1, longest):
            step = score[:, :, None] + self.move[:k]
            back[t] = step.argmax(1)
            new = step.max(1) + x[:, t]
            score = np.where((t < n)[:, None], new, score)
        last = score.argmax(1)
        paths = np.zeros((len(group), longest), np.int8)
        for t in range(longest - 1, -1, -1):
            inside = t < n
            paths[inside, t] = last[inside]
            last = np.where(inside, back[t][np.arange(len(group)), last], last)
        return [p[:m] for p, m in zip(paths, n)]


def labels_of(tokens: list[str], first: int, spans: list[tuple[str, int, int]]) -> np.ndarray:
    """The label of each token of a run that starts at ``first``."""
    out, at = np.zeros(len(tokens), np.int8), first
    starts = {s: (k, e) for k, s, e in spans}
    kind, end = None, -1
    for i, token in enumerate(tokens):
        if at in starts and at >= end:
            kind, end = starts[at]
            out[i] = 1 + 2 * KINDS.index(kind)
        elif at < end:
            out[i] = 2 + 2 * KINDS.index(kind)
        at += len(token)
    return out


def train(sequences: list[np.ndarray], labels: list[np.ndarray], rounds: int = 60, rate: float = 0.15, decay: float = 1e-3) -> Field:
    """Maximum likelihood by forward-backward and Adam over all sequences at once."""
    k = len(LABELS)
    base = _allowed()
    emit, move = np.zeros((FEATURES, k)), np.zeros((k + 1, k))
    if not sequences:
        emit[:, 0] = 1.0
        return Field(emit, move + base)
    n, longest = np.array([len(s) for s in sequences]), max(map(len, sequences))
    rows = len(sequences)
    x, y, on = np.zeros((rows, longest, 8), np.int64), np.zeros((rows, longest), np.int64), np.arange(longest) < n[:, None]
    for i, (s, l) in enumerate(zip(sequences, labels)):
        x[i, : len(s)], y[i, : len(l)] = s, l
    used, local = np.unique(x[on], return_inverse=True)
    local = local.reshape(-1, 8)
    w, t = np.zeros((len(used), k)), np.zeros((k + 1, k))
    moments = [np.zeros_like(a) for a in (w, w, t, t)]
    gold_pairs = np.zeros_like(t)
    np.add.at(gold_pairs, (np.full(rows, k), y[:, 0]), 1)
    pair = on[:, 1:]
    np.add.at(gold_pairs, (y[:, :-1][pair], y[:, 1:][pair]), 1)
    one = np.eye(k)[y[on]]

    def soft(a, axis):
        m = a.max(axis, keepdims=True)
        return (m + np.log(np.exp(a - m).sum(axis, keepdims=True))).squeeze(axis)

    for step in range(1, rounds + 1):
        e = np.zeros((rows, longest, k))
        e[on] = w[local].sum(1)
        m = t + base
        f = np.zeros_like(e)
        f[:, 0] = m[k] + e[:, 0]
        for i in range(1, longest):
            f[:, i] = np.where(on[:, i, None], soft(f[:, i - 1, :, None] + m[:k], 1) + e[:, i], f[:, i - 1])
        z = soft(f[:, -1], 1)
        b = np.zeros_like(e)
        grad_t = np.zeros_like(t)
        for i in range(longest - 2, -1, -1):
            ahead = e[:, i + 1] + b[:, i + 1]
            live = on[:, i + 1]
            both = f[live, i, :, None] + m[:k] + ahead[live][:, None, :] - z[live, None, None]
            grad_t[:k] += np.exp(both).sum(0)
            b[:, i] = np.where(live[:, None], soft(m[:k] + ahead[:, None, :], 2), 0)
        p = np.exp(f + b - z[:, None, None])
        grad_t[k] = p[:, 0].sum(0)
        diff = p[on] - one
        grad_w = np.stack([np.bincount(local.ravel(), np.repeat(diff[:, j], 8), len(used)) for j in range(k)], 1)
        for a, g, (first, second) in ((w, grad_w / rows + decay * w, moments[:2]), (t, (grad_t - gold_pairs) / rows + decay * t, moments[2:])):
            first += 0.1 * (g - first)
            second += 0.01 * (g * g - second)
            a -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    emit[used] = w
    return Field(emit, t + base)


def _label(batches):
    """Runs of labelled texts: the labels are the base spans."""
    for batch in batches:
        tokens, labels = [], []
        for text in batch.column("text").to_pylist():
            text = text or ""
            spans = base_spans(text)
            for a, b in runs(text):
                parts = _TOKEN.findall(text[a:b])
                if len(parts) <= TRAIN_TOKENS:
                    tokens.append(parts)
                    labels.append(labels_of(parts, a, spans).tolist())
        yield pa.RecordBatch.from_arrays(
            [pa.array(tokens, pa.list_(pa.string())), pa.array(labels, pa.list_(pa.int8()))], names=["tokens", "labels"]
        )


def labelled_runs(docs: DataFrame, texts: int = TRAIN_DOCS, most: int = TRAIN_RUNS) -> DataFrame:
    """A labelled table (tokens, labels) of at most ``most`` runs from at most ``texts`` texts.

    The distinct texts with a digit or @ whose hash is least; distinct runs, those with personal data first.
    Hashes alone are ranked; then only the texts below the last of them are shuffled.
    """
    active = docs.select(F.col("text").cast("string").alias("text")).where(F.col("text").rlike("[0-9@]"))
    hashed = active.withColumn("h", F.xxhash64("text"))
    last = hashed.select("h").distinct().orderBy("h").limit(texts).agg(F.max("h")).first()[0]
    some = hashed.where(F.col("h") <= F.lit(last).cast("long")).groupBy("h").agg(F.min("text").alias("text")).select("text")
    return (
        some.mapInArrow(_label, "tokens array<string>, labels array<byte>").distinct()
        .orderBy((F.array_max("labels") == 0), F.xxhash64("tokens"), "tokens").limit(most)
    )


def fit(table: DataFrame) -> Field:
    """Train on a labelled table (tokens array<string>, labels array<byte>), which must be small."""
    rows = [(r["tokens"], r["labels"]) for r in table.collect() if r["tokens"]]
    return train([features(t) for t, _ in rows], [np.array(l, np.int8) for _, l in rows])


def _passes(kind: str, part: str) -> bool:
    """The kind's own check, whatever the separators."""
    d = _digits(part)
    if kind == "email":
        return part.count("@") == 1 and "." in part.split("@")[1] and not part.startswith("@")
    if kind == "ip":
        parts = re.findall("[0-9]+", part)
        return len(parts) == 4 and _octets(parts)
    if kind == "card":
        return 13 <= len(d) <= 19 and luhn(d)
    return 9 <= len(d) <= 15


def find(texts: list[str], model: Field) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text, both by kind, then start."""
    base = [base_spans(t) for t in texts]
    where, parts, rows = [], [], []
    for i, text in enumerate(texts):
        for a, b in runs(text):
            tokens = _TOKEN.findall(text[a:b])
            where.append((i, a))
            parts.append(tokens)
            rows.append(features(tokens))
    more: dict[int, list] = {}
    for (i, at), tokens, path in zip(where, parts, model.decode(rows)):
        span = None
        for token, label in zip([*tokens, ""], [*path.tolist(), 0]):
            if span and (label == 0 or label % 2 == 1):
                more.setdefault(i, []).append(tuple(span))
                span = None
            if label:
                span = [KINDS[(label - 1) // 2], span[1] if span else at, at + len(token)]
            at += len(token)
    out = []
    for i, own in enumerate(base):
        extra = [
            (k, s, e) for k, s, e in more.get(i, [])
            if _passes(k, texts[i][s:e]) and all(k != k2 or e <= s2 or s >= e2 for k2, s2, e2 in own)
        ]
        out.append((own, sorted(own + extra, key=lambda x: (KINDS.index(x[0]), x[1]))))
    return out


def _spell(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _scan(shared):
    def go(batches):
        model = shared.value
        for batch in batches:
            ids, texts = batch.column("doc_id"), [t or "" for t in batch.column("text").to_pylist()]
            for k in range(0, len(texts), 500):
                found = find(texts[k : k + 500], model)
                count = [[sum(s[0] == kind for s in base) for base, _ in found] for kind in KINDS]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(k, 500),
                        *(pa.array(c, pa.int64()) for c in count),
                        pa.array([hashlib.sha256(_spell(b).encode()).hexdigest() for b, _ in found]),
                        pa.array([_spell(s) for _, s in found], pa.string()),
                    ],
                    names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
                )

    return go


def personal_data(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256 and spans of every whole text.

    Spans are kind:start:end in code points, end exclusive. ``labelled`` is the table to train on; by
    default ``labelled_runs(docs)``. Null and empty texts have no spans; null ids and repeated rows are
    returned as they are; an empty table trains a field that adds nothing.
    """
    model = fit(labelled if labelled is not None else labelled_runs(docs))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: about 1 MB
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _scan(shared), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    )
