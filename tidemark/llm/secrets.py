"""Secrets: candidate strings, filtered by a random forest. DataFrame functions only.

A candidate is a provider's key, a value of 8 or more signs assigned to the name of a credential, or a run of 12 or
more token characters with a digit or a provider's prefix, without the punctuation at its end. A random forest, trained from
labelled findings, removes false positives by length, character transitions, dictionary
coverage, path and neighbouring words. The forest is turned into an expression, so a text is scanned where
it stands: nothing is shuffled, and a text with many candidates is one row throughout.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

PROVIDER = (
    r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abp]-[A-Za-z0-9-]{9,}[A-Za-z0-9]|sk_live_[A-Za-z0-9]{16,}"
    r"|eyJ[A-Za-z0-9_-]{8,}[.]eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,})(?![A-Za-z0-9])"
)


ENCLOSED = 128  # signs of a value with blanks that ends with the string around it


def _assigned() -> str:
    """Values of 8 or more signs of any kind behind the name of a credential.

    Lookbehinds of one width each: only these mean the same in every regular expression engine. A quoted value
    reaches to the closing quote, however far; these scans do not overlap, so a text is read in linear time. A value
    without an opening quote may hold blanks if a quote follows within ENCLOSED signs, else it ends at a blank.
    """
    names = {n: len(n) for n in "password passwords passwd passphrase pwd secret secrets token apikey accesskey privatekey secretkey auth credential credentials".split()}
    names |= {f"{n}[ _-]key": len(n) + 4 for n in ("api", "access", "private", "secret")}
    separators = {"[:=]": 1, "[:=][ \"']": 2, "[\"'][:=]": 2, " [:=]": 2, "[:=] [\"']": 3, "[\"']: ": 3, "[\"'][:=][\"']": 3, " [:=] ": 3,
                  " is ": 4, "[\"']: [\"']": 4, " [:=] [\"']": 4, " is [\"']": 5}
    by_width = {}
    for name, n in names.items():
        for sep, k in separators.items():
            by_width.setdefault(n + k, {}).setdefault(sep, []).append(name)
    behind = "|".join(
        "(?<=" + "|".join(f"(?i:{'|'.join(own)}){sep}" for sep, own in found.items()) + ")" for _, found in sorted(by_width.items())
    )
    sign, stop = r"[^ \t\n\r\f\x0b\"'<>]", r"[.,;:?)\]}]*(?![^ \t\n\r\f\x0b\"'<>])"
    return rf"(?:(?<=[:=])|(?<=[:=][ \"'])|(?<=[:=] [\"'])|(?<= is )|(?<= is [\"']))(?:{behind})(?:(?<=[\"'])[^\"'\n]{{8,}}+(?=[\"'])(?<=[^ ])|[^\"'\n]{{8,{ENCLOSED}}}(?=[\"'])(?<=[^ ])|{sign}{{8,}}?(?=[,;&][A-Za-z_]+[=:]|{stop}))"


# A provider's key wherever it stands in a run; an assigned value; a run of token characters without a key in it.
CANDIDATE = (
    rf"{PROVIDER}|{_assigned()}|"
    r"(?<![A-Za-z0-9+/_.~-])(?=[A-Za-z+/_.~-]*[0-9]|AKIA|gh[pousr]_|xox[abp]-|sk_live_)(?=[A-Za-z0-9+/_.~-]{12})"
    rf"(?![A-Za-z0-9+/_.~-]*{PROVIDER})[A-Za-z0-9+/_.~-]{{11,}}[A-Za-z0-9+/_~]"
)
CONTEXT = 48
MARK = "\ue000"  # set around candidates when a text is taken apart
MASK = "[SECRET]"
MAX_FINDINGS = 20_000  # labelled findings that train the forest
LEAST_ROWS = 64  # of each label that a tree samples from
TREES, DEPTH = 15, 5
_BLOCK = 64
# Words of the dictionary feature, and those next to credentials or to harmless strings.
DICTIONARY = (
    "about account address and code com config data die der den download example false file for from google html http "
    "image index info les license local mail main name net news online open org page path post public que que sample "
    "server site source test text that the true und user version web with work world www"
).split()
CREDENTIAL = r"(?:passw(?:or)?d|passwd|passphrase|pwd|secret|token|api[ _-]?key|access[ _-]?key|private[ _-]?key|auth|bearer|credential)"
HARMLESS = r"(?:commit|sha-?\d*|md5|checksum|digest|hash|uuid|isbn|doi|version|phone|tel|card|order|https?|www)"
ASSIGNED = rf"(?i){CREDENTIAL}[A-Za-z_]{{0,16}}[\"']?\s*(?:[:=]|is)\s*[\"']?$"
PLACE = r"^(?:[$%{(\[*]|(?:[A-Za-z]+:)?//|[.~]{1,2}/|/[a-z]+/[a-z])"  # a placeholder, an address or a path
FEATURES = (
    "length", "digit_letter", "case", "digits", "upper", "hex", "distinct", "vowels", "dictionary", "slashes", "dots",
    "after_at", "assigned", "quoted", "credential", "harmless", "provider",
)


def _share(v: Column, pattern: str) -> Column:
    return F.regexp_count(v, F.lit(pattern)).cast("double") / F.length(v)


def _features(v: Column, left: Column, right: Column) -> list[Column]:
    words = "|".join(sorted(set(DICTIONARY), key=lambda w: (-len(w), w)))
    number = lambda c: c.cast("double")
    values = [
        number(F.length(v)),
        _share(v, "(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])"),
        _share(v, "(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])"),
        _share(v, "[0-9]"),
        _share(v, "[A-Z]"),
        _share(v, "[0-9a-f]"),
        number(F.array_size(F.array_distinct(F.split(v, "")))) / F.length(v),
        _share(v, "[aeiouAEIOU]"),
        1 - number(F.length(F.regexp_replace(F.lower(v), f"(?:{words})", ""))) / F.length(v),
        number(F.regexp_count(v, F.lit("/"))),
        number(F.regexp_count(v, F.lit("[.]"))),
        number(left.rlike("@$|://$")),
        number(left.rlike(r"[:=]\s*[\"']?$")),
        number(left.rlike(r"[\"']$") & right.rlike(r"^[\"']")),
        number(left.rlike(rf"(?i){CREDENTIAL}")),
        number(left.rlike(rf"(?i)\b{HARMLESS}\b")),
        number(v.rlike(PROVIDER)),
    ]
    return [F.coalesce(c, F.lit(0.0)).alias(n) for n, c in zip(FEATURES, values)]


def candidates(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and _text, _found, _parts, _cands: an array of start, end, value, left, right and features."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # One search per text: candidates are marked in place, then split off. Texts that hold the mark take two.
    pieces = F.when(F.instr("_text", MARK) == 0, F.split(F.regexp_replace("_text", CANDIDATE, f"{MARK}$0{MARK}"), MARK, -1))
    rows = docs.select(*keep, text.alias("_text")).select("*", pieces.alias("_pieces"))
    each = lambda odd: F.filter("_pieces", lambda _, i: i % 2 == odd)
    rows = rows.select(
        *keep, "_text",
        F.when(F.col("_pieces").isNull(), F.regexp_extract_all("_text", F.lit(CANDIDATE), F.lit(0))).otherwise(each(1)).alias("_found"),
        F.when(F.col("_pieces").isNull(), F.split("_text", CANDIDATE, -1)).otherwise(each(0)).alias("_parts"),
    )
    # Prefix sums of lengths in two levels, so that a text with n candidates costs far less than n * n.
    total = lambda a: F.aggregate(a, F.lit(0), lambda acc, x: acc + x)
    size = F.transform(
        F.arrays_zip("_parts", "_found"), lambda x: F.length(x["_parts"]) + F.coalesce(F.length(x["_found"]), F.lit(0))
    )
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor(F.size("_found") / _BLOCK).cast("int")),
        lambda b: total(F.slice(F.col("_size"), b * _BLOCK + 1, F.lit(_BLOCK))),
    )
    rows = rows.select("*", size.alias("_size")).select("*", blocks.alias("_block"))
    rows = rows.select(
        "*", F.transform(F.sequence(F.lit(0), F.size("_block") - 1), lambda b: total(F.slice(F.col("_block"), F.lit(1), b))).alias("_upto")
    )

    def one(i: Column) -> Column:
        b = F.floor(i / _BLOCK).cast("int")
        start = (
            F.element_at("_upto", b + 1)
            + total(F.slice(F.col("_size"), b * _BLOCK + 1, i - b * _BLOCK))
            + F.length(F.element_at("_parts", i + 1))
        )
        v = F.element_at("_found", i + 1)
        return F.struct(
            i.alias("i"), start.cast("long").alias("start"), v.alias("value"),
            F.right(F.element_at("_parts", i + 1), F.lit(CONTEXT)).alias("left"),
            F.left(F.element_at("_parts", i + 2), F.lit(CONTEXT)).alias("right"),
        )

    places = F.when(
        F.size("_found") > 0, F.transform(F.sequence(F.lit(0), F.size("_found") - 1), one)
    )
    rows = rows.select(*keep, "_text", "_found", "_parts", places.alias("_places"))
    full = F.transform(
        "_places",
        lambda x: F.struct(
            x["i"].alias("i"), x["start"].alias("start"), (x["start"] + F.length(x["value"])).alias("end"),
            x["value"].alias("value"), x["left"].alias("left"), x["right"].alias("right"),
            *_features(x["value"], x["left"], x["right"]),
        ),
    )
    return rows.select(*keep, "_text", "_found", "_parts", full.alias("_cands"))


def _each(array: str) -> Column:
    """A row per element. Of a plain column, Spark would test the size first, below all projections: every text searched once more."""
    return F.explode(F.filter(array, lambda x: x.isNotNull()))


def labelled_findings(docs: DataFrame, most: int = MAX_FINDINGS) -> DataFrame:
    """A bounded table of findings with features and ``label``.

    Without reviewed findings of its own, the label follows rules: 1 for a string in a provider's fixed
    format or assigned to a name of a credential, with more than one class of characters and not a
    placeholder, an address or a path, else 0.
    Each label has half of the bound for itself, however rare it is: its findings are dealt by a hash of value
    and context into ``most / 2`` buckets, and the least hash of each bucket stays. A finding that is alone stays.
    """
    found = candidates(docs).select(_each("_cands").alias("c")).select("c.*")
    secret = (F.col("provider") == 1) | (
        F.col("left").rlike(ASSIGNED)
        & (((F.col("digits") < 1) & (F.col("digits") > 0)) | F.col("value").rlike("[^A-Za-z0-9._/~: -]"))
        & ~F.col("value").rlike(PLACE)
    )
    found = found.select("value", "left", "right", secret.cast("double").alias("label"))
    h = F.xxhash64("value", "left", "right")
    least = found.groupBy("label", F.pmod(h, F.lit(max(1, most // 2))).alias("bucket")).agg(
        F.min(F.struct(h.alias("h"), "value", "left", "right")).alias("f")
    )
    return least.select("label", "f.value", "f.left", "f.right").select(
        "value", "left", "right", *_features(F.col("value"), F.col("left"), F.col("right")), "label"
    )


@dataclass(frozen=True)
class Forest:
    """Trees as nested tuples (feature, threshold, at most, above), leaves as 0.0 or 1.0."""

    trees: tuple

    def share(self, x: Column) -> Column:
        """The share of trees that call the candidate struct ``x`` a secret."""

        def expr(node) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            feature, threshold, low, high = node
            return F.when(x[FEATURES[feature]] <= threshold, expr(low)).otherwise(expr(high))

        total = F.lit(0.0)
        for tree in self.trees:
            total = total + expr(tree)
        return total / max(1, len(self.trees))


def _parse(text: str):
    """The tree in the public text form of a fitted decision tree."""
    lines = [l for l in text.splitlines()[1:] if l.strip()]
    at = 0

    def node():
        nonlocal at
        line = lines[at].strip()
        at += 1
        if line.startswith("Predict"):
            return float(line.split(":")[1])
        feature, threshold = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
        low = node()
        at += 1  # Else
        return int(feature), float(threshold), low, node()

    return node()


def fit(findings: DataFrame, trees: int = TREES, depth: int = DEPTH) -> Forest:
    """Train on findings (the features and ``label`` 0 or 1); with labels of one kind only, that label.

    Both labels weigh the same, and a label of few rows is repeated, so that every tree's sample holds it.
    """
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(findings.select(*FEATURES, "label"))
    rows = rows.select("features", "label").coalesce(1).cache()  # at most MAX_FINDINGS rows
    try:
        kinds = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
        if len(kinds) < 2:
            return Forest((float(next(iter(kinds))),) if kinds else (0.0,))
        times = {k: -(-LEAST_ROWS // n) for k, n in kinds.items()}
        one = lambda of: F.when(F.col("label") == 1, of(1.0)).otherwise(of(0.0))
        weighted = rows.select(
            "features", "label", one(lambda k: F.lit(max(kinds.values()) / (kinds[k] * times[k]))).alias("weight"),
            F.explode(F.sequence(F.lit(1), one(lambda k: F.lit(times[k])))).alias("_time"),
        )
        model = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=10, weightCol="weight").fit(weighted)
        return Forest(tuple(_parse(t.toDebugString) for t in model.trees))
    finally:
        rows.unpersist()


def _scored(docs: DataFrame, forest: Forest, *keep: str) -> DataFrame:
    rows = candidates(docs, *keep)
    hits = F.filter(
        F.transform(
            "_cands",
            lambda x: F.struct(
                x["i"].alias("i"), x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value"),
                forest.share(x).alias("score"),
            ),
        ),
        lambda x: x["score"] >= 0.5,
    )
    return rows.select(*keep, "_text", "_found", "_parts", hits.alias("_hits"))


def scan(docs: DataFrame, forest: Forest | None = None) -> DataFrame:
    """doc_id, start, end, value, score: one row per secret found in the whole texts of ``docs``.

    start and end are code points, end exclusive; score is the share of trees for it (at least one
    half). Null and empty texts have none; null ids are returned as null; repeated rows are scanned each; no
    candidate in the whole table, no result. ``forest`` is trained on ``labelled_findings(docs)`` by default.
    """
    forest = forest or fit(labelled_findings(docs))
    rows = _scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), forest, "doc_id")
    return rows.select("doc_id", _each("_hits").alias("h")).select(
        "doc_id", F.col("h.start").alias("start"), F.col("h.end").alias("end"), F.col("h.value").alias("value"), F.col("h.score").alias("score")
    )


def mask(docs: DataFrame, forest: Forest | None = None) -> DataFrame:
    """``docs``, all rows and columns, with each secret in ``text`` replaced by ``[SECRET]``."""
    forest = forest or fit(labelled_findings(docs))
    # Columns of any name travel as one struct.
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = _scored(docs.select(whole, F.col("text")), forest, "_row")
    gone = F.transform("_hits", lambda x: x["i"])
    pieces = F.transform(
        F.sequence(F.lit(0), F.size("_parts") - 1),
        lambda i: F.concat(
            F.element_at("_parts", i + 1),
            F.when(i == F.size("_found"), "").when(F.array_contains(gone, i), MASK).otherwise(F.get("_found", i)),
        ),
    )
    text = F.when(F.size("_hits") > 0, F.array_join(pieces, "")).otherwise(F.col("_row").getField("text"))
    return rows.select(*[text.alias("text") if c == "text" else F.col("_row").getField(c).alias(c) for c in docs.columns])
