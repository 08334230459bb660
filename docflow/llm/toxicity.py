"""Toxicity by compression distance: windows of a text are compressed with a zstandard dictionary of toxic text and with one
of ordinary text; where the toxic one saves more than calibrated thresholds allow, the text is toxic."""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import free_name

# Bounds of the sample that the dictionaries and thresholds are fitted on. Everything is scored.
MAX_TOXIC = 2_000
MAX_ORDINARY = 4_000
MAX_BYTES = 24 << 20
HELD_OUT = 5  # rows whose crc32(key) mod 5 is 0 are never learned from

WINDOW = 48  # bytes; below 63 literals zstandard stores them as they are, so each saved byte shows
COMMON_BYTES = 8192  # of both dictionaries
OWN_BYTES = 1024  # of each dictionary alone
SEGMENT, DMER = 16, 6
GRAM = 5
OFTEN = 50  # it stands in one of so many texts at least, so copies of one text teach nothing
RATIO = 20  # a gram is told as toxic if its share of toxic texts is that many times its share of ordinary ones
LOW, HIGH = -16, 48  # advantages are counted between these
QUANTILES = (0.99, 0.999)
TOP = 8


def folded(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "replace")


def windows(data: bytes) -> Iterator[bytes]:
    """Runs of whole words, at least ``WINDOW`` bytes each but for the last; an unbroken run is cut at eight windows."""
    at, end = 0, len(data)
    while at < end:
        stop = data.find(b" ", at + WINDOW, at + 8 * WINDOW)
        if stop < 0:
            stop = min(end, at + 8 * WINDOW)
        yield b" " + data[at:stop] + b" "
        at = stop + (data[stop : stop + 1] == b" ")


def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    made = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    options = zstandard.ZstdCompressionParameters.from_level(
        5, source_size=64, dict_size=len(dictionary), format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False
    )
    made.precompute_compress(compression_params=options)
    return zstandard.ZstdCompressor(dict_data=made, compression_params=options)


def advantages(data: bytes, ordinary, toxic) -> np.ndarray:
    """How many windows the toxic dictionary compresses better by each number of bytes from ``LOW`` to ``HIGH``."""
    found = [0] * (HIGH - LOW + 1)
    for w in windows(data):
        gain = len(ordinary(w)) - len(toxic(w))
        found[(gain if LOW < gain < HIGH else LOW if gain <= LOW else HIGH) - LOW] += 1
    return np.array(found, np.int64)


def features(hist: np.ndarray, cuts: tuple[int, ...]) -> np.ndarray:
    """Highest advantages, and what exceeds the thresholds, against the number of windows."""
    n = max(1, int(hist.sum()))
    gains = np.arange(LOW, HIGH + 1)
    left, top = TOP, []
    for k in np.flatnonzero(hist)[::-1]:
        take = min(left, int(hist[k]))
        top += [int(gains[k])] * take
        left -= take
        if not left:
            break
    top += [0] * left
    over = [(hist * np.maximum(gains - c, 0)).sum() / np.sqrt(n) for c in cuts]
    return np.array([*top[:3], sum(top) / TOP, np.log(n), *over, float(hist[gains >= cuts[-1] + 2].sum())])


def grams(data: bytes) -> np.ndarray:
    a = np.frombuffer(data, np.uint8).astype(np.uint64)
    if len(a) < GRAM:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(a) - GRAM + 1, np.uint64)
    for i in range(GRAM):
        out = (out << np.uint64(8)) | a[i : len(a) - GRAM + 1 + i]
    return out


def shares(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams and in how many texts they stand."""
    seen = [np.unique(grams(b" " + t + b" ")) for t in texts]
    return np.unique(np.concatenate(seen), return_counts=True) if seen else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def telling(mine: list[bytes], other: list[bytes]) -> np.ndarray:
    """Grams within a word that recur in texts of one kind and are rare in the other kind."""
    g, n = shares(mine)
    h, m = shares(other)
    at = np.searchsorted(h, g)
    at[at == len(h)] = 0
    elsewhere = np.where(h[at] == g, m[at], 0) if len(h) else np.zeros(len(g))
    inner = np.ones(len(g), bool)
    for k in range(GRAM - 1):
        inner &= ((g >> np.uint64(8 * k)) & np.uint64(255)) > 32
    often = n >= max(3, len(mine) // OFTEN)
    return g[often & inner & (n * len(other) >= RATIO * (elsewhere + 0.5) * len(mine))]


def words_with(texts: list[bytes], wanted: np.ndarray) -> list[bytes]:
    """Words that hold one of the grams, each time they stand in a text."""
    out = []
    for t in texts:
        data = b" " + t + b" "
        at = np.flatnonzero(np.isin(grams(data), wanted))
        breaks = np.flatnonzero(np.frombuffer(data, np.uint8) <= 32)
        first = breaks[np.searchsorted(breaks, at, side="right") - 1]
        last = breaks[np.searchsorted(breaks, at + 1)]
        out += [data[a:b].strip(b" .,;:!?") for a, b in sorted(set(zip(first.tolist(), last.tolist())))]
    return out


def trained(samples: list[bytes], size: int) -> bytes:
    """Content of a dictionary from the samples; too few for training serve as they are."""
    joined = b" ".join(samples)
    if len(joined) <= 2 * size or len(samples) < 16:
        return joined[-size:]
    return zstandard.train_dictionary(size, samples, k=SEGMENT, d=DMER, f=20, accel=1, threads=1).as_bytes()[-size:]


def grouped(words: list[bytes], size: int = 16) -> list[bytes]:
    """Samples of some words each, in a fixed random order."""
    words = sorted(words)
    random.Random(42).shuffle(words)
    return [b" " + b" ".join(words[i : i + size]) + b" " for i in range(0, len(words), size)]


def dictionaries(toxic: list[bytes], ordinary: list[bytes]) -> tuple[bytes, bytes]:
    """Of ordinary and of toxic text. Both end in a part trained on windows of ordinary text, of which toxic texts consist for
    the most; in front stands what is trained on the words that tell the kind. Without the common part, chance matches would
    outweigh the few words that count."""
    rows = [w for t in ordinary for w in windows(t)]
    random.Random(42).shuffle(rows)
    common = trained(rows[: 400 * COMMON_BYTES // WINDOW], COMMON_BYTES)
    own = [trained(grouped(words_with(a, telling(a, b))), OWN_BYTES) for a, b in ((ordinary, toxic), (toxic, ordinary))]
    return own[0] + common, own[1] + common


@dataclass
class Model:
    """Dictionaries, thresholds and weights. Of fixed size."""

    ordinary: bytes = b""
    toxic: bytes = b""
    cuts: tuple[int, ...] = ()
    center: np.ndarray = field(default_factory=lambda: np.zeros(0))
    scale: np.ndarray = field(default_factory=lambda: np.zeros(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    share: float = 0.0

    def compressors(self):
        return compressor(self.ordinary).compress, compressor(self.toxic).compress

    def score(self, rows: np.ndarray) -> np.ndarray:
        z = ((rows - self.center) / self.scale) @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fit_weights(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 60) -> np.ndarray:
    """Logistic regression by Newton steps; the last weight is the offset."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        bend = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        move = np.linalg.solve(bend, x.T @ (p - y) + ridge * w)
        w -= np.clip(move, -5, 5)
        if np.abs(move).max() < 1e-9:
            break
    return w


def learn(texts: list[str | None], labels: np.ndarray) -> Model:
    """Of two texts of a kind, each is measured with dictionaries trained on the other half, which haven't seen it: that gives
    thresholds and weights. The dictionaries of the model are then trained on both halves.
    With only one kind there is nothing to compare: every score is the share of toxic rows."""
    share = float(labels.mean()) if len(labels) else 0.0
    kinds = {y: [folded(t) for t, z in zip(texts, labels) if z == y] for y in (0, 1)}
    if min(len(kinds[0]), len(kinds[1])) < 4:
        return Model(share=share)
    hists: dict[int, list[np.ndarray]] = {0: [], 1: []}
    for half in (0, 1):
        old, new = (compressor(d).compress for d in dictionaries(kinds[1][half::2], kinds[0][half::2]))
        for y in (0, 1):
            hists[y] += [advantages(t, old, new) for t in kinds[y][1 - half :: 2]]
    model = Model(*dictionaries(kinds[1], kinds[0]), share=share)
    total = np.cumsum(np.sum(hists[0], axis=0))
    model.cuts = tuple(int(LOW + np.searchsorted(total, q * total[-1])) for q in QUANTILES)
    rows = np.array([features(h, model.cuts) for y in (0, 1) for h in hists[y]])
    model.center, model.scale = rows.mean(axis=0), rows.std(axis=0) + 1e-9
    model.weights = fit_weights((rows - model.center) / model.scale, np.repeat([0.0, 1.0], [len(hists[0]), len(hists[1])]))
    return model


def held_out(key: Column) -> Column:
    """Rows that nothing is learned from, by the checksum of the key as text; a NULL key counts as held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % HELD_OUT == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic", max_toxic: int = MAX_TOXIC, max_ordinary: int = MAX_ORDINARY, max_bytes: int = MAX_BYTES) -> Model:
    """Model from labelled rows that aren't held out: at most ``max_toxic`` toxic and ``max_ordinary`` ordinary documents, in
    the order of a hash of the key, as far as their texts together hold ``max_bytes``. Only those texts reach the driver.

    Rows of a key with different labels count as toxic if at least half of them are; of repeated documents one is taken.
    """
    known = labels.filter(F.col(f"`{label}`").isNotNull() & ~held_out(F.col(f"`{key}`"))).groupBy(F.col(f"`{key}`").alias("_key"))
    known = known.agg((F.avg(f"`{label}`") >= 0.5).cast("int").alias("_y"))
    mine = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))
    order = [F.xxhash64(F.lit(42), F.col("_key")), F.col("_key")]
    sizes = mine.groupBy("_key").agg(F.max(F.octet_length(F.coalesce("_text", F.lit("")))).alias("n")).join(known, "_key")
    chosen, left = [], max_bytes
    for y, most in ((1, max_toxic), (0, max_ordinary)):
        bound = left // 2 if y else left
        for r in sizes.filter(F.col("_y") == y).orderBy(*order).limit(most).collect():  # keys and lengths only
            if r["n"] <= bound:
                bound, left = bound - r["n"], left - r["n"]
                chosen.append((r["_key"], y))
    if not chosen:
        return Model()
    wanted = docs.sparkSession.createDataFrame(chosen, mine.select("_key").schema.add("_y", "integer"))
    first = mine.join(F.broadcast(wanted), "_key").groupBy("_key", "_y").agg(F.min("_text").alias("_text"))  # bounded by the parameters
    rows = first.orderBy(*order).collect()
    return learn([r["_text"] for r in rows], np.array([r["_y"] for r in rows]))


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with a struct ``toxicity``: ``score`` and ``predicted``. Every whole text is scored; there is no shuffle and no
    other input of a score than the text. NULL and empty texts have no window and get the score of a text without any."""

    @F.pandas_udf("score double, predicted int")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        old, new = model.compressors() if len(model.weights) else (None, None)
        for texts in batches:
            if old is None:
                score = np.full(len(texts), model.share)
            else:
                rows = [features(advantages(folded(t), old, new), model.cuts) for t in texts]
                score = model.score(np.array(rows)) if rows else np.zeros(0)
            yield pd.DataFrame({"score": score, "predicted": (score >= 0.5).astype("int32")})

    return docs.select(*[F.col(f"`{c}`") for c in docs.columns], run(F.col(f"`{text}`")).alias(free_name(docs, "toxicity")))
