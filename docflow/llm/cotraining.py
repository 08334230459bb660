"""Quality by co-training: a classifier over the words and one over the metadata teach each other on all unlabelled rows."""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.llm.common import free_name, stored

# Bound of the labelled rows that the classifiers start from. All unlabelled rows take part in the rounds.
MAX_LABELLED = 4000
HELD_OUT = 5  # every fifth labelled row calibrates and is never trained on
ROUNDS = 4
CONFIDENT = 0.95
TAKE = 0.1  # of the unlabelled rows, by each view in each round
PSEUDO = 0.5  # weight of all pseudo-labelled rows of a label, at most, by that of its labelled rows
BINS = 1024  # of confidence, from CONFIDENT up; rows of one bin go together
BINS_PER_UNIT = 32
UNIT = 1 << 20  # feature counts of pseudo-labelled rows are summed as whole numbers: no order of tasks changes a sum
BUCKETS = 1 << 16
SMOOTH = 0.5
KEEP_FROM = 0.5
KNOWN_WORDS = 400_000
ROWS_AT_ONCE = 512


def bucket(name: bytes) -> int:
    return zlib.crc32(name) % BUCKETS


def word_features(word: bytes) -> tuple[int, int, int]:
    """The word in lower case, its last three bytes, its shape."""
    shape = b"up" if len(word) > 1 and word.isupper() else b"low" if word.islower() else b"mixed"
    return bucket(b"w" + word.lower()), bucket(b"e" + word[-3:]), bucket(b"s" + shape)


SAME, OTHER = bucket(b"same as before"), bucket(b"not as before")


class Words:
    """Features of the words that a task has met, one row each, in a table of bounded size."""

    def __init__(self):
        self.at: dict[bytes, int] = {}
        self.table = np.zeros((1 << 12, 3), np.uint16)

    def rows(self, words: list[bytes]) -> np.ndarray:
        """Three features of each word."""
        if len(self.at) > KNOWN_WORDS:
            self.at.clear()
        for w in set(words).difference(self.at):
            i = self.at[w] = len(self.at)
            if i == len(self.table):
                self.table = np.vstack([self.table, np.zeros_like(self.table)])
            self.table[i] = word_features(w)
        return self.table[np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))]


def text_counts(text: str | None, known: Words) -> tuple[np.ndarray, np.ndarray]:
    """Features of the content view, rising, with their counts; blank texts have none."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    same = sum(map(eq, words, words[1:]))
    again = np.repeat(np.array([SAME, OTHER], np.uint16), [same, len(words) - same])
    where, counts = np.unique(np.concatenate([known.rows(words).reshape(-1), again]), return_counts=True)
    return where, counts.astype(np.float32)


def meta_features(text: str | None, fields: list) -> list[int]:
    """Features of the metadata view: the given columns (numbers by size class) and the outline of the text."""
    t = text or ""
    lines = t.count("\n") + 1
    spaces = t.count(" ") + 1
    outline = {"chars": len(t), "lines": lines, "line": len(t) // lines, "word": len(t) // spaces, "bytes": len(t.encode("utf-8", "surrogatepass")) * 8 // max(1, len(t))}
    named = {f"f{i}": v for i, v in enumerate(fields)} | outline
    return [bucket(f"{k}={_class(v)}".encode("utf-8", "surrogatepass")) for k, v in named.items()]


def _class(value) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "none"
    if isinstance(value, (int, float)):
        return str(value) if 0 <= value < 16 and value == int(value) else f"2^{math.log2(abs(value) + 1):.0f}"
    return str(value)


def label_sums(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> np.ndarray:
    """Weighted counts of each feature among bad (0) and good (1) rows, in ``UNIT``s."""
    sums = np.zeros((2, BUCKETS), np.int64)
    for (where, counts), y in zip(rows, labels):
        # A long document counts for more than a short one, but not in proportion.
        np.add.at(sums[int(y)], where, np.rint(counts.astype(float) * (UNIT / math.sqrt(max(1.0, float(counts.sum()))))).astype(np.int64))
    return sums


def united(own: np.ndarray, pseudo: np.ndarray) -> np.ndarray:
    """Sums of labelled and pseudo-labelled rows. However many of the latter there are, they don't drown the former: those of a
    label weigh ``PSEUDO`` times its labelled rows at most."""
    weight = np.minimum(1.0, PSEUDO * own.sum(axis=1) / np.maximum(1, pseudo.sum(axis=1)))
    return own + pseudo * weight[:, None]


def fit_bayes(sums: np.ndarray) -> np.ndarray:
    """Log ratio of each feature's smoothed share among good and bad rows."""
    sums = sums / UNIT + SMOOTH
    shares = np.log(sums / sums.sum(axis=1, keepdims=True))
    return shares[1] - shares[0]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights of a small logistic regression, the last one the offset, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = sigmoid(x @ w)
        slope = x.T @ (p - y) + ridge * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        move = np.linalg.solve(bend, slope)
        w -= np.clip(move, -5, 5)
        if np.abs(move).max() < 1e-8:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


@dataclass
class Model:
    """Weights by bucket and calibration of each view, and the weights of their union. Of fixed size."""

    text: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS))
    meta: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS))
    text_line: np.ndarray = field(default_factory=lambda: np.zeros(2))
    meta_line: np.ndarray = field(default_factory=lambda: np.zeros(2))
    union: np.ndarray = field(default_factory=lambda: np.zeros(3))
    rounds: list[tuple[int, int]] = field(default_factory=list)

    def logits(self, text_raw: np.ndarray, meta_raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a = text_raw * self.text_line[0] + self.text_line[1]
        b = meta_raw * self.meta_line[0] + self.meta_line[1]
        return a, b, a * self.union[0] + b * self.union[1] + self.union[2]


def raw_score(weights: np.ndarray, row: tuple[np.ndarray, np.ndarray]) -> float:
    where, counts = row
    return float(weights[where] @ counts / max(1.0, counts.sum()))


@dataclass
class Round:
    """What a round has fitted, text view first: weights, calibration, and the least bin of confidence from which a view hands
    a row to the other one, by view and label (``BINS``: none). Of fixed size."""

    weights: np.ndarray
    lines: np.ndarray
    cuts: np.ndarray = field(default_factory=lambda: np.full((2, 2), BINS))


class Features:
    """Counted features of several rows in one piece, for both views."""

    def __init__(self, texts: list[tuple[np.ndarray, np.ndarray]], metas: list[np.ndarray]):
        self.n = len(metas)
        both = ([w for w, _ in texts], metas)
        self.where = [np.concatenate([np.zeros(0, np.uint16), *x]) for x in both]
        self.counts = [np.concatenate([np.zeros(0, np.float32), *[c for _, c in texts]]).astype(float), np.ones(len(self.where[1]))]
        self.row = [np.repeat(np.arange(self.n), [len(w) for w in x]) for x in both]
        self.size = [np.maximum(1.0, np.bincount(r, c, self.n)) for r, c in zip(self.row, self.counts)]

    def logits(self, at: Round) -> np.ndarray:
        """Calibrated score of each view and row."""
        raw = [np.bincount(self.row[v], at.weights[v][self.where[v]] * self.counts[v], self.n) / self.size[v] for v in (0, 1)]
        return np.stack([raw[v] * at.lines[v][0] + at.lines[v][1] for v in (0, 1)])

    def handed(self, rounds: list[Round]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The labels that each view has been given before and after the last round (-1: none yet), and what each view says in
        that round, as labels and bins of confidence (-1: not confident)."""
        given = np.full((2, self.n), -1)
        for at in rounds:
            before, z = given.copy(), self.logits(at)
            label, bins = (z > 0).astype(int), confidence(z)
            for v in (0, 1):
                new = (before[1 - v] < 0) & (bins[v] >= 0) & (bins[v] >= at.cuts[v][label[v]])
                given[1 - v][new] = label[v][new]
        return before, given, label, bins

    def confident(self, rounds: list[Round]) -> np.ndarray:
        """Rows by view, label and bin that the view could hand over in the last round, whose cuts are open yet."""
        given, _, label, bins = self.handed(rounds)
        out = np.zeros((2, 2, BINS), np.int64)
        for v in (0, 1):
            new = (given[1 - v] < 0) & (bins[v] >= 0)
            np.add.at(out[v], (label[v][new], bins[v][new]), 1)
        return out

    def taught(self, rounds: list[Round]) -> np.ndarray:
        """Sums by view, label and bucket of the rows that the last round gives to each view."""
        before, given, _, _ = self.handed(rounds)
        out = np.zeros((2, 2, BUCKETS), np.int64)
        for v in (0, 1):
            units = np.rint(self.counts[v] * (UNIT / np.sqrt(self.size[v]))[self.row[v]]).astype(np.int64)
            label = np.where(before[v] < 0, given[v], -1)[self.row[v]]
            for y in (0, 1):
                np.add.at(out[v][y], self.where[v][label == y], units[label == y])
        return out


def confidence(z: np.ndarray) -> np.ndarray:
    """Bins of calibrated scores by how far they are from 0; -1 below ``CONFIDENT``."""
    from_ = math.log(CONFIDENT / (1 - CONFIDENT))
    return np.where(np.abs(z) >= from_, np.minimum(BINS - 1, np.floor((np.abs(z) - from_) * BINS_PER_UNIT)), -1).astype(int)


def cut_of(bins: np.ndarray, most: int) -> int:
    """The lowest bin from which at most ``most`` rows are left. Where the highest bin alone has more (copies score alike), it
    goes as a whole."""
    if most < 1 or not bins.any():
        return BINS
    above, highest = np.cumsum(bins[::-1])[::-1], int(np.flatnonzero(bins)[-1])
    return min(int(np.argmax(above <= most)), highest) if above[highest] <= most else highest


class Pool:
    """All unlabelled rows as a stored frame of counted features. A pass gives vectors of fixed size: tasks add up their rows, Spark
    adds up the tasks. What earlier rounds decided on a row is told again from its features, so no state is kept of it."""

    def __init__(self, rows: DataFrame):
        self.rows = stored(rows, "cotraining-pool")
        self.size = self.rows.count()

    def total(self, of: str, rounds: list[Round], shape: tuple[int, ...]) -> np.ndarray:
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros(shape, np.int64)
            for batch in batches:
                for i in range(0, batch.num_rows, ROWS_AT_ONCE):
                    part = batch.slice(i, ROWS_AT_ONCE)
                    rows = [unpacked(*x) for x in zip(*[part.column(c).to_pylist() for c in FEATURES])]
                    sums += getattr(Features([x[:2] for x in rows], [x[2] for x in rows]), of)(rounds)
            at = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(sums.reshape(-1)[at], pa.int64())], names=["at", "n"])

        out = np.zeros(shape, np.int64)
        found = self.rows.mapInArrow(add, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
        out.reshape(-1)[found["at"].to_numpy(int)] = found["n"].to_numpy(np.int64)
        return out

    def confident(self, rounds: list[Round]) -> np.ndarray:
        return self.total("confident", rounds, (2, 2, BINS))

    def taught(self, rounds: list[Round]) -> np.ndarray:
        return self.total("taught", rounds, (2, 2, BUCKETS))


def cotrain(texts: list, metas: list, labels: np.ndarray, held: np.ndarray, pool: Callable[[], Pool], rounds: int = ROUNDS) -> Model:
    """``texts, metas, labels``: the labelled sample, 1 good, 0 bad. ``held``: rows of it that only calibrate.

    In each round, each view is fitted on its own rows, calibrated on the held-out ones, and scores the unlabelled rows that
    the other view has no label for; its most confident ones, in the proportion of the known labels, go to the other view.
    With only one label known there is nothing to learn: every score is 0.5.
    """
    model = Model()
    known, check = np.flatnonzero(~held), np.flatnonzero(held)
    if len(set(labels[known])) < 2 or len(set(labels[check])) < 2:
        return model
    rest = pool()
    share = float((labels[known] == 1).mean())
    most = [round(TAKE * rest.size * (1 - share)), round(TAKE * rest.size * share)]
    views = (texts, metas)
    own = np.stack([label_sums([rows[i] for i in known], labels[known]) for rows in views])
    pseudo = np.zeros_like(own)
    done: list[Round] = []
    for turn in range(rounds + 1):
        weights = np.stack([fit_bayes(united(own[v], pseudo[v])) for v in (0, 1)])
        raw = [np.array([raw_score(weights[v], views[v][i]) for i in check]) for v in (0, 1)]
        lines = np.stack([fit_logistic(raw[v][:, None], labels[check]) for v in (0, 1)])
        if turn == rounds or not rest.size:
            break
        done.append(Round(weights, lines))
        counts = rest.confident(done)
        done[-1].cuts = np.array([[cut_of(counts[v][y], most[y]) for y in (0, 1)] for v in (0, 1)])
        handed = [int(sum(counts[v][y][done[-1].cuts[v][y] :].sum() for y in (0, 1))) for v in (0, 1)]
        model.rounds.append((handed[0], handed[1]))
        if not any(handed):
            break
        pseudo += rest.taught(done)
    model.text, model.meta = weights
    model.text_line, model.meta_line = lines
    a, b = (raw[v] * lines[v][0] + lines[v][1] for v in (0, 1))
    model.union = fit_logistic(np.stack([a, b], axis=1), labels[check], ridge=1.0)
    return model


# Features of a row in its stored form: distinct buckets of the text, how often (see ``packed``), buckets of the metadata.
FEATURES = ("where", "counts", "meta")


def packed(where: np.ndarray, counts: np.ndarray, meta: list[int]) -> tuple[bytes, bytes, bytes]:
    """Counts take one byte each if all of a row fit, which few do not; else four."""
    small = not len(counts) or counts.max() < 256
    return np.asarray(where, np.uint16).tobytes(), np.asarray(counts, np.uint8 if small else np.float32).tobytes(), np.asarray(meta, np.uint16).tobytes()


def unpacked(where: bytes, counts: bytes, meta: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    at = np.frombuffer(where, np.uint16)
    return at, np.frombuffer(counts, np.uint8 if len(counts) == len(at) else np.float32).astype(np.float32), np.frombuffer(meta, np.uint16)


def counted(docs: DataFrame, carried: list[str], text: str, fields: tuple[str, ...]) -> DataFrame:
    """``carried`` columns and ``FEATURES`` of each row. No shuffle."""
    columns = [F.col(f"`{f}`").cast("string").alias(f"_f{i}") for i, f in enumerate(fields)]
    rows = docs.select(*carried, F.col(f"`{text}`").alias("_text"), *columns)
    own = [rows.schema[i] for i in range(len(carried))]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for batch in batches:
            out: dict[str, list[bytes]] = {c: [] for c in FEATURES}
            for t, *values in zip(*[batch.column(i).to_pylist() for i in range(len(own), batch.num_columns)]):
                for c, x in zip(FEATURES, packed(*text_counts(t, known), meta_features(t, values))):
                    out[c].append(x)
            kept = [batch.column(i) for i in range(len(own))]
            yield pa.RecordBatch.from_arrays(kept + [pa.array(x, pa.binary()) for x in out.values()], names=[f.name for f in own] + list(out))

    return rows.mapInArrow(count, T.StructType([*own, *[T.StructField(c, T.BinaryType()) for c in FEATURES]]))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality", fields: tuple[str, ...] = ("lang", "source"), max_labelled: int = MAX_LABELLED) -> Model:
    """Model from at most ``max_labelled`` labelled documents, chosen by a hash of the key, and all rows without a label.

    The counted features of the labelled sample reach the driver, and sums of fixed size; those of the unlabelled rows are
    stored once in the shared folder and read twice a round. A key with several labels takes the mean, rounded up; rows
    without a key have no label. Repeated rows are separate rows, but of a labelled key one is taken.
    """
    known = labels.filter(f"{label} IS NOT NULL AND {key} IS NOT NULL").groupBy(key).agg((F.avg(label) >= 0.5).cast("int").alias("_y"))
    keys = docs.select(key).filter(F.col(key).isNotNull()).distinct()
    chosen = keys.join(known, key).orderBy(F.xxhash64(F.lit(42), F.col(key)), F.col(key)).limit(max_labelled)  # a bounded sample
    plain = docs.select(F.col(f"`{key}`").alias("_key"), *[F.col(f"`{c}`") for c in dict.fromkeys([text, *fields])])
    rows = plain.join(F.broadcast(chosen.withColumnRenamed(key, "_key")), "_key").withColumn("_k", F.xxhash64(F.lit(42), "_key"))
    sample = counted(rows, ["_k", "_y"], text, fields).groupBy("_k").agg(F.min(F.struct("_y", *FEATURES)).alias("x")).select("_k", "x.*").toPandas()
    sample = sample.sort_values("_k", kind="stable")
    features = [unpacked(*x) for x in zip(*[sample.pop(c) for c in FEATURES])]
    texts, metas = [x[:2] for x in features], [(m, np.ones(len(m), np.float32)) for _, _, m in features]
    y = sample["_y"].to_numpy(int)
    held = np.array([i % HELD_OUT == 0 for i in range(len(y))], dtype=bool)

    def pool() -> Pool:
        # Labels grow with the rows: hashed apart at any size, and features are not sorted.
        taken = known.select(F.col(key).alias("_key")).hint("shuffle_hash")
        named = counted(plain.filter("_key IS NOT NULL"), ["_key"], text, fields).join(taken, "_key", "left_anti")
        return Pool(named.drop("_key").unionAll(counted(plain.filter("_key IS NULL"), [], text, fields)))

    return cotrain(texts, metas, y, held, pool)


def scored(docs: DataFrame, model: Model, text: str = "text", fields: tuple[str, ...] = ("lang", "source"), keep_from: float = KEEP_FROM) -> DataFrame:
    """``docs`` with a struct ``quality``: ``text_score, meta_score, score, kept``. Every row is scored; there is no shuffle.

    Blank and NULL texts have nothing to count in the content view; NULL fields are a class of their own.
    """

    @F.pandas_udf("text_score double, meta_score double, score double, kept boolean")
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        weights = model.text
        known: dict[bytes, float] = {}
        for text_column, *columns in batches:
            a, b = np.zeros(len(text_column)), np.zeros(len(text_column))
            for i, t in enumerate(text_column):
                words = (t or "").encode("utf-8", "surrogatepass").split()
                if len(known) > KNOWN_WORDS:
                    known.clear()
                for w in set(words).difference(known):
                    known[w] = float(weights[list(word_features(w))].sum())
                if words:
                    same = sum(map(eq, words, words[1:]))
                    sum_ = sum(map(known.__getitem__, words)) + same * weights[SAME] + (len(words) - same) * weights[OTHER]
                    a[i] = sum_ / (4 * len(words))
                meta = meta_features(t, [c.iloc[i] for c in columns])
                b[i] = model.meta[meta].sum() / len(meta)
            x, y, z = model.logits(a, b)
            score = sigmoid(z)
            yield pd.DataFrame({"text_score": sigmoid(x), "meta_score": sigmoid(y), "score": score, "kept": score >= keep_from})

    inputs: list[Column] = [F.col(f"`{text}`"), *[F.col(f"`{f}`").cast("string") for f in fields]]
    return docs.select(*[F.col(f"`{c}`") for c in docs.columns], run(*inputs).alias(free_name(docs, "quality")))
