"""BPE encoding and decoding of whole texts, long unsplit runs by tree concatenation.

The tokenizer is one whose pieces never hold white space (``word_bpe_49k.json``): a text is the concatenation of its runs
between ASCII white space. Runs repeat, so each distinct one is encoded once per task. A run too long for that is cut
into halves again and again; the leaves are encoded side by side, and each join is mended by encoding a window around it
that grows until its tokens meet those of both sides.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.llm.common import free_name

LEAF_CHARS = 4096
WINDOW_CHARS = 256
# Tokens nearer to a cut than this prove nothing: a special token or a contraction may lie across the cut.
MARGIN_CHARS = 32
SAME_TOKENS = 4
CACHE_RUNS = 150_000
SLICE_ROWS = 256
MARKS = frozenset([b".", b",", b";", b":", b"!", b"?"])

Tokens = tuple[list[int], list[int], list[int]]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def load(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def tree_encode(tokenizer, text: str, leaf: int = LEAF_CHARS, window: int = WINDOW_CHARS) -> list[int]:
    """Ids of the whole text, from leaves of at most ``leaf`` characters."""
    cuts = [0, len(text)]
    while max(b - a for a, b in zip(cuts, cuts[1:])) > leaf:
        cuts = sorted({*cuts, *((a + b) // 2 for a, b in zip(cuts, cuts[1:]))})
    found = tokenizer.encode_batch([text[a:b] for a, b in zip(cuts, cuts[1:])], add_special_tokens=False)
    parts = [_placed(e, a) for e, a in zip(found, cuts)]
    while len(parts) > 1:
        joined = [_join(tokenizer, text, cuts[k], cuts[k + 1], cuts[k + 2], parts[k], parts[k + 1], window) for k in range(0, len(parts) - 1, 2)]
        parts, cuts = joined + parts[len(joined) * 2 :], cuts[::2] + (cuts[-1:] if len(parts) % 2 else [])
    return parts[0][0]


def _placed(encoding, shift: int) -> Tokens:
    return encoding.ids, [a + shift for a, _ in encoding.offsets], [b + shift for _, b in encoding.offsets]


def _join(tokenizer, text: str, start: int, cut: int, end: int, left: Tokens, right: Tokens, window: int) -> Tokens:
    """Tokens of ``text[start:end]`` from those of its two sides.

    The window begins at a token of the left side. If its first tokens are those of the left side, and later ones are
    tokens of the right side, away from the cuts, then every two neighbours of left part, window and right part stand
    together in a right encoding, and so the whole is one. A window over both sides is right without any meeting.
    """
    while True:
        low, high = max(start, cut - window), min(end, cut + window)
        first = bisect_left(left[1], low) if low > start else 0
        low = (left[1][first] if first < len(left[1]) else cut) if low > start else start
        middle = _placed(tokenizer.encode(text[low:high], add_special_tokens=False), low)
        head = low == start or _same(middle, 0, left, first, cut - MARGIN_CHARS)
        tail = (len(middle[0]), len(right[0])) if high == end else _meeting(middle, right, cut + MARGIN_CHARS, high - MARGIN_CHARS)
        if head and tail:
            a, b = tail
            return tuple(x[:first] + y[:a] + z[b:] for x, y, z in zip(left, middle, right))
        window *= 2


def _same(a: Tokens, i: int, b: Tokens, j: int, limit: int) -> bool:
    """Whether the next ``SAME_TOKENS`` tokens are equal in id and place and end by ``limit``."""
    if i + SAME_TOKENS > len(a[0]) or j + SAME_TOKENS > len(b[0]) or a[2][i + SAME_TOKENS - 1] > limit:
        return False
    return all(x[i : i + SAME_TOKENS] == y[j : j + SAME_TOKENS] for x, y in zip(a, b))


def _meeting(middle: Tokens, right: Tokens, low: int, high: int) -> tuple[int, int] | None:
    """Places in both at which equal tokens begin, at or after ``low`` and ending by ``high``."""
    i = bisect_left(middle[1], low)
    while i < len(middle[0]) and middle[2][i] <= high:
        j = bisect_left(right[1], middle[1][i])
        while j < len(right[0]) and right[1][j] == middle[1][i]:
            if _same(middle, i, right, j, high):
                return i, j
            j += 1
        i += 1
    return None


class RunEncoder:
    """Encodes texts run by run. Runs are kept while there is room; then those stay that came up again."""

    def __init__(self, path: str, leaf: int = LEAF_CHARS, room: int = CACHE_RUNS):
        self.tokenizer, self.leaf, self.room = load(path), leaf, room
        self.known: dict[bytes, bytes] = {}
        self.again: set[bytes] = set()

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit integers, one string per text."""
        runs = [t.split() for t in texts]
        here = set().union(*runs)
        self.again.update(here & self.known.keys())
        if len(self.known) + len(here) > self.room:
            kept = self.again if len(self.again) < self.room // 2 else set()
            self.known = {r: self.known[r] for r in kept}
            self.again = set()
        self._learn(here.difference(self.known))
        return [b"".join(map(self.known.__getitem__, r)) for r in runs]

    def _learn(self, new: set[bytes]) -> None:
        # A mark after an ASCII letter or digit is a piece of its own: only what stands before it is encoded.
        marked = [r for r in new if r[-1:] in MARKS and r[-2:-1].isalnum()]
        plain = new.difference(marked).union(r[:-1] for r in marked).difference(self.known)
        short = [r for r in plain if len(r) <= self.leaf]
        # One by one: a batch call would start threads in every worker, beside the tasks that already fill the cores.
        encode = self.tokenizer.encode
        for r in short:
            self.known[r] = array("I", encode(r.decode(), add_special_tokens=False).ids).tobytes()
        for r in plain.difference(short):
            self.known[r] = array("I", tree_encode(self.tokenizer, r.decode(), self.leaf)).tobytes()
        for r in marked:
            mark = r[-1:]
            if mark not in self.known:
                self.known[mark] = array("I", self.tokenizer.encode(mark.decode(), add_special_tokens=False).ids).tobytes()
            self.known[r] = self.known[r[:-1]] + self.known[mark]


class Decoder:
    """The library's decode for a tokenizer without decoder: token strings joined by one space, unknown ids left out."""

    def __init__(self, tokenizer):
        self.names = {i: s for s, i in tokenizer.get_vocab(with_added_tokens=True).items()}

    def decode(self, ids: bytes) -> str:
        names = self.names
        return " ".join([names[i] for i in array("I", ids) if i in names])


def encode_documents(df: DataFrame, text: str = "text", path: str | None = None, leaf: int = LEAF_CHARS) -> DataFrame:
    """``df`` with a struct column ``bpe``: ``n_tokens``, ``ids`` (little-endian unsigned 32-bit) and ``decoded``.

    NULL text counts as empty and has no ids. No row is moved: there is no shuffle. Rows go out in small slices, so a
    worker holds few results at a time.
    """
    path = path or default_path()
    name = free_name(df, "bpe")
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.StructType.fromDDL("n_tokens bigint, ids binary, decoded string"))])
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = RunEncoder(path, leaf)
        decoder = Decoder(encoder.tokenizer)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                ids = encoder.encode([(t or "").encode() for t in part.column(at).to_pylist()])
                made = [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array(map(decoder.decode, ids), pa.string())]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.StructArray.from_arrays(made, ["n_tokens", "ids", "decoded"])], names=schema.names)

    return df.mapInArrow(run, schema)


def decode_ids(df: DataFrame, ids: str = "ids", path: str | None = None) -> DataFrame:
    """``df`` with a column ``decoded``; NULL ids give an empty text."""
    path = path or default_path()
    schema = T.StructType([*df.schema.fields, T.StructField(free_name(df, "decoded"), T.StringType())])
    at = df.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(load(path))
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                texts = pa.array([decoder.decode(x or b"") for x in part.column(at).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, texts], names=schema.names)

    return df.mapInArrow(run, schema)


def digests(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """``key, n_tokens, ids_sha256, decoded_sha256`` of every document."""
    bpe = encode_documents(df.select(F.col(key).alias("_key"), F.col(text).alias("_text")), "_text", path)
    return bpe.select(
        F.col("_key").alias(key),
        "bpe.n_tokens",
        F.sha2("bpe.ids", 256).alias("ids_sha256"),
        F.sha2(F.col("bpe.decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
