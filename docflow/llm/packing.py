"""Token packing: best-fit decreasing with a segment tree over the room left, written as id matrices."""

from __future__ import annotations

import base64
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEQ_LEN = 2048
BUFFER_TOKENS = 1 << 21
END_ID = 50_256
ID_TYPE = "<u2"  # all ids of the vocabulary are below 65,536

PACKED = "row_id string, n_tokens int, ids binary, cu_seqlens array<int>, position_resets array<int>, doc_ids array<bigint>, doc_parts array<int>, doc_rows array<string>"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def load(path: str, pattern: str | None = None):
    import tiktoken

    if pattern is None:
        import public_tokenizers

        pattern = public_tokenizers.PATTERN
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class RoomTree:
    """Segment tree over room sizes 0..n: finds the least room of at least a given size among open rows."""

    def __init__(self, n: int):
        self.leaves = 1 << n.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: dict[int, list[int]] = defaultdict(list)

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._add(room, 1)

    def take(self, size: int) -> tuple[int, int] | None:
        """Row and room of the tightest row that has at least ``size``, which is closed; None if there is none."""
        at = size + self.leaves
        if not self.count[at]:
            # Up until the sibling to the right has rows, then down to its first leaf.
            while at & 1 or not self.count[at + 1]:
                at >>= 1
                if at <= 1:
                    return None
            at += 1
            while at < self.leaves:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        room = at - self.leaves
        self._add(room, -1)
        return self.rows[room].pop(), room

    def _add(self, room: int, n: int) -> None:
        at = room + self.leaves
        while at:
            self.count[at] += n
            at >>= 1


def best_fit(sizes: list[int], seq_len: int) -> list[list[int]]:
    """Rows of piece numbers: pieces from the longest to the shortest, each into the row where least room is left."""
    tree, rows = RoomTree(seq_len), []
    for piece in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[piece]
        if found := tree.take(size):
            row, room = found
            rows[row].append(piece)
        else:
            row, room = len(rows), seq_len
            rows.append([piece])
        if room > size:
            tree.put(room - size, row)
    return rows


def packed(df: DataFrame, text: str = "text", key: str = "doc_id", seq_len: int = SEQ_LEN, path: str | None = None, buffer_tokens: int = BUFFER_TOKENS) -> DataFrame:
    """One row per packed sequence of at most ``seq_len`` ids.

    Every document is encoded and ended by ``END_ID``; NULL and empty texts are that id alone. Documents above ``seq_len``
    ids are split into full pieces and a rest: nothing is cut off. Pieces are packed by best fit decreasing. Each task packs
    its own documents, in buffers of about ``buffer_tokens`` ids; full pieces need no search. No text or id is shuffled.

    ``ids``: little-endian unsigned 16-bit. ``cu_seqlens``: 0 and the end of each segment. ``position_resets``: where
    positions begin again at 0, that is the start of each segment. ``doc_ids``, ``doc_parts`` name the document and the
    piece of each segment; ``doc_rows`` tells repeated documents apart.
    """
    path = path or default_path()
    docs = df.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").alias("text"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoding, task = load(path), TaskContext.get().partitionId()
        schema = pa.schema([("row_id", pa.string()), ("n_tokens", pa.int32()), ("ids", pa.binary()), ("cu_seqlens", pa.list_(pa.int32())), ("position_resets", pa.list_(pa.int32())), ("doc_ids", pa.list_(pa.int64())), ("doc_parts", pa.list_(pa.int32())), ("doc_rows", pa.list_(pa.string()))])
        pieces: list[tuple] = []
        held, made, seen = 0, 0, 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, made
            full = [[i] for i, p in enumerate(pieces) if len(p[0]) == seq_len]
            rest = [i for i, p in enumerate(pieces) if len(p[0]) < seq_len]
            bins = full + [[rest[i] for i in b] for b in best_fit([len(pieces[i][0]) for i in rest], seq_len)]
            for at in range(0, len(bins), 512):
                out = defaultdict(list)
                for b in bins[at : at + 512]:
                    ends = np.cumsum([len(pieces[i][0]) for i in b]).tolist()
                    for name, value in zip(schema.names, (f"{task}-{made}", ends[-1], b"".join(pieces[i][0].tobytes() for i in b), [0, *ends], [0, *ends[:-1]], *map(list, zip(*(pieces[i][1:] for i in b))))):
                        out[name].append(value)
                    made += 1
                yield pa.RecordBatch.from_pydict(dict(out), schema=schema)
            pieces.clear()
            held = 0

        for batch in batches:
            for doc, t in zip(batch.column("key"), batch.column("text")):
                ids = np.asarray([*encoding.encode_ordinary(t.as_py() or ""), END_ID], dtype=ID_TYPE)
                for part, at in enumerate(range(0, len(ids), seq_len)):
                    pieces.append((ids[at : at + seq_len], doc.as_py(), part, f"{task}-{seen}"))
                seen += 1
                held += len(ids)
                if held >= buffer_tokens:
                    yield from flush()
        if pieces:
            yield from flush()

    return docs.mapInArrow(rows, PACKED)


def write_packed(df: DataFrame, path: str, rows_per_matrix: int = 256, seq_len: int = SEQ_LEN) -> None:
    """Packed rows as a Parquet table of matrices: ``ids`` has ``n_rows`` rows of ``seq_len`` ids, filled up with ``END_ID``.

    Matrices are made where the rows are; a lost task is repeated and committed as a whole.
    """
    schema = "n_rows int, seq_len int, ids binary, row_ids array<string>, n_tokens array<int>, cu_seqlens array<array<int>>, position_resets array<array<int>>"

    ints = pa.list_(pa.int32())
    typed = pa.schema([("n_rows", pa.int32()), ("seq_len", pa.int32()), ("ids", pa.binary()), ("row_ids", pa.list_(pa.string())), ("n_tokens", ints), ("cu_seqlens", pa.list_(ints)), ("position_resets", pa.list_(ints))])

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            out = []
            for at in range(0, len(rows), rows_per_matrix):
                part = rows[at : at + rows_per_matrix]
                matrix = np.full((len(part), seq_len), END_ID, dtype=ID_TYPE)
                for line, r in zip(matrix, part):
                    line[: r["n_tokens"]] = np.frombuffer(r["ids"], dtype=ID_TYPE)
                names = ("row_id", "n_tokens", "cu_seqlens", "position_resets")
                own, tokens, cu, resets = ([r[c] for r in part] for c in names)
                out.append({"n_rows": len(part), "seq_len": seq_len, "ids": matrix.tobytes(), "row_ids": own, "n_tokens": tokens, "cu_seqlens": cu, "position_resets": resets})
            yield pa.RecordBatch.from_pylist(out, schema=typed)

    df.mapInArrow(matrices, schema).write.parquet(path)


def segments(df: DataFrame) -> DataFrame:
    """``doc_id, doc_row, part, ids``: the pieces of the documents again, one row each."""
    parts = F.transform(F.sequence(F.lit(1), F.size("doc_ids")), lambda i: F.struct(
        F.element_at("doc_ids", i).alias("doc_id"), F.element_at("doc_rows", i).alias("doc_row"), F.element_at("doc_parts", i).alias("part"),
        F.substring("ids", F.element_at("cu_seqlens", i) * 2 + 1, (F.element_at("cu_seqlens", i + 1) - F.element_at("cu_seqlens", i)) * 2).alias("ids"),
    ))
    return df.select(F.inline(parts))


def text_of(ids: bytes, path: str | None = None, encoding=None) -> str:
    """Text of the ids of one document, its end id left out."""
    encoding = encoding or load(path or default_path())
    return encoding.decode([i for i in np.frombuffer(ids, dtype=ID_TYPE).tolist() if i != END_ID])

