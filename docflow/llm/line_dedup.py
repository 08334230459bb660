"""Line dedup by pairwise alignment with earlier documents that share rare runs of lines."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.functions.text import let
from docflow.llm.common import free_name, stored

MIN_WORDS = 5
TO_THE_END = 2**31 - 1

# Of a run of lines in a document: 128-bit hash, ranks of its first line among the lines that have a word, places of its
# first and last line among all lines (one each for every time that the run stands there), words of each line.
RUN = "h1 bigint, h2 bigint, ranks array<int>, places array<int>, ends array<int>, words array<int>"
CUT = "keep array<struct<at:int,n:int>>, removed_lines int, removed_words bigint"
BLOCK = "text_hash bigint, partner_rank int, rank int, lines int"

Runs = dict[bytes, tuple[list[int], list[int], list[int], list[int]]]


def runs_of(text: str, min_words: int = MIN_WORDS) -> Runs:
    """``ranks, places, ends, words`` of each distinct run of lines: from each line on and up to each line, the shortest
    that has ``min_words`` words. Blank lines do not count.

    Any common block of ``min_words`` words or more is the union of such runs, and each has at most ``min_words`` lines. A
    line that is long enough is a run by itself; a short one is in runs with its neighbours only, however frequent it is.
    """
    lines = text.encode("utf-8", "surrogatepass").split(b"\n")
    counts = [len(x.split()) for x in lines]
    places = [i for i, n in enumerate(counts) if n]
    upto = [0, *accumulate(counts[i] for i in places)]
    spans = set()
    for rank in range(len(places)):
        if (end := bisect_left(upto, upto[rank] + min_words, rank + 1)) <= len(places):
            spans.add((rank, end))
        if (start := bisect_right(upto, upto[rank + 1] - min_words, 0, rank + 1) - 1) >= 0:
            spans.add((start, rank + 1))
    found: Runs = {}
    for start, end in sorted(spans):
        inside = places[start:end]
        run = found.setdefault(b"\n".join([lines[i] for i in inside]), ([], [], [], [counts[i] for i in inside]))
        run[0].append(start)
        run[1].append(inside[0])
        run[2].append(inside[-1])
    return found


def run_rows(df: DataFrame, text: str, key: str, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc, text_hash`` and the columns of ``RUN``: one row per document and distinct run."""
    docs = df.select(F.col(f"`{key}`").alias("doc"), F.xxhash64(f"`{text}`").alias("text_hash"), F.col(f"`{text}`").alias("text"))
    schema = T.StructType(docs.schema.fields[:2] + T.StructType.fromDDL(RUN).fields)
    lists = pa.list_(pa.int32())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, h1, h2 = [], [], []
            found: tuple[list, ...] = ([], [], [], [])
            for i, t in enumerate(batch.column("text").to_pylist()):
                for run, values in runs_of(t or "", min_words).items():
                    code = xxhash.xxh3_128_digest(run)
                    of.append(i)
                    h1.append(int.from_bytes(code[:8], "little", signed=True))
                    h2.append(int.from_bytes(code[8:], "little", signed=True))
                    for column, value in zip(found, values):
                        column.append(value)
            own = [batch.column(c).take(pa.array(of, pa.int32())) for c in ("doc", "text_hash")]
            made = [pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), *[pa.array(c, lists) for c in found]]
            yield pa.RecordBatch.from_arrays(own + made, names=schema.names)

    return docs.mapInArrow(rows, schema)


def patience(common: list[tuple[list[int], list[int]]]) -> list[tuple[int, int]]:
    """Aligned ranks ``(a, b)``, rising in both, of the lines common to two documents (``ranks in a, ranks in b``).

    Lines that stand once in both are anchors; the longest rising run of anchors holds. Between two anchors, lines that
    stand once in that gap are anchors in turn. Where no line stands once, lines are taken in order.
    """
    aligned: list[tuple[int, int]] = []
    gaps = [(common, -1)]
    while gaps:
        lines, low = gaps.pop()
        once = [(qb[0], qa[0]) for qa, qb in lines if len(qa) == len(qb) == 1]
        anchors = _rising(sorted(once, key=lambda p: (p[0], -p[1])))  # never two at one place
        if not anchors:
            last, taken = low, None
            for b, qa in sorted((b, qa) for qa, qb in lines for b in qb):
                if b != taken and (k := bisect_left(qa, last + 1)) < len(qa):
                    last, taken = qa[k], b
                    aligned.append((last, b))
            continue
        aligned += [(a, b) for b, a in anchors]
        at_b, at_a = [b for b, _ in anchors], [low, *(a for _, a in anchors), TO_THE_END]
        held, between = set(at_b), defaultdict(list)
        for qa, qb in lines:
            mine = defaultdict(list)
            for b in qb:
                if b not in held:
                    mine[bisect_left(at_b, b)].append(b)
            for g, bs in mine.items():
                if inside := qa[bisect_right(qa, at_a[g]) : bisect_left(qa, at_a[g + 1])]:
                    between[g].append((inside, bs))
        gaps += [(rest, at_a[g]) for g, rest in between.items()]
    return sorted(aligned, key=lambda p: p[1])


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs, given by first value, in which the second value rises as well."""
    tops: list[int] = []
    at: list[int] = []
    before: list[int] = []
    for i, (_, v) in enumerate(pairs):
        k = bisect_left(tops, v)
        before.append(at[k - 1] if k else -1)
        if k == len(tops):
            tops.append(v)
            at.append(i)
        else:
            tops[k], at[k] = v, i
    run, i = [], at[-1] if at else -1
    while i >= 0:
        run.append(pairs[i])
        i = before[i]
    return run[::-1]


def _rising_chains(pairs: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """All pairs, given by first value, dealt to as few runs as can be in which the second value rises as well."""
    below: list[int] = []  # last value of each chain with its sign turned, rising
    chains: list[list[tuple[int, int]]] = []
    for pair in pairs:
        k = bisect_right(below, -pair[1])
        if k == len(below):
            below.append(-pair[1])
            chains.append([pair])
        else:
            below[k] = -pair[1]
            chains[k].append(pair)
    return chains


def common_blocks(shared: list[tuple[int, list[int], int]]) -> list[tuple[int, int, int]]:
    """Blocks ``(rank in a, rank in b, lines)`` of two documents, from ``rank in a, ranks in b, lines`` of common runs.

    The runs are aligned by patience. What that leaves out, because it stands in another order or once more, is aligned
    among itself until nothing is left; aligned runs that follow each other in both documents are one block.
    """
    lines: dict[tuple[int, int], int] = {}
    for a, bs, n in shared:
        for b in bs:
            lines[a, b] = max(n, lines.get((a, b), 0))
    main = patience([([a], bs) for a, bs, _ in shared])
    moved = sorted(lines.keys() - set(main), key=lambda p: (p[1], -p[0]))
    blocks: list[tuple[int, int, int]] = []
    for chain in [main, *([(a, b) for b, a in c] for c in _rising_chains([(b, a) for a, b in moved]))]:
        block = None
        for a, b in chain:
            n = lines[a, b]
            if block and block[0] - block[1] == a - b and b <= block[1] + block[2]:
                block = (*block[:2], max(block[2], b + n - block[1]))
                blocks[-1] = block
            else:
                block = (a, b, n)
                blocks.append(block)
    return sorted(blocks, key=lambda p: (p[1], p[0]))


def cut_of(runs: list[dict]) -> tuple[list[dict], int, int, list[dict]]:
    """What stays of a document, as slices of its lines (from 1), the lines and words that go, and the aligned blocks.

    ``runs``: those that an earlier document has, each with that document and its rank there. Blank lines between lines
    that go, go too.
    """
    partners = defaultdict(list)
    place, words = {}, {}
    for x in runs:
        n = len(x["words"])
        partners[(x["first"]["doc"], x["first"]["text_hash"])].append((x["first"]["rank"], x["ranks"], n))
        for rank, at, end in zip(x["ranks"], x["places"], x["ends"]):
            place[rank], place[rank + n - 1] = at, end
            words.update(zip(range(rank, rank + n), x["words"]))
    blocks = [(b, a, n, *who) for who, shared in partners.items() for a, b, n in common_blocks(shared)]
    blocks.sort(key=lambda x: (x[0], x[1], x[2], str(x[3]), x[4]))
    gone: list[list[int]] = []
    for b, _, n, *_ in blocks:
        if gone and b <= gone[-1][1] + 1:
            gone[-1][1] = max(gone[-1][1], b + n - 1)
        else:
            gone.append([b, b + n - 1])
    keep, at = [], 0
    for first, last in gone:
        if place[first] > at:
            keep.append({"at": at + 1, "n": place[first] - at})
        at = place[last] + 1
    keep.append({"at": at + 1, "n": TO_THE_END - at - 1})
    listed = [{"doc": doc, "text_hash": h, "partner_rank": a, "rank": b, "lines": n} for b, a, n, doc, h in blocks]
    return keep, sum(y - x + 1 for x, y in gone), sum(words[b] for x, y in gone for b in range(x, y + 1)), listed


def line_cuts(df: DataFrame, text: str = "text", key: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """``doc, text_hash``, the columns of ``CUT`` and the aligned ``blocks`` for each document that loses lines.

    Documents meet through the hashes of short runs of lines, which are rare where a single line is frequent. Each run
    leads a later document to the first one that has it, at its first place there: one link of fixed size per document and
    run, however many have it, and none is left out for being frequent. As every common block is a union of such runs,
    none is lost when its runs lead to different documents. The order is by key (NULL last), then text hash; rows equal in
    both count as one document.
    """
    rows = stored(run_rows(df, text, key, min_words), "line-rows")
    who = [F.col("doc").isNull().alias("no_key"), F.col("doc"), F.col("text_hash")]
    place = F.element_at("ranks", 1).alias("rank")
    first = rows.groupBy("h1", "h2").agg(F.min(F.struct(*who, place)).alias("first"), F.max(F.struct(*who)).alias("last"))
    shared = stored(first.filter("struct(first.no_key, first.doc, first.text_hash) <> last").drop("last"), "line-shared")
    led = rows.join(shared, ["h1", "h2"]).filter(~(F.col("doc").eqNullSafe(F.col("first.doc")) & (F.col("text_hash") == F.col("first.text_hash"))))
    # A set: repeated rows of a document tell the same.
    listed = led.groupBy("doc", "text_hash").agg(F.collect_set(F.struct("ranks", "places", "ends", "words", "first")).alias("runs"))
    block = T.StructType([rows.schema["doc"], *T.StructType.fromDDL(BLOCK)])
    schema = T.StructType([*rows.schema.fields[:2], *T.StructType.fromDDL(CUT), T.StructField("blocks", T.ArrayType(block))])
    kept = pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32())]))

    def cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [cut_of(x.as_py()) for x in batch.column("runs")]
            keep, lines, words, blocks = zip(*made) if made else ((), (), (), ())
            own = [batch.column(c) for c in ("doc", "text_hash")]
            ints = [(n, pa.int32()) for n in ("partner_rank", "rank", "lines")]
            aligned = pa.list_(pa.struct([("doc", own[0].type), ("text_hash", pa.int64()), *ints]))
            yield pa.RecordBatch.from_arrays(
                own + [pa.array(keep, kept), pa.array(lines, pa.int32()), pa.array(words, pa.int64()), pa.array(blocks, aligned)], names=schema.names
            )

    return listed.mapInArrow(cuts, schema)


def line_blocks(df: DataFrame, text: str = "text", key: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """``doc, text_hash, rank, lines, partner, partner_text_hash, partner_rank``: each block that goes and where an earlier
    document has it. Ranks count the lines that have a word, from 0."""
    rows = line_cuts(df, text, key, min_words).select("doc", "text_hash", F.explode("blocks").alias("b"))
    partner = [F.col("b.doc").alias("partner"), F.col("b.text_hash").alias("partner_text_hash"), "b.partner_rank"]
    return rows.select("doc", "text_hash", "b.rank", "b.lines", *partner)


def remove_repeated_lines(df: DataFrame, text: str = "text", key: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """``df`` with the repeated blocks cut out of ``text``, and a struct ``line_dedup``: ``removed_lines, removed_words,
    emptied`` (all words are gone).

    Lines go that stand in a run of ``min_words`` words or more which an earlier document has as well, line after line.
    Blank lines go between two lines that go. NULL and blank texts stay as they are. Texts are shuffled once,
    by key and text hash.
    """
    cuts = stored(line_cuts(df, text, key, min_words).drop("blocks"), "line-cuts")
    hashed = free_name(df, "_text_hash")
    same = F.col(f"d.`{key}`").eqNullSafe(F.col("c.doc")) & (F.col(f"d.{hashed}") == F.col("c.text_hash"))
    joined = df.withColumn(hashed, F.xxhash64(f"`{text}`")).alias("d").join(cuts.alias("c"), same, "left")
    pieces = let(F.split(F.col(f"d.`{text}`"), "\n"), lambda ls: F.flatten(F.transform(F.col("c.keep"), lambda k: F.slice(ls, k["at"], k["n"]))))
    left = F.when(F.col("c.keep").isNull(), F.col(f"d.`{text}`")).otherwise(F.array_join(pieces, "\n"))
    stats = F.struct(
        F.coalesce("c.removed_lines", F.lit(0)).alias("removed_lines"),
        F.coalesce("c.removed_words", F.lit(0)).cast("long").alias("removed_words"),
    )
    out = free_name(df, "line_dedup")
    columns = [(left.alias(c) if c == text else F.col(f"d.`{c}`")) for c in df.columns]
    done = joined.select(*columns, stats.alias(out))
    emptied = (F.col(f"`{out}`.removed_lines") > 0) & ~F.col(f"`{text}`").rlike(r"[^ \t-\r]")
    return done.withColumn(out, F.col(f"`{out}`").withField("emptied", F.coalesce(emptied, F.lit(False))))


def line_deduped(df: DataFrame, text: str = "text", key: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of ``df`` that still have a word of their own, or had none to begin with, with the columns of ``df``."""
    out = remove_repeated_lines(df, text, key, min_words)
    return out.filter(~F.col(f"`{out.columns[-1]}`.emptied")).select(*[F.col(f"`{c}`") for c in df.columns])
