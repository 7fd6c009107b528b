"""Document fingerprints by locally consistent parsing.

A text's code points are names of level 0. On each level, deterministic coin tossing turns the
names into small labels that depend on a few neighbours only: equal neighbours are first
told apart by a run rule, then each name is replaced by the lowest bit in which it differs from its left
neighbour (twice the bit's index plus the bit), repeated until labels are below a constant. Local
maxima of the labels start phrases; a phrase's name is a hash of the names in it, and the names are the next level's
text. A phrase boundary depends on a bounded neighbourhood, so equal substrings get the same interior
phrases at any offset.

The fingerprint is a one-permutation MinHash of the distinct phrase names of the upper levels (those with mean phrase
lengths of about 8 to 60 code points): 64 registers of 32 bits, in hex. Likeness is the share of equal registers among those filled in
either. Every level is computed for whole batches of texts by vector operations, linear in the text;
memory is bounded by the batch (texts are taken until CODE_POINTS are together).

The edited text of a document needs the next document. Documents are range-partitioned on their id, once, and sorted;
each range is read in order, so a document's next one is at hand, but for the last of a range. Each range also hands out its first and its last document, and a small
join gives the last of each range its next one (the very last: the very first).

Defined results: null text is empty text; the empty text has the fingerprint of 64 empty registers, and
two empty fingerprints have likeness 1; equal ids are ordered by text, so repeated rows follow one another; null ids come first; very long
texts are whole; an only document is its own next one; an empty table gives no rows; further columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gneiss.session import materialize, table

REGISTERS = 64
LEVELS = 4
FIRST_LEVEL = 2  # phrases below this level are too short to tell texts apart
CODE_POINTS = 1 << 20
RANGE_BYTES = 8 << 20
#: Odd multipliers of a 64-bit finaliser.
MIX_1, MIX_2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
STEP = np.uint64(0x9E3779B97F4A7C15)
EMPTY = 0xFFFFFFFF
CUT = 64  # characters of a text that ranges are cut by, after the id


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * MIX_1
    x = (x ^ (x >> np.uint64(33))) * MIX_2
    return x ^ (x >> np.uint64(33))


def _toss(labels: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One round of deterministic coin tossing against the left neighbour; first marks each text's first name."""
    left = np.empty_like(labels)
    left[1:] = labels[:-1]
    left[first] = ~labels[first]
    differ = labels ^ left
    low = differ & (~differ + np.uint64(1))
    bit = np.where(low == 0, np.uint64(63), np.bitwise_count(low - np.uint64(1)).astype(np.uint64))
    return bit * np.uint64(2) + ((labels >> bit) & np.uint64(1))


def next_level(names: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The phrases of many texts at once. names: 64-bit names; text: the text of each name, ascending."""
    n = len(names)
    first = np.empty(n, bool)
    first[0] = True
    first[1:] = text[1:] != text[:-1]
    # a run of equal names is one name of its own: coin tossing needs unequal neighbours
    start = first.copy()
    start[1:] |= names[1:] != names[:-1]
    at = np.flatnonzero(start)
    length = np.diff(np.append(at, n)).astype(np.uint64)
    kind = names[at]
    runs = length > 1
    kind[runs] = _mix(kind[runs] + STEP * length[runs])
    owner = text[at]
    first = first[at]
    labels = kind
    for _ in range(3):  # 64 bits, then below 128, 14 and 8
        labels = _toss(labels, first)
    labels = labels * np.uint64(256) + (kind >> np.uint64(56))  # equal labels are told apart by the names themselves
    m = len(kind)
    left = np.zeros(m, np.uint64)
    right = np.zeros(m, np.uint64)
    left[1:] = labels[:-1]
    right[:-1] = np.where(first[1:], 0, labels[1:])  # a text's last name has no right neighbour
    top = (labels > left) & (labels >= right)
    top[first] = True
    # no phrase of one name: a start right after another start is dropped unless it begins a text
    close = np.zeros(m, bool)
    close[1:] = top[:-1]
    top &= ~close | first
    heads = np.flatnonzero(top)
    place = np.arange(m) - np.repeat(heads, np.diff(np.append(heads, m)))
    salted = _mix(kind + STEP * (place.astype(np.uint64) + np.uint64(1)))
    return _mix(np.add.reduceat(salted, heads)), owner[heads]


def _registers(names: np.ndarray, text: np.ndarray, n: int, into: np.ndarray) -> None:
    """Minimum of the hashes of a text's names in each of its registers."""
    h = _mix(names + STEP)
    slot = text * REGISTERS + (h & np.uint64(REGISTERS - 1)).astype(np.int64)
    value = ((h >> np.uint64(24)) % np.uint64(EMPTY)).astype(np.uint32)
    np.minimum.at(into, slot, value)


def fingerprints(texts: list[str]) -> np.ndarray:
    """A row of registers for each text."""
    n = len(texts)
    out = np.full(n * REGISTERS, EMPTY, np.uint32)
    sizes = np.array([len(t) for t in texts], np.int64)
    if sizes.sum():
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        names, text = _mix(codes.astype(np.uint64) + STEP), np.repeat(np.arange(n), sizes)
        for level in range(1, LEVELS + 1):
            names, text = next_level(names, text)
            if level >= FIRST_LEVEL:
                _registers(names + np.uint64(level), text, n, out)
    return out.reshape(n, REGISTERS)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal registers among those filled in either; 1 if none is."""
    filled = (a != EMPTY) | (b != EMPTY)
    equal = ((a == b) & filled).sum(1)
    return np.where(filled.any(1), equal / np.maximum(filled.sum(1), 1), 1.0)


def _packed(rows: np.ndarray) -> list[bytes]:
    return [r.astype(">u4").tobytes() for r in rows]


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = "doc_id long, n_chars long, sha binary, print binary, edited_print binary, near_edited double, near_next double"
SCHEMA = f"range long, edge int, text string, {RESULT}"


def _results(ids: list, texts: list[str], following: list[str]) -> list[pa.Array]:
    """The columns of RESULT."""
    n = len(texts)
    changed = [edited(a, b) for a, b in zip(texts, following)]
    chain = texts[1:] == following[:-1]
    prints = fingerprints([*texts, following[-1]] if chain else texts + following)
    after = prints[1:] if chain else prints[n:]
    of_edited = fingerprints(changed)
    return [
        pa.array(ids, pa.int64()),
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest() for t in changed], pa.binary()),
        pa.array(_packed(prints[:n]), pa.binary()),
        pa.array(_packed(of_edited), pa.binary()),
        pa.array(likeness(prints[:n], of_edited), pa.float64()),
        pa.array(likeness(prints[:n], after), pa.float64()),
    ]


def _in_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of a range, sorted -> SCHEMA: results of all but the last one (edge 0), and the first (1) and the last (2) as texts."""
    number = TaskContext.get().partitionId()
    names = ["range", "edge", "text", *(f.split()[0] for f in RESULT.split(", "))]

    def edge(kind: int, doc_id, text: str) -> pa.RecordBatch:
        blank = [pa.nulls(1, t) for t in (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64())]
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([kind], pa.int32()), pa.array([text], pa.string()), pa.array([doc_id], pa.int64()), *blank], names=names)

    def done() -> pa.RecordBatch:
        n = len(ids) - 1
        made = _results(ids[:-1], texts[:-1], texts[1:])
        return pa.RecordBatch.from_arrays([pa.array([number] * n, pa.int64()), pa.array([0] * n, pa.int32()), pa.nulls(n, pa.string()), *made], names=names)

    ids, texts, size, started = [], [], 0, False
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if not started:
                started = True
                yield edge(1, doc_id, text)
            ids.append(doc_id)
            texts.append(text)
            size += len(text)
            if size >= CODE_POINTS and len(ids) > 1:
                yield done()
                ids, texts, size = ids[-1:], texts[-1:], len(texts[-1])
    if len(ids) > 1:
        yield done()
    if started:
        yield edge(2, ids[-1], texts[-1])


def _at_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, following) -> RESULT."""
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            ids, texts, following = (c.to_pylist() for c in batch.slice(at, 64).columns)
            yield pa.RecordBatch.from_arrays(_results(ids, texts, following), names=[f.split()[0] for f in RESULT.split(", ")])


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text", ranges: int | None = None) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row of docs."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    if ranges is None:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        ranges = max(1, -(-size // RANGE_BYTES))
    order = F.col("doc_id").asc_nulls_first()
    # the beginning of a text only cuts the ranges of one id; within a range whole texts are sorted
    dealt = rows.repartitionByRange(ranges, order, F.substring("text", 1, CUT)).sortWithinPartitions(order, "text")
    made = materialize(dealt.mapInArrow(_in_range, SCHEMA), "fingerprints")
    names = [f.split()[0] for f in RESULT.split(", ")]
    first = made.where("edge = 1").select(F.col("range").alias("next"), F.col("text").alias("following"))
    # one number for each range, so a row for each RANGE_BYTES of text
    numbers = first.select("next").agg(F.sort_array(F.collect_list("next")).alias("n"))
    follow = numbers.select(F.explode(F.arrays_zip(F.col("n").alias("range"), F.concat(F.slice("n", 2, F.greatest(F.size("n"), F.lit(1))), F.slice("n", 1, 1)).alias("next"))).alias("p")).select("p.range", "p.next")
    last = made.where("edge = 2").select("range", "doc_id", "text").join(follow, "range").join(first, "next")
    ends = last.select("doc_id", "text", "following").mapInArrow(_at_edges, RESULT)
    every = made.where("edge = 0").select(*names).unionByName(ends)
    code = lambda c: F.lower(F.hex(c))
    return every.select("doc_id", "n_chars", code("sha").alias("edited_sha256"), code("print").alias("fingerprint"), code("edited_print").alias("edited_fingerprint"), "near_edited", "near_next")


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))
