"""LM scoring by a probabilistic suffix tree over words.

Tokens are words (`[^\\x20\\x09-\\x0D]+`, A-Z lower-cased) and one end. The tree's symbols are these tokens; contexts are the
last 0 to CONTEXT words (a text begins after two ends), so a context grows past a word.

Learning. The root has N training tokens of V kinds. A longer context is looked at if training has it MIN_COUNT times, at
any size of the corpus, and its suffix is looked at too. It is retained if its next-symbol distribution differs from its
parent's (the context without its first word): count * KL(child || parent) above DIVERGENCE nats; two words that occur more than
HOT times are retained whatever follows them. Every distribution is smoothed with its parent's:
(n(c, x) + m * P(x | parent)) / (n(c) + m), with m = ESCAPE * n(c) ** GROWTH (V for the root). Below the root stands a
spelling model, so words never seen have a probability too: it spells a word by its UTF-8 bytes and a closing space,
by contexts of up to SPELLED bytes of the training words (each distinct word once); contexts of two and more bytes are hashed to CELLS cells,
which bounds that model whatever the corpus holds.

Scoring. Each token takes the distribution of the longest retained context before it.

At scale. Texts are packed into groups of GROUP characters, written once as a table that also holds their ids. A group's distinct words and
word pairs go to shards, sorted and as differences, with their training counts; a shard adds up the groups' counts and answers
each group in the order of its question, so words and pairs do not travel back. With these answers a
group knows its words, its pairs and so the chances after one word; then it asks for three words in a row where training has the first two
MIN_COUNT times. Shards are chosen by the whole pair, or by the two words of the context (by the third too if the context is hot), so
no frequent word meets in one task. There are more groups and shards as the input grows; the spelling model
is the only broadcast. The divergence of one-word contexts is summed by the groups: each pair counts in the first group that has it.

Base: log10((c + 0.5) / (N + 0.5 * (V + 1))) with the exact corpus counts from the same answers. Words are counted as
text; pairs and triples are told apart by 52 and 72 to 80 bits of hashes.

Defined results: null text is the empty text (one token, the end); repeated rows are scored each, null
ids are held in; ties do not occur, as scores do not depend on an order; very long texts are a group of their own and whole;
without training texts N = V = 0 and words are spelled by a uniform model; an empty table gives no rows; further columns,
whatever their names, are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from gneiss.session import materialize, table

CONTEXT = 2
MIN_COUNT = 2
DIVERGENCE = 8.0
ESCAPE, GROWTH = 5.0, 0.7
NAT = 64  # parts of a nat that a group's share of a divergence is rounded to
PAIR_BITS = 52
HOT = 1 << 20  # occurrences of a context whose words are dealt over shards
SPELLED = 3
CELLS = {2: 1 << 14, 3: 1 << 15}
HELD_OUT = 1
FOLDS = 5
END, SPACE, BITS = 256, 0x20, 9
GROUP = 1 << 23  # characters of a group of texts
SHARD = 1 << 23  # characters of all texts for which there is one shard more
LEAST_SHARDS = 64
#: Odd multipliers of a 64-bit finaliser.
MIX_1, MIX_2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
STEP = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[bytes]:
    """bytes.lower() and bytes.split() know exactly A-Z and \\x20, \\x09-\\x0D."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * MIX_1
    x = (x ^ (x >> np.uint64(33))) * MIX_2
    return x ^ (x >> np.uint64(33))


def _squeeze(x: np.ndarray) -> bytes:
    """An array, byte by byte place and compressed."""
    x = np.ascontiguousarray(x)
    planes = x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()
    return len(x).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True) if len(x) else bytes(8)


def _spread(packed: bytes, kind: type) -> np.ndarray:
    n, size = int.from_bytes(packed[:8], "little"), np.dtype(kind).itemsize
    if not n:
        return np.empty(0, kind)
    planes = pa.decompress(packed[8:], decompressed_size=n * size, codec="zstd", asbytes=True)
    return np.frombuffer(planes, np.uint8).reshape(size, n).T.copy().view(kind).ravel()


def _distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values, and the place of each value among them."""
    order = np.argsort(codes)
    held = codes[order]
    first = np.ones(len(held), bool)
    first[1:] = held[1:] != held[:-1]
    place = np.empty(len(held), np.int64)
    place[order] = np.cumsum(first) - 1
    return held[first], place


# Spelling: the chance of a word by its bytes


def _runs(spelled: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Runs of SPELLED + 1 bytes (the last one lowest) that end at each byte of each word and its space, and the word of each."""
    lead = np.full(SPELLED, END, np.uint64)
    sizes = np.array([len(w) + 1 for w in spelled], np.int64)
    whole = np.frombuffer(b" ".join(spelled) + b" ", np.uint8).astype(np.uint64) if spelled else np.empty(0, np.uint64)
    own = np.repeat(np.arange(len(spelled)), sizes)
    stream = np.full(len(whole) + SPELLED * len(spelled), END, np.uint64)
    at = np.arange(len(whole)) + SPELLED * (own + 1)
    stream[at] = whole
    stream = np.concatenate([lead, stream])
    out = np.zeros(len(whole), np.uint64)
    for k in range(SPELLED, -1, -1):
        out = (out << np.uint64(BITS)) | stream[at + SPELLED - k]
    return out, own


def _cells(runs: np.ndarray, depth: int) -> np.ndarray:
    """The number of each run's context of `depth` bytes, in a space of its own for each depth."""
    context = (runs >> np.uint64(BITS)) & np.uint64((1 << BITS * depth) - 1)
    if depth in CELLS:
        context = ((context * STEP) >> np.uint64(40)) % np.uint64(CELLS[depth])
    return context.astype(np.int64) + depth * (1 << 20)


def spelling_counts(known: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(context and byte, count) over distinct words, for contexts of all depths."""
    runs, place = _distinct(_runs(known)[0])
    n = np.bincount(place, minlength=len(runs))
    keys = np.concatenate([_cells(runs, d) * 256 + (runs & np.uint64(255)).astype(np.int64) for d in range(SPELLED + 1)])
    found, place = _distinct(keys)
    return found, np.bincount(place, np.tile(n, SPELLED + 1), len(found)).astype(np.int64)


class Spelling:
    """The spelling model of counts: (context * 256 + byte, sorted) and how often."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, self.counts = keys, counts
        self.cells, place = _distinct(keys >> 8)
        self.total = np.bincount(place, counts, len(self.cells))
        self.kinds = np.bincount(place, minlength=len(self.cells)).astype(float)

    @staticmethod
    def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(keys):
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return at, keys[at] == wanted

    def chance(self, spelled: list[bytes]) -> np.ndarray:
        """P(word) of each word; the end, which is not spelled, has 1 / 257."""
        if not spelled:
            return np.empty(0)
        runs, own = _runs(spelled)
        runs, place = _distinct(runs)
        p = np.full(len(runs), 1 / 256)
        for depth in range(SPELLED + 1):
            cell = _cells(runs, depth)
            at, there = self._find(self.cells, cell)
            if not len(self.cells):
                break
            n_at, seen = self._find(self.keys, cell * 256 + (runs & np.uint64(255)).astype(np.int64))
            n = np.where(seen, self.counts[n_at], 0)
            p = np.where(there, (n + self.kinds[at] * p) / (self.total[at] + self.kinds[at]), p)
        return 256 / 257 * np.exp(np.bincount(own, np.log(p)[place], len(spelled)))


# Groups of texts


def _packing(limit: int):
    return lambda batches: _packed(batches, limit)


def _packed(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """(row, id, held_out, text) -> a row a group of `limit` characters: its distinct words, and the texts as numbers of words, 0 being the end."""
    ids, held, sizes, parts, number, size, name, kind = [], [], [], [], None, 0, None, None

    def start():
        nonlocal ids, held, sizes, parts, number, size, name
        ids, held, sizes, parts, size, name = [], [], [], [], 0, None
        number = defaultdict()
        number.default_factory = number.__len__
        number[b""]

    def out():
        said = b" ".join(list(number)[1:])
        tokens = np.concatenate(parts)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([name], pa.int64()),
                pa.array([ids], pa.list_(kind)),
                pa.array([_squeeze(np.array(held, np.uint8))], pa.binary()),
                pa.array([_squeeze(np.array(sizes, np.uint32))], pa.binary()),
                pa.array([_squeeze(np.frombuffer(said, np.uint8))], pa.binary()),
                pa.array([_squeeze(tokens)], pa.binary()),
                pa.array([len(held) - sum(held)], pa.int64()),
                pa.array([size], pa.int64()),
            ],
            names=["group", "ids", "held", "sizes", "words", "tokens", "ends", "size"],
        )

    start()
    for batch in batches:
        kind = batch.column(1).type
        for at in range(0, batch.num_rows, 256):
            for row, own_id, out_of_it, text in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)):
                name = row if name is None else name
                own = words(text)
                ids.append(own_id)
                held.append(bool(out_of_it))
                sizes.append(len(own) + 1)
                parts.append(np.fromiter(map(number.__getitem__, [*own, b""]), np.uint32, len(own) + 1))
                size += len(text or "") + 1
                if size >= limit:
                    yield out()
                    start()
    if ids:
        yield out()


class Group:
    """A packed group: tokens and the text of each, distinct words and distinct pairs with their places among shards."""

    def __init__(self, row: dict, shards: int):
        self.shards = shards
        said = _spread(row["words"], np.uint8).tobytes()
        self.words = [b"", *(said.split(b" ") if said else [])]
        self.tokens = _spread(row["tokens"], np.uint32).astype(np.int64)
        sizes = _spread(row["sizes"], np.uint32).astype(np.int64)
        self.held = _spread(row["held"], np.uint8).astype(bool)
        self.text = np.repeat(np.arange(len(sizes)), sizes)
        self.trained = ~self.held[self.text]
        self.first = np.zeros(len(self.tokens), bool)
        self.first[np.cumsum(sizes)[:-1]] = True
        self.first[:1] = True
        self.hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.words), np.uint64, len(self.words))
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        before[self.first] = 0
        pairs, self.pair = _distinct(before << 32 | self.tokens)
        self.left, self.right = pairs >> 32, pairs & 0xFFFFFFFF
        self.keys = _mix(_mix(self.hashes[self.left] + STEP) + self.hashes[self.right]) >> np.uint64(64 - PAIR_BITS)
        self.word_counts = np.bincount(self.tokens[self.trained], minlength=len(self.words))
        self.pair_counts = np.bincount(self.pair[self.trained], minlength=len(pairs))
        self.word_shard = _shard(self.hashes, shards)
        self.pair_shard = _shard(self.keys << np.uint64(64 - PAIR_BITS), shards)
        self.by_hash = np.argsort(self.hashes, kind="stable")

    # keys are dealt to shards by ranges, so the order of keys is an order of shards

    def context_order(self) -> np.ndarray:
        """Words, and the end before a text, that may be contexts."""
        used = np.zeros(len(self.words), bool)
        used[self.left] = True
        return self.by_hash[(used & (self.known >= MIN_COUNT))[self.by_hash]]

    def word_order(self) -> np.ndarray:
        return self.by_hash[self.by_hash > 0]  # the end is counted beside

    def pair_order(self) -> np.ndarray:
        return np.argsort(self.keys)  # pairs with one key have one answer

    def triples(self, seen: np.ndarray, ends: int) -> None:
        """Distinct runs of three tokens of which training has the first two MIN_COUNT times. seen: occurrences of each pair."""
        n = len(seen)
        before = np.empty_like(self.pair)
        before[1:] = self.pair[:-1]
        before[self.first] = n  # two ends
        looked = np.append(seen, ends) >= MIN_COUNT
        self.at = np.flatnonzero(looked[before])
        codes, place = _distinct(before[self.at] * len(self.words) + self.tokens[self.at])
        self.triple = place
        self.last_pair = np.empty(len(codes), np.int64)
        self.last_pair[place] = self.pair[self.at]
        self.context, self.next = codes // len(self.words), codes % len(self.words)
        self.triple_counts = np.bincount(place[self.trained[self.at]], minlength=len(codes))
        self.context_seen = np.append(seen, ends)[self.context]
        self.context_keys = (np.append(self.keys, np.uint64(0)) >> np.uint64(PAIR_BITS - 48))[self.context]
        short = (self.hashes >> np.uint64(32)).astype(np.uint32)[self.next]
        self.next_keys = np.where(self.context_seen < 1 << 16, short >> np.uint32(8), short)  # one byte less tells few apart as well

    def triple_order(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The order of triples, where each context (a hot one: each triple) begins in it, and the shards of these."""
        n = len(self.context)
        first = np.ones(n, bool)
        first[1:] = (self.context[1:] != self.context[:-1]) | (self.context_seen[1:] > self.hot)
        heads = np.flatnonzero(first)
        keys = self.context_keys[heads]
        route = np.where(self.context_seen[heads] > self.hot, _mix(keys + self.hashes[self.next[heads]]), keys << np.uint64(16))
        order = np.argsort(route, kind="stable")
        sizes = np.diff(np.append(heads, n))[order]
        starts = np.cumsum(sizes) - sizes
        triples = np.arange(n) + np.repeat(heads[order] - starts, sizes)
        return triples, starts, _shard(route[order], self.shards)


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    """The range of 64-bit keys that each key is in."""
    return (((keys >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)


def _differences(keys: np.ndarray) -> bytes:
    return _squeeze(np.diff(keys, prepend=np.uint64(0)))


def _whole(packed: bytes) -> np.ndarray:
    return np.cumsum(_spread(packed, np.uint64), dtype=np.uint64)


def _parts(*ordered: np.ndarray) -> Iterator[tuple]:
    """Each shard that occurs, and its part of each list of ascending shard numbers."""
    shards = sorted(set().union(*(np.unique(x).tolist() for x in ordered)))
    ends = [np.searchsorted(x, [*shards, np.iinfo(np.int64).max]).tolist() for x in ordered]
    for i, shard in enumerate(shards):
        yield shard, *(slice(e[i], e[i + 1]) for e in ends)


QUESTION = "shard int, group long, one binary, two binary, three binary, four binary"
ANSWER = "shard int, group long, step int, one binary, two binary, total long, kinds long, spelled binary, times binary"


def _questions(group: int, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 5
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int32()), pa.array([group] * len(rows), pa.int64()), *[pa.array(c, pa.binary()) for c in columns[1:]]],
        names=["shard", "group", "one", "two", "three", "four"],
    )


def _asking(shards: int):
    """Words and pairs of each group with their training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (r for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
                g = Group(row, shards)
                order, pairs = g.word_order(), g.pair_order()
                out = []
                for k, of_words, of_pairs in _parts(g.word_shard[order], g.pair_shard[pairs]):
                    own, two = order[of_words], pairs[of_pairs]
                    said = np.frombuffer(b" ".join([g.words[i] for i in own.tolist()]), np.uint8)
                    out.append((k, _squeeze(said), _squeeze(g.word_counts[own].astype(np.uint32)), _differences(g.keys[two]), _squeeze(g.pair_counts[two].astype(np.uint32))))
                yield _questions(row["group"], out)
    return run


def _split(x: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    return np.split(x, np.cumsum(sizes)[:-1])


def _answers(shard: int, groups: list[int], step: int, one: list[bytes], two: list[bytes], total: int = 0, kinds: int = 0, spelled: bytes = b"", times: bytes = b"") -> pa.Table:
    rest = len(groups) - 1
    return pa.table(
        {
            "shard": pa.array([shard] * len(groups), pa.int32()),
            "group": pa.array(groups, pa.int64()),
            "step": pa.array([step] * len(groups), pa.int32()),
            "one": pa.array(one, pa.binary()),
            "two": pa.array(two, pa.binary()),
            "total": pa.array([total] + [0] * rest, pa.int64()),
            "kinds": pa.array([kinds] + [0] * rest, pa.int64()),
            "spelled": pa.array([spelled] + [None] * rest, pa.binary()),
            "times": pa.array([times] + [None] * rest, pa.binary()),
        }
    )


def _counting(rows: pa.Table) -> pa.Table:
    """Corpus counts of a shard's words and pairs for each group that asks; a pair's lowest bit marks the first group that trains on it.

    The shard's first row also has its training tokens, their kinds, and what these words add to the spelling model."""
    rows = rows.sort_by("group")
    groups, shard = rows.column("group").to_pylist(), rows.column("shard")[0].as_py()
    counts: dict[bytes, int] = defaultdict(int)
    asked = []
    for said, n in zip(rows.column("one").to_pylist(), rows.column("two").to_pylist()):
        own = _spread(said, np.uint8).tobytes().split(b" ") if said != bytes(8) else []
        asked.append(own)
        for w, k in zip(own, _spread(n, np.uint32).tolist()):
            counts[w] += k
    known = [w for w, n in counts.items() if n]
    spelled, times = spelling_counts(known)
    parts = [_whole(x) for x in rows.column("three").to_pylist()]
    n = np.concatenate([_spread(x, np.uint32) for x in rows.column("four").to_pylist()]).astype(np.int64)
    keys, place = _distinct(np.concatenate(parts))
    total = np.bincount(place, n, len(keys)).astype(np.int64)
    first = np.zeros(len(n), np.int64)
    trains = np.flatnonzero(n)
    least = np.full(len(keys), -1)
    least[place[trains][::-1]] = trains[::-1]  # the last one written stays
    first[least[least >= 0]] = 1
    back = _split(total[place] * 2 + first, [len(x) for x in parts])
    one = [_squeeze(np.fromiter(map(counts.__getitem__, own), np.uint64, len(own))) for own in asked]
    return _answers(shard, groups, 1, one, [_squeeze(x.astype(np.uint64)) for x in back], sum(counts.values()), len(known), _squeeze(spelled.astype(np.uint64)), _squeeze(times.astype(np.uint64)))


def _unpacked_spelling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, n): a task's part of the spelling model."""
    keys, counts = [], []
    for batch in batches:
        for spelled, times in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            keys.append(_spread(spelled, np.uint64).astype(np.int64))
            counts.append(_spread(times, np.uint64))
    found, place = _distinct(np.concatenate(keys)) if keys else (np.empty(0, np.int64), np.empty(0, np.int64))
    n = np.bincount(place, np.concatenate(counts), len(found)).astype(np.int64) if keys else np.empty(0, np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(n, pa.int64())], names=["key", "n"])


class Scored(Group):
    """A group with the answers to its first question: counts, and the chances after no and one word."""

    def __init__(self, row: dict, answers: list[dict], shards: int, model):
        super().__init__(row, shards)
        spelling, total, kinds, ends, self.hot = model
        self.ends = ends
        self.known = np.zeros(len(self.words), np.int64)
        mine = sorted((a for a in answers if a["step"] == 1), key=lambda a: a["shard"])
        blank = np.empty(0, np.uint64)
        self.known[self.word_order()] = np.concatenate([blank, *(_spread(a["one"], np.uint64) for a in mine)]).astype(np.int64)
        self.known[0] = ends
        told = np.empty(len(self.left), np.int64)
        told[self.pair_order()] = np.concatenate([blank, *(_spread(a["two"], np.uint64) for a in mine)]).astype(np.int64)
        self.pair_known, self.owned = told >> 1, (told & 1).astype(bool)
        spelled = np.append(1 / 257, spelling.chance(self.words[1:]))
        self.root = (self.known + max(1, kinds) * spelled) / (total + max(1, kinds))
        self.after = smoothed(self.pair_known, self.known[self.left], self.root[self.right])


def smoothed(n: np.ndarray, seen: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """Chances after contexts with `seen` occurrences; those of the parent where too few."""
    weight = ESCAPE * np.maximum(seen, 1) ** GROWTH
    return np.where(seen >= MIN_COUNT, (n + weight * parent) / (seen + weight), parent)


def _divergence(n: np.ndarray, seen: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """Each symbol's part of count * KL."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(n > 0, n * np.log(n / seen / parent), 0.0)


def _framed(parts: list[bytes]) -> bytes:
    return b"".join(len(x).to_bytes(8, "little") + x for x in parts)


def _unframed(whole: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(whole):
        n = int.from_bytes(whole[at : at + 8], "little")
        out.append(whole[at + 8 : at + 8 + n])
        at += 8 + n
    return out


def _rounded(nats: np.ndarray) -> np.ndarray:
    """Nats as whole parts of 1 / NAT; beyond what a number of 32 bits holds, a test's answer is clear."""
    return np.clip(np.rint(nats * NAT), -(1 << 31), (1 << 31) - 1).astype(np.int32)


def _asking_again(shards: int, model):
    """What a group's own pairs add to the divergence of words, and its triples with their training counts and, for each
    context, the sum of the logs of their chances after one word."""

    def run(answers: pa.Table, packed: pa.Table) -> pa.Table:
        g = Scored(packed.to_pylist()[0], answers.to_pylist(), shards, model.value)
        gain = np.bincount(g.left[g.owned], _divergence(g.pair_known, g.known[g.left], g.root[g.right])[g.owned], len(g.words))
        own = g.context_order()
        g.triples(g.pair_known, g.ends)
        triples, starts, shard = g.triple_order()
        logs = g.triple_counts * np.log(g.after[g.last_pair])
        sums = np.add.reduceat(logs[triples], starts) if len(starts) else np.empty(0)
        heads, ends = triples[starts], np.append(starts, len(triples))
        gain, sums = _rounded(gain), _rounded(sums)
        rows = []
        for k, of_words, of_heads in _parts(g.word_shard[own], shard):
            mine = own[of_words]
            at = triples[ends[of_heads.start] : ends[of_heads.stop]]
            asked = (_differences(g.context_keys[heads[of_heads]]), _squeeze(np.diff(ends[of_heads.start : of_heads.stop + 1]).astype(np.uint32)), _squeeze(sums[of_heads]))
            rows.append((k, _differences(g.hashes[mine]), _squeeze(gain[mine]), _framed(asked), _framed([_squeeze(g.next_keys[at]), _squeeze(g.triple_counts[at].astype(np.uint32))])))
        return pa.Table.from_batches([_questions(packed.column("group")[0].as_py(), rows)])

    return run


def _deciding(rows: pa.Table) -> pa.Table:
    """Which of a shard's contexts are retained, and how often training has its triples, for each group that asks."""
    groups, shard = rows.column("group").to_pylist(), rows.column("shard")[0].as_py()
    own = [_whole(x) for x in rows.column("one").to_pylist()]
    gain = np.concatenate([_spread(x, np.int32) for x in rows.column("two").to_pylist()]) / NAT
    keys, place = _distinct(np.concatenate(own))
    retained = (np.bincount(place, gain, len(keys)) > DIVERGENCE)[place]
    contexts, sizes, sums = zip(*(_unframed(x) for x in rows.column("three").to_pylist()))
    following, counts = zip(*(_unframed(x) for x in rows.column("four").to_pylist()))
    heads = [_whole(x) for x in contexts]
    held, head = _distinct(np.concatenate(heads))
    of_head = np.concatenate([_spread(x, np.uint32) for x in sizes]).astype(np.int64)
    parts = [_spread(x, np.uint32) for x in following]
    context = np.repeat(head, of_head)
    n = np.concatenate([_spread(x, np.uint32) for x in counts]).astype(np.int64)
    codes, triple = _distinct(context << 32 | np.concatenate(parts).astype(np.int64))
    total = np.bincount(triple, n, len(codes)).astype(np.int64)
    seen = np.bincount(codes >> 32, total, len(held))
    some = total > 0
    gain = np.bincount(codes[some] >> 32, total[some] * np.log(total[some] / seen[codes[some] >> 32]), len(held))
    gain -= np.bincount(head, np.concatenate([_spread(x, np.int32) for x in sums]) / NAT, len(held))
    kept = (gain > DIVERGENCE)[head]
    back = zip(_split(total[triple], [len(x) for x in parts]), _split(kept, [len(x) for x in heads]))
    one = [_squeeze(x.astype(np.uint8)) for x in _split(retained, [len(x) for x in own])]
    return _answers(shard, groups, 2, one, [_framed([_squeeze(t.astype(np.uint32)), _squeeze(k.astype(np.uint8))]) for t, k in back])


def _scoring(shards: int, model):
    """The scores of a group's texts."""

    def run(answers: pa.Table, packed: pa.Table) -> pa.Table:
        told = answers.to_pylist()
        g = Scored(packed.to_pylist()[0], told, shards, model.value)
        _, total, kinds, _, _ = model.value
        g.triples(g.pair_known, g.ends)
        triples, starts, _ = g.triple_order()
        mine = sorted((a for a in told if a["step"] == 2), key=lambda a: a["shard"])
        retained = np.zeros(len(g.words), bool)
        retained[g.context_order()] = np.concatenate([np.empty(0, np.uint8), *(_spread(a["one"], np.uint8) for a in mine)]).astype(bool)
        frames = [_unframed(a["two"]) for a in mine]
        seen = np.empty(len(triples), np.int64)
        seen[triples] = np.concatenate([np.empty(0, np.uint32), *(_spread(f[0], np.uint32) for f in frames)])
        kept = np.concatenate([np.empty(0, np.uint8), *(_spread(f[1], np.uint8) for f in frames)]).astype(bool)
        whole = np.empty(len(triples), bool)
        whole[triples] = np.repeat(kept, np.diff(np.append(starts, len(triples))))
        best = np.where(retained[g.left], g.after, g.root[g.right])
        deep = smoothed(seen, g.context_seen, g.after[g.last_pair])
        logs = np.log10(best)[g.pair]
        logs[g.at] = np.log10(np.where(whole | (g.context_seen > g.hot), deep, best[g.last_pair]))[g.triple]
        base = np.log10(g.known + 0.5) - np.log10(total + 0.5 * (kinds + 1))
        n = len(g.held)
        return pa.table(
            {
                "id": packed.column("ids").combine_chunks().flatten(),
                "held_out": g.held,
                "n_tokens": np.bincount(g.text, minlength=n).astype(np.int64),
                "n_known": np.bincount(g.text, g.known[g.tokens] > 0, n).astype(np.int64),
                "base_score": np.bincount(g.text, base[g.tokens], n),
                "score": np.bincount(g.text, logs, n),
            }
        )

    return run


def with_fold(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return docs.withColumn("held_out", F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT, F.lit(False)))


def shard_count(characters: int) -> int:
    """A shard for each SHARD characters; beyond 4,096 shards they grow to 16 times that, so that questions stay long."""
    return max(LEAST_SHARDS, min(characters // SHARD, max(4096, characters // (16 * SHARD))))


def score(docs: DataFrame, id_col: str = "doc_id", text: str = "text", group: int = GROUP, hot: int = HOT) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of docs."""
    rows = with_fold(docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")), "id")
    placed = rows.select(F.monotonically_increasing_id().alias("row"), "id", "held_out", "text")  # names the groups; seen by one job only
    kind = placed.schema["id"].dataType
    schema = StructType([StructField("group", LongType()), StructField("ids", ArrayType(kind))])
    for name, other in (("held", "binary"), ("sizes", "binary"), ("words", "binary"), ("tokens", "binary"), ("ends", "long"), ("size", "long")):
        schema = schema.add(name, other)
    packed = materialize(placed.mapInArrow(_packing(group), schema), "groups")
    size, ends = packed.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.sum("ends"), F.lit(0))).first()
    shards = shard_count(size)
    packed = packed.drop("ends", "size")
    counts = materialize(packed.mapInArrow(_asking(shards), QUESTION).groupBy("shard").applyInArrow(_counting, ANSWER), "counts")
    total, kinds = counts.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("kinds"), F.lit(0))).first()
    total, kinds = total + ends, kinds + (ends > 0)
    spelled = counts.where("spelled is not null").select("spelled", "times").mapInArrow(_unpacked_spelling, "key long, n long")
    spelled = spelled.groupBy("key").agg(F.sum("n").alias("n")).toArrow().sort_by("key")  # at most 258 bytes for each context and cell
    model = Spelling(spelled.column("key").to_numpy(), spelled.column("n").to_numpy())
    model = docs.sparkSession.sparkContext.broadcast((model, total, kinds, ends, hot))
    told = counts.drop("total", "kinds", "spelled", "times")
    again = told.groupBy("group").cogroup(packed.groupBy("group")).applyInArrow(_asking_again(shards, model), QUESTION)
    more = again.groupBy("shard").applyInArrow(_deciding, ANSWER).drop("total", "kinds", "spelled", "times")
    schema = StructType([StructField("id", kind)])
    for name, other in (("held_out", "boolean"), ("n_tokens", "long"), ("n_known", "long"), ("base_score", "double"), ("score", "double")):
        schema = schema.add(name, other)
    done = told.unionByName(more).groupBy("group").cogroup(packed.groupBy("group")).applyInArrow(_scoring(shards, model), schema)
    return done.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
