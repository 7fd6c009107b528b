"""MinHash near-dedup by a chosen-path set similarity join.

A document's set holds 64-bit hashes of its distinct shingles (words `[^\\x20\\x09-\\x0D]+`, A-Z lower-cased; with
fewer words than a shingle has, the whole sequence is one). Documents with equal sets are one class, met by a
64-bit digest of the set; the join works on classes. Documents are linked if 100 * |A n B| >= 80 * |A u B|, confirmed on
full sets; groups are the connected components of the links.

Join. A class has a signature of COORDINATES minwise tokens. In each of TREES trees a node chooses, from its own
path, one coordinate, or two with a probability of 1 / threshold - 1, so that a pair at the threshold shares one
child on average and no path dies out. A node's classes branch by their minwise token at the chosen coordinates. Nodes of up to NODE
classes stop branching and are compared exhaustively by signature; larger ones branch on, level by level in Spark (only node
ids and class ids move; signatures are met once a level). What is larger still after LEVELS levels holds
classes that agree almost everywhere; it is dealt into parts of NODE classes, which round 1 compares.

A pair at the threshold is missed in one tree with probability q(k) at depth k (q(1) = 0.16, q(3) = 0.36,
q(6) = 0.52), in all 12 trees with 7e-11 to 4e-4; the signature estimate (64 registers of 8 bits, margin of 4.5 standard
deviations) loses 3e-6.

No group's pairs are all written. Round 1: of each node's similar pairs a maximum spanning forest is
proposed (fewer edges than classes) and confirmed. Round 2: only nodes in which an edge was refused between
components that are still apart, and dealt nodes whose parts are not one component, are compared again, and
all their similar pairs between different components are confirmed (similar by a finer sketch too, so that texts just
below the threshold, of which a large group has many, are few). A node with more than OUTSIDE classes outside its
largest component (texts on a common template that do not link) branches on, up to FURTHER levels, and children of one component are
left out, so its work grows little faster than its classes. In dealt nodes, the few classes outside the
node's largest component meet all of its parts, each pair in one part, so no link between components is lost there; the same
holds, at a quadratic price, for what FURTHER levels have not split.

Confirmation reads whole texts again: each proposed pair's larger id is sent to its smaller one, sorted
behind it, with hot centres dealt over salted copies, and compared as sets one after the other.

Defined results: null or empty text has n_shingles 0, is its own component and is kept; repeated rows (equal
id) are one node of the graph and each gets a row of link(), and dedup() keeps one row of an id; null ids are never linked (component
null, kept); very long texts are whole; of equal texts the smallest id is kept, so there are no ties; an empty table gives no rows;
link() reads no further columns, dedup() keeps them whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gneiss.llm.columns import private
from gneiss.llm.workers import trimmed
from gneiss.operators.components import connected_components
from gneiss.session import checkpoint, materialize, table

PERCENT = 80
COORDINATES = 64
TREES = 12
NODE = 64
LEVELS = 6
FURTHER = 30
OUTSIDE = 32 * NODE  # guests that each part of a dealt node takes at most
MARGIN = 4.5
BINS = 512
EMPTY = 255
SALT_DEGREE = 256
#: Odd multipliers of a 64-bit finaliser.
MIX_1, MIX_2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
STEP = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * MIX_1
    x = (x ^ (x >> np.uint64(33))) * MIX_2
    return x ^ (x >> np.uint64(33))


def _mixed(x: int) -> int:
    x &= MASK
    x = ((x ^ (x >> 33)) * int(MIX_1)) & MASK
    x = ((x ^ (x >> 33)) * int(MIX_2)) & MASK
    return x ^ (x >> 33)


SEEDS = np.array([_mixed(STEP * (i + 1)) | 1 for i in range(COORDINATES)], np.uint64)


def shingles(text: str | None, size: int) -> np.ndarray:
    """The sorted set of a text's shingle hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 1)], np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    joined = hashes[: len(hashes) - size + 1]
    for k in range(1, size):
        joined = _mix(joined + np.uint64(STEP)) + hashes[k : len(hashes) - size + 1 + k]
    return np.unique(_mix(joined))


def signature(items: np.ndarray) -> np.ndarray:
    """The minwise token of each coordinate, 32 bits of it."""
    out = np.full(COORDINATES, ~np.uint64(0))
    for at in range(0, len(items), 4096):
        part = items[at : at + 4096]
        mixed = part[None, :] * SEEDS[:, None]
        out = np.minimum(out, (mixed ^ (mixed >> np.uint64(29))).min(1))
    return (_mix(out) >> np.uint64(32)).astype(np.uint32)


def condensed(items: np.ndarray) -> bytes:
    """A set for the second round: all its hashes, cut to 32 bits, if they are few; else a one-permutation sketch of BINS
    bins, 8 bits of the smallest hash in each."""
    short = np.unique((_mix(items + np.uint64(STEP)) >> np.uint64(32)).astype(np.uint32))
    return short.tobytes() if len(items) <= BINS else binned(short).tobytes()


def binned(short: np.ndarray) -> np.ndarray:
    out = np.full(BINS, 0xFFFFFFFF, np.uint32)
    np.minimum.at(out, short % BINS, short // BINS)
    return np.where(out == 0xFFFFFFFF, EMPTY, _mix(out.astype(np.uint64)) % np.uint64(EMPTY)).astype(np.uint8)


def may_reach(one: np.ndarray, n: int, others: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether sets may be alike by their binned sketches: a pair at the threshold is lost below 4.5 deviations.

    The filled bins are a sample, without replacement, of the union (whose size at the threshold is known), so the
    deviation shrinks as bins outnumber items."""
    s = PERCENT / 100
    filled = ((others != EMPTY) | (one != EMPTY)).sum(1)
    equal = ((others == one) & (one != EMPTY)).sum(1)
    union = (n + sizes) / (1 + s)
    spread = np.sqrt(s * (1 - s) / np.maximum(filled, 1) * np.clip((union - filled) / np.maximum(union - 1, 1), 0, 1))
    return equal >= (s - MARGIN * spread) * filled - 1


def _class(items: np.ndarray) -> int | None:
    """The name of a set, the same for equal sets; null for the empty set."""
    return xxhash.xxh3_64_intdigest(items.tobytes()) - (1 << 63) if len(items) else None


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < PERCENT * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= PERCENT * (len(a) + len(b) - common)


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, 1000) for b in batches for at in range(0, b.num_rows, 1000)):
            n, keys, signs, wides = [], [], [], []
            for text in batch.column(1).to_pylist():
                items = shingles(text, size)
                n.append(len(items))
                keys.append(_class(items))
                signs.append(signature(items).tobytes() if len(items) else None)
                wides.append(condensed(items) if len(items) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.int64()), pa.array(signs, pa.binary()), pa.array(wides, pa.binary())], names=["doc_id", "n_shingles", "class", "sign", "wide"]
            )

    return run


def _chosen(node: int) -> list[int]:
    """The coordinates that a node branches on: one, or two with probability 100 / PERCENT - 1."""
    h = _mixed(node + STEP)
    first = h % COORDINATES
    if (h >> 32) / 2**32 < 100 / PERCENT - 1:
        second = (first + 1 + (h >> 8) % (COORDINATES - 1)) % COORDINATES
        return [first, second]
    return [first]


def _child(node: int, coordinate: int, token: int) -> int:
    return _mixed(node * 31 + coordinate * STEP + token + 1)


def _branch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, sign, nodes or null for the roots) -> (node, doc_id) of the children."""
    choice: dict[int, list[int]] = {}
    for batch in batches:
        ids, out = [], []
        for doc_id, sign, nodes in zip(*(batch.column(i).to_pylist() for i in range(3))):
            tokens = np.frombuffer(sign, np.uint32).tolist()
            for node in [_mixed(t + 7) for t in range(TREES)] if nodes is None else [x & MASK for x in nodes]:
                own = choice.get(node)
                if own is None:
                    if len(choice) > 200_000:
                        choice.clear()
                    own = choice[node] = _chosen(node)
                for c in own:
                    out.append(_child(node, c, tokens[c]))
                    ids.append(doc_id)
        yield pa.RecordBatch.from_arrays([pa.array(np.array(out, np.uint64).view(np.int64)), pa.array(ids, pa.int64())], names=["node", "doc_id"])


def _branch_further(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, sign, [(node, used)]) -> (node, used, doc_id) of the children: like _branch, but a path takes no coordinate twice, as
    that would double its nodes without splitting them. used: a bit for each coordinate taken."""
    for batch in batches:
        ids, out, masks = [], [], []
        for doc_id, sign, nodes in zip(*(batch.column(i).to_pylist() for i in range(3))):
            tokens = np.frombuffer(sign, np.uint32).tolist()
            for held in nodes:
                node, used = held["node"] & MASK, held["used"] & MASK
                free = [c for c in range(COORDINATES) if not used >> c & 1]
                h = _mixed(node + STEP)
                first = free[h % len(free)]
                chosen = [first]
                if (h >> 32) / 2**32 < 100 / PERCENT - 1:
                    free.remove(first)
                    chosen.append(free[(h >> 8) % len(free)])
                for c in chosen:
                    ids.append(doc_id)
                    out.append(_child(node, c, tokens[c]))
                    masks.append(used | 1 << c)
        yield pa.RecordBatch.from_arrays([pa.array(np.array(x, np.uint64).view(np.int64)) for x in (out, masks)] + [pa.array(ids, pa.int64())], names=["node", "used", "doc_id"])


def leaves(classes: DataFrame) -> DataFrame:
    """(node, doc_id, dealt): every node with 2 to NODE classes; dealt: the number of parts of a larger one, else 1."""
    small = classes.select("doc_id", "sign")
    level = small.withColumn("nodes", F.lit(None).cast("array<long>")).mapInArrow(trimmed(_branch), "node long, doc_id long")
    found = None
    for depth in range(1, LEVELS + 1):
        level = materialize(level, f"level{depth}")
        sizes = level.groupBy("node").agg(F.count("*").alias("n")).where("n > 1")
        held = level.join(sizes, "node")
        done = held.where((F.col("n") <= NODE) | F.lit(depth == LEVELS)).select("node", "doc_id", F.ceil(F.col("n") / F.lit(NODE)).cast("int").alias("dealt"))
        found = done if found is None else found.unionByName(done)
        if depth < LEVELS:
            large = materialize(held.where(F.col("n") > NODE).select("node", "doc_id"), f"large{depth}")
            if large.isEmpty():
                break
            again = large.groupBy("doc_id").agg(F.collect_list("node").alias("nodes"))  # at most TREES * 2^depth nodes a class
            level = small.join(again, "doc_id").select("doc_id", "sign", "nodes").mapInArrow(trimmed(_branch), "node long, doc_id long")
    return found


def _small_sign(classes: DataFrame) -> DataFrame:
    """8 bits of each coordinate are enough to compare."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signs = [np.frombuffer(s, np.uint32).astype(np.uint8).tobytes() for s in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signs, pa.binary())], names=["doc_id", "sign"])

    return classes.select("doc_id", "sign").mapInArrow(cut, "doc_id long, sign binary")


def _floor() -> float:
    s = PERCENT / 100
    return s - MARGIN * np.sqrt(s * (1 - s) / COORDINATES)


def _similar(signs: np.ndarray) -> np.ndarray:
    """Counts of equal registers for all pairs of a node, by blocks of rows."""
    m = len(signs)
    out = np.zeros((m, m), np.int16)
    for i in range(m - 1):
        out[i, i + 1 :] = (signs[i + 1 :] == signs[i]).sum(1)
    return out


def _groups(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[list[list]]:
    """Runs of rows with the same first column, across batches."""
    held: list[list] = [[] for _ in range(columns)]
    for batch in batches:
        rows = [batch.column(i).to_pylist() for i in range(columns)]
        at = 0
        key = rows[0]
        for i in range(len(key)):
            if held[0] and key[i] != held[0][0] or i > at and key[i] != key[i - 1]:
                for c in range(columns):
                    held[c] += rows[c][at:i]
                at = i
                if held[0]:
                    yield held
                held = [[] for _ in range(columns)]
        for c in range(columns):
            held[c] += rows[c][at:]
    if held[0]:
        yield held


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node key, node, doc_id, sign) sorted by node key -> (a, b, node): a maximum spanning forest of the similar pairs."""
    least = _floor() * COORDINATES
    a, b, at = [], [], []

    def out():
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(at, pa.int64())], names=["a", "b", "node"])

    for _, nodes, ids, signs in _groups(batches, 4):
        if len(ids) < 2:
            continue
        order = np.argsort(np.array(ids), kind="stable")
        names = np.array(ids)[order]
        equal = _similar(np.frombuffer(b"".join(signs), np.uint8).reshape(len(ids), COORDINATES)[order])
        i, j = np.nonzero(equal >= least)
        if not len(i):
            continue
        parent = list(range(len(ids)))

        def root(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for k in np.lexsort((j, i, -(equal[i, j] >> 2))).tolist():  # close estimates count as ties, so trees agree on edges
            x, y = root(i[k]), root(j[k])
            if x != y:
                parent[max(x, y)] = min(x, y)
                a.append(int(names[i[k]]))
                b.append(int(names[j[k]]))
                at.append(nodes[0])
        if len(a) > 50_000:
            yield out()
            a.clear(), b.clear(), at.clear()
    if a:
        yield out()


def _apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, doc_id, component, sign, wide, n, own) sorted by part -> (a, b): similar pairs of different components.

    A class has one part of its own; of two classes that are guests in a part, this part is none's. Duplicates go later."""
    least = _floor() * COORDINATES
    for _, ids, components, signs, wides, counts, home in _groups(batches, 7):
        if len(ids) < 2:
            continue
        names, kinds, sizes, home = np.array(ids), np.array(components), np.array(counts), np.array(home)
        few = sizes <= BINS
        whole = [frozenset(np.frombuffer(w, np.uint32).tolist()) if f else None for w, f in zip(wides, few)]
        wide = None if few.all() else np.array([binned(np.frombuffer(w, np.uint32)) if f else np.frombuffer(w, np.uint8) for w, f in zip(wides, few)])
        rows = np.frombuffer(b"".join(signs), np.uint8).reshape(len(ids), COORDINATES)
        a, b = [], []
        at = np.arange(len(ids))
        for i in np.flatnonzero(home).tolist():
            other = np.flatnonzero((kinds != kinds[i]) & (~home | (at > i)))
            if len(other):
                near = other[(rows[other] == rows[i]).sum(1) >= least]
                if few[i] and few[near].all():
                    own, n = whole[i], sizes[i]
                    near = np.array([k for k in near.tolist() if 100 * (1 + len(own & whole[k])) >= PERCENT * (n + sizes[k] - 1 - len(own & whole[k]))], np.int64)
                else:
                    near = near[may_reach(wide[i], sizes[i], wide[near], sizes[near])]
                a += np.minimum(names[near], names[i]).tolist()
                b += np.maximum(names[near], names[i]).tolist()
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _confirming(size: int):
    """(centre key, role, a, b, class, text) sorted by centre key, role: the centre's text, then those proposed for it.

    An id may occur with several texts; only the text whose digest gives the class counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, own = None, None
        for batch in batches:
            a, b, ok = [], [], []
            for key, role, x, y, text in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if role == 0:
                    centre, own = key, shingles(text, size)
                    continue
                a.append(x)
                b.append(y)
                ok.append(key == centre and alike(own, shingles(text, size)))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(ok, pa.bool_())], names=["a", "b", "ok"])

    return run


def confirm(pairs: DataFrame, texts: tuple[DataFrame, DataFrame], size: int) -> DataFrame:
    """(a, b, ok) of proposed pairs a < b of classes. texts: (doc_id, text) rows, and each class's smallest doc_id."""
    rows, led = texts
    degree = pairs.groupBy("a").agg(F.count("*").alias("degree"))
    salted = pairs.join(degree, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.greatest(F.lit(1), F.ceil(F.col("degree") / SALT_DEGREE))).cast("int"))
    wanted = salted.select(F.col("b").alias("class"), "a", "salt", F.lit(1).alias("role"))
    centres = salted.select(F.col("a").alias("class"), "a", "salt", F.lit(0).alias("role")).distinct()
    places = wanted.unionByName(centres).groupBy("class").agg(F.collect_list(F.struct("a", "salt", "role")).alias("places"))
    places = places.join(led, "class").groupBy("doc_id").agg(F.collect_list(F.struct("class", "places")).alias("held"), F.max("several").alias("several"))
    spread = rows.join(places, "doc_id").select("doc_id", "text", "held", "several").mapInArrow(trimmed(_placing(size)), "key long, role int, a long, b long, text string")
    # an id with repeated rows gives its text more than once: the pair's answer is the same
    checked = spread.repartition("key").sortWithinPartitions("key", "role").mapInArrow(trimmed(_confirming(size)), "a long, b long, ok boolean")
    return checked.distinct()


def _placing(size: int):
    """(doc_id, text, held, several) -> a row for each place of the class that this text has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text, held, several in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                own = (_class(shingles(text, size)) or 0) if several else None
                for one in held:
                    if own is None or one["class"] == own:
                        out += [(_mixed(p["a"] * 1_000_003 + p["salt"]) - (1 << 63), p["role"], p["a"], one["class"], text) for p in one["places"]]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string()))], names=["key", "role", "a", "b", "text"])

    return run


def link(docs: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = 2) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of docs."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sets = materialize(source.mapInArrow(trimmed(_sets(size)), "doc_id long, n_shingles long, class long, sign binary, wide binary"), "sets")
    # a class's text is read from its smallest document
    known = sets.where("class is not null and doc_id is not null")
    classes = materialize(known.groupBy("class").agg(F.min("doc_id").alias("least"), F.first("sign").alias("sign")), "classes")
    leaf = materialize(leaves(classes.select(F.col("class").alias("doc_id"), "sign")), "leaves")
    signs = materialize(_small_sign(classes.select(F.col("class").alias("doc_id"), "sign")), "signs")
    part = F.xxhash64("node", F.pmod(F.xxhash64("doc_id", "node"), F.col("dealt")))
    compared = leaf.join(signs, "doc_id").select(part.alias("part"), "node", "doc_id", "sign")
    forest = compared.repartition("part").sortWithinPartitions("part").mapInArrow(trimmed(_forests), "a long, b long, node long")
    forest = materialize(forest, "forest")
    pairs = forest.select("a", "b").distinct()
    # an id that occurs with several texts is one document: its classes are linked
    several = materialize(known.groupBy("doc_id").agg(F.min("class").alias("a"), F.max("class").alias("m")).where("a <> m").select("doc_id", "a"), "several")
    led = classes.select("class", F.col("least").alias("doc_id")).join(several.select("doc_id", F.lit(True).alias("several")), "doc_id", "left")
    texts = (source, led)
    links = materialize(confirm(pairs, texts, size), "links")
    good = links.where("ok").select("a", "b")
    same = known.join(several, "doc_id").where("class <> a").select(F.least("a", "class").alias("a"), F.greatest("a", "class").alias("b"))
    good = materialize(good.unionByName(same), "good")
    comps = materialize(connected_components(good), "components")
    named = comps.select(F.col("node").alias("doc_id"), "component")
    refused = forest.join(links.where("not ok").select("a", "b"), ["a", "b"]).select("a", "b", "node")
    refused = _labelled(_labelled(refused, named, "a", "ca"), named, "b", "cb").where("ca <> cb").select("node")
    open_nodes = materialize(refused.unionByName(leaf.where("dealt > 1").select("node")).distinct(), "open")
    if not open_nodes.isEmpty():
        held = leaf.join(open_nodes, "node", "left_semi")
        wides = sets.select("class", "wide", "n_shingles").join(held.select(F.col("doc_id").alias("class")).distinct(), "class", "left_semi")
        wides = wides.groupBy("class").agg(F.first("wide").alias("wide"), F.first("n_shingles").alias("n"))
        known_more = signs.join(wides.withColumnRenamed("class", "doc_id"), "doc_id")
        more = materialize(_second(_still_open(held, classes, named), known_more), "second").join(links.select("a", "b"), ["a", "b"], "left_anti")
        if not more.isEmpty():
            late = materialize(confirm(more, texts, size), "late").where("ok").select("a", "b")
            comps = materialize(connected_components(good.unionByName(late)), "components")
    # every component's smallest document, then every document through its class
    reached = classes.join(comps.select(F.col("node").alias("class"), "component"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    smallest = reached.groupBy("component").agg(F.min("least").alias("component_id"))
    answer = reached.join(smallest, "component").select(F.col("class").alias("_class"), "component_id")
    led = sets.withColumn("_class", F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("class")), F.xxhash64("doc_id", F.lit("no class")))).join(answer, "_class", "left")
    out = led.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _labelled(df: DataFrame, named: DataFrame, column: str, label: str) -> DataFrame:
    own = named.select(F.col("doc_id").alias(column), F.col("component").alias(label))
    return df.join(own, column, "left").withColumn(label, F.coalesce(label, column))


def _still_open(leaf: DataFrame, classes: DataFrame, named: DataFrame) -> DataFrame:
    """(node, doc_id, component, main, n_node) of nodes with several components, of which at most OUTSIDE classes are outside the main one.

    Others branch on."""
    signs = classes.select(F.col("class").alias("doc_id"), "sign")
    level, found = leaf.select("node", F.lit(0).cast("long").alias("used"), "doc_id"), None
    for depth in range(FURTHER + 1):
        rows = materialize(_labelled(level, named, "doc_id", "component"), f"open{depth}")
        by = rows.groupBy("node", "component").agg(F.count("*").alias("n"))
        sizes = by.groupBy("node").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.sum("n").alias("n_node"), F.max("n").alias("n_main"), F.count("*").alias("components"))
        sizes = sizes.where("components > 1").withColumn("wide", F.lit(depth < FURTHER) & (F.col("n_node") - F.col("n_main") > OUTSIDE))
        held = rows.join(sizes.select("node", "main", "n_node", "wide"), "node")
        done = held.where(~F.col("wide")).select("node", "doc_id", "component", "main", "n_node")
        found = done if found is None else found.unionByName(done)
        if depth == FURTHER:
            break
        large = materialize(held.where("wide").select("node", "used", "doc_id"), f"wide{depth}")
        if large.isEmpty():
            break
        again = large.groupBy("doc_id").agg(F.collect_list(F.struct("node", "used")).alias("nodes"))
        level = signs.join(again, "doc_id").select("doc_id", "sign", "nodes").mapInArrow(trimmed(_branch_further), "node long, used long, doc_id long")
    return found


def _second(mixed: DataFrame, signs: DataFrame) -> DataFrame:
    """Similar pairs between different components in the nodes that are still open."""
    parts = F.ceil(F.col("n_node") / F.lit(NODE)).cast("int")
    home = F.pmod(F.xxhash64("doc_id", "node"), parts).cast("int")
    every = F.sequence(F.lit(0), parts - 1)
    dealt = mixed.withColumn("p", F.explode(F.when(F.col("component") == F.col("main"), F.array(home)).otherwise(every))).withColumn("own", F.col("p") == home)
    placed = dealt.select(F.xxhash64("node", "p").alias("part"), "doc_id", "component", "own").join(signs, "doc_id")
    placed = placed.select("part", "doc_id", "component", "sign", "wide", "n", "own")
    return placed.repartition("part").sortWithinPartitions("part").mapInArrow(trimmed(_apart), "a long, b long").distinct()


def dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = 5) -> DataFrame:
    """One row of docs for each group: that of its smallest id."""
    linked = materialize(link(docs, id_col, text, size).select("doc_id", "kept"), "linked")
    name, number = private(docs, "gone", "times")
    gone = materialize(linked.where("not kept").select(F.col("doc_id").alias(name)).distinct(), "gone")  # its own size decides how it is joined
    left = docs.join(gone, docs[id_col] == F.col(name), "left_anti")
    repeated = checkpoint(linked.where("kept and doc_id is not null").groupBy(F.col("doc_id").alias(name)).agg(F.count("*").alias(number)).where(F.col(number) > 1))
    if repeated.isEmpty():
        return left
    held = F.col(id_col) == F.col(name)
    return left.join(repeated, held, "left_anti").unionByName(left.join(repeated, held, "left_semi").dropDuplicates([id_col]))


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(table(spark, sf_dir, "documents"), size=2)
