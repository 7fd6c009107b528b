"""SentencePiece encoding and decoding with N-best segmentation.

The piece lattice of a text has an edge for every vocabulary piece at every place; characters outside the
vocabulary (and a literal U+2581, which pieces use for a space) are spelled by byte pieces. A forward Viterbi pass gives the best
score of reaching each place; these scores are the exact heuristic of a backward A* search, which hands out
complete segmentations best first.

No piece spans a space that follows another character, nor an unknown character, so the lattice falls apart at these places
and the segments are independent. Each distinct segment is solved once and kept in a bounded cache. The N
best segmentations of a text differ from the best one only in the N - 1 occurrences with the least loss of their second best
path (any other change costs more than these N - 1 do alone), so A* runs for those, and their lists are
merged best first. The result is exact; ties go to the earlier place, then to the search order.

Defined results: null and empty text have no pieces, score 0, one segmentation and decode to ''; repeated
rows are encoded each; very long texts are whole; an empty table gives no rows; further columns are kept by encode_column(), but
those with the name of an output (ids, n_pieces, score, alternatives, round_trip) are replaced.
Decoding the ids gives the text back exactly.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gneiss.llm.columns import private
from gneiss.session import table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BEST = 4
CACHE = 250_000  # segments in each of two generations
TOGETHER = 2_000_000  # characters of texts whose segments are solved at once
SPACE = "▁"


def load_model(path: str = MODEL) -> list[tuple[str, float, int]]:
    """(piece, score, kind) by id; kind 0 text, 1 byte, 2 other. Read on the driver; the vocabulary is a fixed, small list."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    kind = lambda i: 1 if model.is_byte(i) else 2 if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) else 0
    return [(model.id_to_piece(i), model.get_score(i), kind(i)) for i in range(model.get_piece_size())]


class Pieces:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, vocabulary: list[tuple[str, float, int]]):
        self.trie: dict = {}
        backward: dict = {}  # the pieces from their last character on
        self.byte_ids = {int(p[1:-1], 16): i for i, (p, _, k) in enumerate(vocabulary) if k == 1}
        singles = {p for p, _, k in vocabulary if k == 0 and len(p) == 1}
        for i, (piece, score, kind) in enumerate(vocabulary):
            if kind:
                continue
            if SPACE in piece.lstrip(SPACE):
                raise ValueError(f"piece {piece!r} spans a space inside: segments would not be independent")
            node = self.trie
            for c in piece:
                node = node.setdefault(c, {})
            node[""] = (i, float(score))
            node = backward
            for c in reversed(piece):
                node = node.setdefault(c, {})
            node[""] = (i, float(score))
        self.backward = self._steps(backward)
        self.longest = max(len(p) for p, _, k in vocabulary if k == 0)
        known = singles - {SPACE, " "}
        self.unknown_score = min(s for _, s, k in vocabulary if k == 0) - 10.0
        letters = "".join(re.escape(c) for c in sorted(known))
        self.segments = re.compile(f" *[{letters}]+| +|.", re.S)
        self.known = known | {SPACE, " "}
        self.shown = [bytes([int(p[1:-1], 16)]) if k == 1 else p.replace(SPACE, " ").encode() if k == 0 else b"" for p, _, k in vocabulary]
        self.cache: dict[str, tuple[tuple[int, ...], float, float]] = {}
        self.older: dict[str, tuple[tuple[int, ...], float, float]] = {}
        self.lists: dict[str, list[tuple[float, tuple[int, ...]]]] = {}

    def _steps(self, node: dict) -> dict:
        """The trie with one lookup a step: character -> (next, score, id or -1)."""
        return {c: (self._steps(child), *((child[""][1], child[""][0]) if "" in child else (0.0, -1))) for c, child in node.items() if c}

    def _lattice(self, segment: str) -> tuple[list[tuple[int, int, float, int]], list[float], list[int]]:
        """Edges (from, to, score, id) in order of their start, Viterbi scores, and the best edge into each place."""
        text = segment.replace(" ", SPACE)
        n = len(text)
        edges, score, back = [], [0.0] + [-1e300] * n, [-1] * (n + 1)
        trie = self.trie
        for i in range(n):
            here, node, single = score[i], trie, False
            for j in range(i, n):
                node = node.get(text[j])
                if node is None:
                    break
                found = node.get("")
                if found is not None:
                    end = j + 1
                    single = single or end == i + 1
                    edges.append((i, end, found[1], found[0]))
                    if here + found[1] > score[end]:
                        score[end], back[end] = here + found[1], len(edges) - 1
            if not single and len(text[i]) and text[i] not in self.known:  # only in lattices of whole texts (tests)
                edges.append((i, i + 1, self.unknown_score, -1 - ord(text[i])))
                if here + self.unknown_score > score[i + 1]:
                    score[i + 1], back[i + 1] = here + self.unknown_score, len(edges) - 1
        return edges, score, back

    def _spell(self, character: str) -> tuple[int, ...]:
        return tuple(self.byte_ids[b] for b in character.encode("utf-8", "surrogatepass"))

    def solve(self, segments: list[str]) -> None:
        """Put (ids, score, loss of the second best path) of segments into the cache. Sorted, a segment goes on from what it shares with the one before."""
        steps, longest, cache, before = self.backward, self.longest, self.cache, ""
        # Viterbi with the best and the second best score of each place, from the pieces that end there; a step is (next, score, id)
        first, second, start, piece = [0.0], [-1e300], [0], [0]
        for segment in sorted(segments):
            if segment == SPACE or segment not in self.known and len(segment) == 1:
                cache[segment] = self._spell(segment), self.unknown_score, float("inf")
                continue
            text = segment.replace(" ", SPACE)
            n, same = len(text), 0
            for x, y in zip(text, before):
                if x != y:
                    break
                same += 1
            before, back = text, text[::-1]
            if len(first) <= n:
                for places in (first, second, start, piece):
                    places += [0] * (n + 1 - len(places))
            for end in range(same, n):
                best, other, at, own, node, i = -1e300, -1e300, 0, 0, steps, end
                for c in back[n - 1 - end : n - 1 - end + longest]:
                    step = node.get(c)
                    if step is None:
                        break
                    node, score, k = step
                    if k >= 0:
                        total = first[i] + score
                        if total >= best:  # of equal ones the earlier place
                            loser = second[i] + score
                            other = best if best > loser else loser
                            best, at, own = total, i, k
                        elif total > other:
                            other = total
                    i -= 1
                end += 1
                first[end], second[end], start[end], piece[end] = best, other, at, own
            ids, at = [], n
            while at:
                ids.append(piece[at])
                at = start[at]
            ids.reverse()
            cache[segment] = tuple(ids), first[n], first[n] - second[n] if second[n] > -1e299 else float("inf")

    def nbest(self, segment: str, n: int = BEST) -> list[tuple[float, tuple[int, ...]]]:
        """The n best segmentations by backward A*: a partial path from the end is ranked by its score and the Viterbi score of its place."""
        if not segment:
            return [(0.0, ())]
        if segment == SPACE or segment not in self.known and len(segment) == 1:
            return [(self.unknown_score, self._spell(segment))]
        edges, score, _ = self._lattice(segment)
        into: list[list[int]] = [[] for _ in range(len(segment) + 1)]
        for k, e in enumerate(edges):
            into[e[1]].append(k)
        agenda, order, out = [(-score[-1], 0, len(segment), 0.0, None)], 0, []
        while agenda and len(out) < n:
            _, _, at, done, tail = heapq.heappop(agenda)
            if at == 0:
                ids = []
                while tail is not None:
                    ids += [tail[0]] if tail[0] >= 0 else self._spell(chr(-1 - tail[0]))
                    tail = tail[1]
                out.append((done, tuple(ids)))
                continue
            for k in into[at]:
                i, _, s, piece = edges[k]
                if score[i] > -1e299:
                    order += 1
                    heapq.heappush(agenda, (-(score[i] + s + done), order, i, done + s, (piece, tail)))
        return out

    def prepare(self, cuts) -> None:
        """Have these segments in the cache."""
        if len(self.cache) >= CACHE:  # two generations: what is still in use comes back from the older one
            self.older, self.cache = self.cache, {}
            self.lists.clear()
        cache, older, new = self.cache, self.older, []
        for cut in set(cuts).difference(cache):
            found = older.get(cut)
            if found is None:
                new.append(cut)
            else:
                cache[cut] = found
        self.solve(new)

    def encode_all(self, texts: list[str | None], n: int = BEST) -> Iterator[tuple[np.ndarray, float, list]]:
        """encode() of each text; segments are solved for several texts at once, of bounded length in all."""
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end] or "") <= TOGETHER):
                size += len(texts[end] or "")
                end += 1
            cuts = [self.segments.findall(" " + t) if t else [] for t in texts[at:end]]
            self.prepare(chain.from_iterable(cuts))
            yield from (self._encode(c, n) for c in cuts)
            at = end

    def encode(self, text: str | None, n: int = BEST) -> tuple[np.ndarray, float, list]:
        """(ids, score, alternatives): alternatives are (score, [(place, pieces replaced, ids), ...]), best first, without the best one."""
        return next(self.encode_all([text], n))

    def _encode(self, cuts: list[str], n: int) -> tuple[np.ndarray, float, list]:
        if not cuts:
            return np.empty(0, np.int32), 0.0, []
        solved = list(map(self.cache.__getitem__, cuts))
        ids = np.fromiter(chain.from_iterable(map(itemgetter(0), solved)), np.int32)
        score = sum(map(itemgetter(1), solved))
        if n < 2:
            return ids, score, []
        losses = np.fromiter(map(itemgetter(2), solved), float, len(solved))
        some = min(n - 1, len(losses))
        worst = np.partition(losses, some - 1)[some - 1]
        near = np.flatnonzero(losses <= worst)
        near = near[np.argsort(losses[near], kind="stable")][:some]
        near = np.sort(near[np.isfinite(losses[near])])
        lists = []
        for k in near.tolist():
            own = self.lists.get(cuts[k])
            if own is None or len(own) < n:
                own = self.lists[cuts[k]] = self.nbest(cuts[k], n)
            lists.append([(score_, ids_) for score_, ids_ in own])
        if not lists:
            return ids, score, []
        starts = np.cumsum([0, *map(len, map(itemgetter(0), solved))])
        out, agenda, seen = [], [(0.0, (0,) * len(lists))], {(0,) * len(lists)}
        while agenda and len(out) < n:
            lost, pick = heapq.heappop(agenda)
            if any(pick):
                out.append((score - lost, [(int(starts[near[k]]), len(solved[near[k]][0]), list(lists[k][p][1])) for k, p in enumerate(pick) if p]))
            else:
                out.append(None)
            for k, p in enumerate(pick):
                nxt = (*pick[:k], p + 1, *pick[k + 1 :])
                if p + 1 < len(lists[k]) and nxt not in seen:
                    seen.add(nxt)
                    heapq.heappush(agenda, (lost + lists[k][p][0] - lists[k][p + 1][0], nxt))
        return ids, score, [o for o in out if o is not None]

    def decode(self, ids) -> str:
        if not len(ids):
            return ""
        return b"".join(map(self.shown.__getitem__, ids)).decode("utf-8", "surrogatepass")[1:]


_made: list[tuple[list, Pieces]] = []


def _pieces(shared) -> Pieces:
    """One encoder for each worker: its cache serves all tasks that the worker runs. The vocabulary is held, so its identity tells."""
    if not _made or _made[0][0] is not shared.value:
        _made[:] = [(shared.value, Pieces(shared.value))]
    return _made[0][1]


def _encoding(shared, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _pieces(shared)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = part.column(part.num_columns - 1).to_pylist()
                done = list(own.encode_all(texts, n))
                sizes = np.cumsum([0] + [len(d[0]) for d in done])
                lists = pa.ListArray.from_arrays(pa.array(sizes.astype(np.int32)), pa.array(np.concatenate([d[0] for d in done])))
                backs = [own.decode(d[0].tolist()) == (t or "") for d, t in zip(done, texts)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], lists, pa.array([len(d[0]) for d in done], pa.int64()), pa.array([float(d[1]) for d in done]), pa.array([json.dumps(d[2]) for d in done]), pa.array(backs)],
                    names=[*part.schema.names[:-1], "ids", "n_pieces", "score", "alternatives", "round_trip"],
                )

    return run


def encode_column(docs: DataFrame, text: str = "text", model: str = MODEL, n: int = BEST) -> DataFrame:
    """docs with ids, n_pieces, score, alternatives (JSON: the 2nd to nth best as score and edits) and round_trip."""
    shared = docs.sparkSession.sparkContext.broadcast(load_model(model))
    names = ["ids", "n_pieces", "score", "alternatives", "round_trip"]
    rest = [f for f in docs.schema.fields if f.name.lower() not in names]
    (own,) = private(docs, "encoded")
    kept = docs.select(*[F.col(f"`{f.name}`") for f in rest], F.col(f"`{text}`").alias(own))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rest] + ["ids array<int>", "n_pieces long", "score double", "alternatives string", "round_trip boolean"])
    return kept.mapInArrow(_encoding(shared, n), schema)


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return encode_column(docs.select("doc_id", "text")).drop("text")
