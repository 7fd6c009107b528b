"""Quality classifier from weak labels.

LABELLERS are overlapping heuristics over a text's words; each votes clean (1), poor (0) or abstains (-1). The votes
of all documents are counted by pattern (at most 3^8, however many documents there are), and
expectation-maximisation estimates for every labeller the chance of each vote given the class, and
the share of poor documents, from these counts alone. The posterior of a pattern is the label that trains a
linear scorer over hashed features (words, word shapes, repeated neighbours), which decides: reject below THRESHOLD.

The scorer is fitted on a bounded sample of weakly labelled documents: the SAMPLE documents (a parameter) with the smallest
hashes of id and text, so that the sample does not depend on order and is no larger whatever the ids are. Votes, EM and scoring cover all
documents and whole texts. Features of a document are term frequencies scaled to a length below one, so long texts
are no larger than short ones and a few words are weak evidence.

Defined results: null, empty and wordless texts get no vote, score 0 and are rejected; equal texts get equal scores, so
repeated rows and ties are kept or go together; ids, null or repeated, decide nothing but the sample; very long texts are whole; an
empty table gives no rows (nothing is fitted); further columns are kept whatever their names, but with_score() replaces one of the
name that it is asked for.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gneiss.llm.columns import private
from gneiss.llm.workers import trim, trimmed
from gneiss.session import table

SAMPLE = 8_000
DIMENSIONS = 1 << 14
ROUNDS = 60
EPOCHS = 8
THRESHOLD = 0.25
WINDOW = 4_000  # words that variety looks at together
SHORT = 40.0  # added to the squared length of a document's features

LABELLERS = ("symbols", "capitals", "bars", "repeats", "variety", "frequent words", "word length", "sentences")
#: Frequent function words of English, French, German and Spanish.
FREQUENT = frozenset(
    "the of and to in a is that it for on was with as be by this le la les de des et un une est dans que qui en pour sur au "
    "der die das und ist den von mit zu ein eine nicht auf im el los las y del se por con para no su".encode().split()
)
#: Shapes of bytes: letters, digits, space and non-ASCII bytes fall together, punctuation stays itself.
SHAPE = bytes(97 if 97 <= c <= 122 or c >= 128 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c for c in range(256))


def _between(value: float, poor: float, clean: float) -> int:
    """Vote on a share that is high in poor texts: clean up to `clean`, poor from `poor`, nothing between."""
    return 0 if value >= poor else 1 if value <= clean else -1


def variety(words: list[bytes]) -> float:
    """Mean share of distinct words over all runs of WINDOW consecutive words (of all words in a shorter text), whatever the length."""
    n = len(words)
    if n <= WINDOW:
        return len(set(words)) / n
    held = Counter(words[:WINDOW])
    distinct = total = len(held)
    for new, old in zip(words[WINDOW:], words):
        if new != old:
            distinct += held[new] == 0
            held[new] += 1
            held[old] -= 1
            distinct -= held[old] == 0
        total += distinct
    return total / (WINDOW * (n - WINDOW + 1))


def votes(text: str | None) -> list[int]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return [-1] * len(LABELLERS)
    shaped = raw.translate(SHAPE)
    letters = shaped.count(b"a") + shaped.count(b"A")
    marks = sum(map(raw.count, (b"***", b"%%%", b"&&&", b"$$$", b"###", b"!!", b"@@@", b"~~~", b"==="))) / n
    upper = shaped.count(b"A") / max(1, letters)
    bars = (words.count(b"|") + words.count(b"||") + raw.count(b"\t")) / n
    same = sum(a == b for a, b in zip(words, words[1:])) / max(1, n - 1)
    kinds = variety(words)
    known = sum(map(FREQUENT.__contains__, words)) / n
    length = letters / n
    stops = (raw.count(b".") + raw.count(b"?")) / n
    return [
        _between(marks, 0.15, 0.01),
        _between(upper, 0.5, 0.2),
        _between(bars, 0.15, 0.01),
        _between(same, 0.3, 0.08),
        -1 if n < 30 else _between(1 - kinds, 0.8, 0.55),
        -1 if n < 40 else 0 if known < 0.03 else 1 if known > 0.1 else -1,
        -1 if n < 10 else 0 if length > 12 or length < 1.5 else 1 if 2.5 <= length <= 9 else -1,
        -1 if n < 40 else 0 if stops < 0.005 else 1 if stops > 0.02 else -1,
    ]


def _voting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pattern, n): counts of vote patterns of a batch."""
    for batch in batches:
        counts: dict[str, int] = {}
        for text in batch.column(0).to_pylist():
            pattern = "".join("?01"[v + 1] for v in votes(text))
            counts[pattern] = counts.get(pattern, 0) + 1
        yield pa.RecordBatch.from_pydict({"pattern": list(counts), "n": pa.array(list(counts.values()), pa.int64())})


def expectation_maximisation(patterns: list[str], counts: list[int], rounds: int = ROUNDS) -> tuple[dict[str, float], np.ndarray]:
    """Posterior of clean by pattern, and the estimated accuracy of each labeller (of the votes it casts).

    Dawid-Skene over vote patterns; classes start from the majority of the votes, a tie being clean."""
    seen = [p for p in patterns if set(p) != {"?"}]
    if not seen:
        return {p: 0.0 for p in patterns}, np.full(len(LABELLERS), 0.5)
    weight = np.array([c for p, c in zip(patterns, counts) if p in set(seen)], float)
    cast = np.array([["?01".index(v) for v in p] for p in seen])
    one = np.eye(3)[cast]  # pattern, labeller, vote
    clean, poor = (cast == 2).sum(1), (cast == 1).sum(1)
    posterior = np.where(poor > clean, 0.1, np.where(poor > 0, 0.6, 0.95))
    for _ in range(rounds):
        chances = []
        for share in (1 - posterior, posterior):
            held = np.einsum("p,plv->lv", weight * share, one) + 0.5
            held[:, 0] = held[:, 1] + held[:, 2]  # an abstention says nothing
            chances.append(held / held[:, :1])
        prior = np.clip([(weight * (1 - posterior)).sum(), (weight * posterior).sum()], 1.0, None) / weight.sum()
        logs = [np.log(prior[k]) + (one * np.log(chances[k])).sum((1, 2)) for k in (0, 1)]
        posterior = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -60, 60)))
    right = weight @ ((cast == 2) * posterior[:, None] + (cast == 1) * (1 - posterior[:, None]))
    given = weight @ (cast > 0)
    accuracy = np.where(given > 0, right / np.maximum(given, 1), 0.5)
    return {**{p: 0.0 for p in patterns}, **dict(zip(seen, posterior.tolist()))}, accuracy


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features: places and values."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.lower().split()
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.float32)
    crc = zlib.crc32
    own = np.fromiter(map(crc, words), np.uint32, len(words))
    shapes = np.fromiter(map(crc, raw.translate(SHAPE).split()), np.uint32, len(words))
    repeated = (own[1:] == own[:-1]).sum()
    places = np.concatenate([own % (DIMENSIONS // 2), DIMENSIONS // 2 + shapes % (DIMENSIONS // 2 - 8)])
    count = np.bincount(places, minlength=DIMENSIONS).astype(np.float32)
    count[DIMENSIONS - 1] = 4 * repeated
    at = np.flatnonzero(count)
    value = count[at]
    return at, value / np.sqrt((value * value).sum() + SHORT)


def sample_limit(n: int, sample: int) -> int:
    """The hash up to which `sample` of n evenly hashed rows lie, and by 8 standard deviations more."""
    wanted = sample + 8 * sample**0.5
    return (1 << 63) - 1 if n <= wanted else int((1 << 64) * wanted / n) - (1 << 63)


def _sampled(posterior: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, y, at, value = [], [], [], []
            for own, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                places, values = features(text)
                if len(places):
                    place.append(own)
                    y.append(posterior.get("".join("?01"[v + 1] for v in votes(text)), 0.0))
                    at.append(places.astype(np.uint16).tobytes())
                    value.append(values.astype(np.float16).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(place, pa.int64()), pa.array(y, pa.float64()), pa.array(at, pa.binary()), pa.array(value, pa.binary())], names=["place", "y", "at", "value"])

    return run


def fit_scorer(rows: list) -> np.ndarray:
    """Logistic regression on soft labels by averaged stochastic steps; the rarer class weighs as much as the other."""
    weights, bias = np.zeros(DIMENSIONS), 0.0
    total, total_bias, steps = np.zeros(DIMENSIONS), 0.0, 0
    data = [(r["y"], np.frombuffer(r["at"], np.uint16).astype(np.int64), np.frombuffer(r["value"], np.float16).astype(float)) for r in rows]
    clean = sum(y for y, _, _ in data)
    lift = np.array([min(20.0, len(data) / (2 * max(1.0, len(data) - clean))), min(20.0, len(data) / (2 * max(1.0, clean)))])
    order = np.random.default_rng(7)
    for epoch in range(EPOCHS):
        for k in order.permutation(len(data)).tolist():
            y, at, value = data[k]
            p = 1 / (1 + np.exp(-np.clip(weights[at] @ value + bias, -30, 30)))
            step = 0.5 / (1 + epoch) * (y * lift[1] * (1 - p) - (1 - y) * lift[0] * p)
            weights[at] += step * value
            bias += 0.1 * step
        if epoch >= EPOCHS // 2:
            total, total_bias, steps = total + weights, total_bias + bias, steps + 1
    return np.append(total / max(1, steps), total_bias / max(1, steps))


def score_text(text: str | None, model: np.ndarray) -> float:
    at, value = features(text)
    if not len(at):
        return 0.0
    return float(1 / (1 + np.exp(-np.clip(model[at] @ value + model[-1], -60, 60))))


def fit(docs: DataFrame, id_col: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> tuple[np.ndarray, dict[str, float], np.ndarray]:
    """(scorer, posterior by vote pattern, accuracy of each labeller)."""
    counted = docs.select(text).mapInArrow(trimmed(_voting), "pattern string, n long").groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").collect()
    posterior, accuracy = expectation_maximisation([r["pattern"] for r in counted], [r["n"] for r in counted])
    n = sum(r["n"] for r in counted)
    place, said = F.xxhash64(F.col(id_col), F.col(text)).alias("place"), F.col(text).alias("text")
    limit = sample_limit(n, sample)
    chosen = docs.select(place, said).where(F.col("place") <= limit)
    made = chosen.mapInArrow(trimmed(_sampled(posterior)), "place long, y double, at binary, value binary")
    rows = made.orderBy("place").limit(sample).collect()  # the hash gives somewhat more; equal rows have equal hashes
    rows.sort(key=lambda r: (r["at"], r["value"], r["y"]))  # the order of tasks must not matter
    return fit_scorer(rows), posterior, accuracy


def with_score(docs: DataFrame, id_col: str = "doc_id", text: str = "text", name: str = "score") -> DataFrame:
    model, _, _ = fit(docs, id_col, text)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts):
        out = texts.map(lambda t: score_text(t, shared.value), na_action=None)
        trim()  # once a batch
        return out

    return docs.withColumn(name, score(F.col(text)))


def filter_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without those that the classifier rejects."""
    (name,) = private(docs, "quality_score")
    return with_score(docs, id_col, text, name).where(F.col(name) >= THRESHOLD).drop(name)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = with_score(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return scored.select("doc_id", "score", (F.col("score") >= THRESHOLD).alias("kept"))
