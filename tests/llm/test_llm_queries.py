"""Queries with SQL against it; the others against brute force over the whole small tables."""

import hashlib
import math
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from support import DATA, same_rows

from gneiss.llm import decontamination, fingerprints, near_dedup, pieces, quality, scoring, sharding, surrogates
from gneiss.llm.queries import ORACLES, QUERIES
from gneiss.session import table


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r["text"] for r in table(spark, DATA, "documents").collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, oracle, name):
    df = QUERIES[name](spark, DATA)
    cursor = oracle.execute(ORACLES[name])
    same_rows(df.columns, df.collect(), [c[0] for c in cursor.description], cursor.fetchall())


def word_sets(texts, size):
    out = {}
    for k, t in texts.items():
        w = (t or "").encode().lower().split()
        out[k] = frozenset([tuple(w)] if 0 < len(w) < size else [tuple(w[i : i + size]) for i in range(len(w) - size + 1)])
    return out


def brute_components(texts, size):
    sets, parent = word_sets(texts, size), {k: k for k in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * min(len(x), len(y)) >= 80 * max(len(x), len(y)) and 100 * len(x & y) >= 80 * len(x | y):
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    return {k: root(k) for k in ids}, {k: len(s) for k, s in sets.items()}


def test_near_duplicates_are_those_of_all_pairs(spark, documents):
    want, sizes = brute_components(documents, 2)
    rows = QUERIES["op1_minhash_dedup"](spark, DATA).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == want
    assert {r["doc_id"]: r["n_shingles"] for r in rows} == sizes
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_surrogates_leave_no_entity(spark, documents):
    rows = QUERIES["op2_pii_surrogates"](spark, DATA).collect()
    originals = {(kind, documents[k][s:e]) for k in documents for kind, s, e, _ in surrogates.mentions(documents[k])}
    assert originals and len(rows) == len(documents)
    for r in rows:
        mentioned = surrogates.mentions(documents[r["doc_id"]])
        assert r["n_entities"] == len(mentioned)
        if not mentioned:
            assert r["text"] == documents[r["doc_id"]]
        for _, original in originals:
            assert original not in r["text"]
        assert [m[0] for m in surrogates.mentions(r["text"])] == [m[0] for m in mentioned]


def test_classifier_agrees_with_labels(spark):
    labels = {r["doc_id"]: r["quality"] for r in table(spark, DATA, "labels").collect()}
    kept = {r["doc_id"]: r["kept"] for r in QUERIES["op4_quality_classifier"](spark, DATA).collect()}
    right = Counter((labels[k], kept[k]) for k in labels)
    assert right[1, True] >= 0.97 * (right[1, True] + right[1, False])
    assert right[0, False] >= 0.9 * (right[0, True] + right[0, False])


def test_pieces_round_trip(spark, documents):
    rows = QUERIES["op5_sentencepiece"](spark, DATA).collect()
    own = pieces.Pieces(pieces.load_model())
    assert len(rows) == len(documents)
    for r in rows:
        assert r["round_trip"] and own.decode(r["ids"]) == documents[r["doc_id"]]


def test_lattice_is_exact():
    own = pieces.Pieces(pieces.load_model())
    for text in ["the cat", "Hello  world", "a\nb c", "naïve 漢字 \U0001f600 x", "aaaa bbbb", "  ", "x"]:
        ids, score, rest = own.encode(text, 5)
        whole = own.nbest(" " + text, 5)
        assert own.decode(ids) == text
        assert [score, *[r[0] for r in rest]] == pytest.approx([w[0] for w in whole])
        for _, edits in rest:
            made, at = [], 0
            for start, n, new in edits:
                made += ids[at:start].tolist() + new
                at = start + n
            assert own.decode(made + ids[at:].tolist()) == text
    assert own.decode(own.encode("▁ under ▁")[0]) == "▁ under ▁"


def test_fingerprints(spark, documents):
    rows = {r["doc_id"]: r for r in QUERIES["op9_fingerprints"](spark, DATA).collect()}
    ids = sorted(documents)
    assert set(rows) == set(ids)
    for k, following in zip(ids, ids[1:] + ids[:1]):
        made = fingerprints.edited(documents[k], documents[following])
        assert rows[k]["edited_sha256"] == hashlib.sha256(made.encode()).hexdigest()
        assert rows[k]["n_chars"] == len(documents[k])
        assert rows[k]["near_next"] == 1.0 or rows[k]["fingerprint"] != rows[following]["fingerprint"]
    long = [r for r in rows.values() if r["n_chars"] > 2000]
    assert np.mean([r["near_edited"] for r in long]) > np.mean([r["near_next"] for r in long]) + 0.2


def test_base_score_and_tree(spark, documents):
    held = {k: zlib.crc32(str(k).encode()) % 5 == 1 for k in documents}
    counts = Counter()
    for k, t in documents.items():
        if not held[k]:
            counts.update(scoring.words(t))
            counts["END"] += 1
    n, v = sum(counts.values()), len(counts)
    rows = QUERIES["op10_lm_scoring"](spark, DATA).collect()
    assert len(rows) == len(documents)
    for r in rows:
        tokens = scoring.words(documents[r["doc_id"]]) + ["END"]
        want = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        assert r["base_score"] == pytest.approx(want, rel=1e-9)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (len(tokens), sum(counts[w] > 0 for w in tokens), n, held[r["doc_id"]])
        assert -8 * len(documents[r["doc_id"]].encode()) - 8 < r["score"] < 0


def test_pipeline_is_its_stages(spark, documents):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, DATA).collect()
    source = table(spark, DATA, "documents")
    model, _, _ = quality.fit(source)
    clean = {k: t for k, t in documents.items() if quality.score_text(t, model) >= quality.THRESHOLD}
    comps, _ = brute_components(clean, 5)
    single = {k: t for k, t in clean.items() if comps[k] == k}
    c = duckdb.connect()
    import pandas as pd

    frame = pd.DataFrame({"doc_id": list(single), "text": list(single.values())})
    c.register("documents", frame)
    c.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{DATA}/benchmark.parquet'")
    bad = {r[0] for r in c.execute(decontamination.ORACLE_SQL).fetchall()}
    want = {k: surrogates.rewrite(t, {})[0] for k, t in single.items() if k not in bad}
    assert {r["doc_id"]: r["text"] for r in rows} == want
    own = pieces.Pieces(pieces.load_model())
    assert all(own.decode(r["ids"]) == r["text"] and r["n_chars"] == len(r["text"]) for r in rows)


def test_small_shards_split_only_where_needed(spark):
    rows = [(i, "x" * (50 if i % 3 else 400)) for i in range(200)] + [(7, "y" * 30)] * 50 + [(1000, "z" * 5000), (1001, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.shard(df, limit=1000).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for r in got:
        sizes[r["shard"]] += r["_bytes"]
    for r in got:
        assert sizes[r["shard"]] == r["shard_bytes"]
        assert r["oversize"] == (r["shard_bytes"] > 1000) and (not r["oversize"] or r["shard_docs"] == 1)
        if r["shard"]:
            assert sum(b for s, b in sizes.items() if s.startswith(r["shard"][:-1])) > 1000


def test_pieces_go_on_from_shared_beginnings():
    """Segments that begin alike are solved from where they part; each one alone gives the same."""

    class Counting(dict):
        looked = 0

        def get(self, *a):
            Counting.looked += 1
            return dict.get(self, *a)

    own, alone = pieces.Pieces(pieces.load_model()), pieces.Pieces(pieces.load_model())
    own.backward = Counting(own.backward)
    texts = [" ".join("stem" * 10 + x + y for y in "abcdefghij") for x in "klmnop"] + [None, "", "é日\x00 ▁ a▁b", "aaaaaaaa aaaaaaab aaaa"]
    together = list(own.encode_all(texts))
    assert Counting.looked < 1_000  # 60 words of 42 letters have 2,600 places
    for text, (ids, score, others) in zip(texts, together):
        ids_, score_, others_ = alone.encode(text)
        assert (ids.tolist(), score, others) == (ids_.tolist(), score_, others_)
        assert own.decode(ids.tolist()) == (text or "")
        for segment in own.segments.findall(" " + text) if text else []:
            best = own.nbest(segment)
            assert own.cache[segment][1] == pytest.approx(best[0][0])
            assert len(best) < 2 or own.cache[segment][2] == pytest.approx(best[0][0] - best[1][0])
