"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing column names."""

import pytest
from pyspark.sql import functions as F

from gneiss.llm import decontamination, fingerprints, html, licenses, near_dedup, pieces, quality, scoring, sharding, surrogates

PROSE = "the river of the north was wide and it ran to the sea with all that was in it for a long time. "
LONG = PROSE * 400
ROWS = [(1, LONG), (2, None), (3, ""), (4, "  \n\t"), (5, "one"), (5, "one"), (6, LONG + "end"), (None, "no id at all here"), (7, "ONE"), (8, PROSE + "▁ café \U0001f600")]
OPERATORS = {
    "1": lambda d: near_dedup.link(d),
    "1d": lambda d: near_dedup.dedup(d),
    "2": lambda d: surrogates.replace_pii(d, count="n_entities"),
    "3": lambda d: sharding.shard(d, limit=2000),
    "4": lambda d: quality.with_score(d),
    "5": lambda d: pieces.encode_column(d),
    "6": lambda d: licenses.scan(d),
    "7": lambda d: decontamination.decontaminate(d, d.sparkSession.createDataFrame([(1, None), (2, ""), (3, "one")], "item_id long, text string")),
    "8": lambda d: html.extract(d.withColumnRenamed("text", "html").withColumn("url", F.lit(None).cast("string"))),
    "9": lambda d: fingerprints.fingerprint_documents(d, ranges=3),
    "10": lambda d: scoring.score(d),
}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string").withColumns({n: F.lit(n) for n in ("ids", "n", "key", "kind", "node", "row", "shard", "_x", "lang")})


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(docs, name):
    got = OPERATORS[name](docs).collect()
    assert len(got) == (len(ROWS) - 3 if name in ("7", "1d") else len(ROWS))  # 1d: one row of id 5, one of the three "one"


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_near_duplicates_of_odd_rows(docs):
    got = {(r["doc_id"], r["n_shingles"]): (r["component_id"], r["kept"]) for r in near_dedup.link(docs).collect()}
    assert got[2, 0] == (2, True) and got[3, 0] == (3, True) and got[4, 0] == (4, True)
    assert got[5, 1] == (5, True) and got[7, 1] == (5, False)  # A-Z is lower-cased
    assert got[6, got_size(got, 6)] == (1, False)
    assert got[None, 4] == (None, True)


def got_size(got, doc_id):
    return next(n for k, n in got if k == doc_id)


def test_one_id_with_two_texts_links_them(spark):
    base = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    rows = [(1, base), (2, base + " x"), (2, other), (3, other + " y"), (4, "alone here now")]
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.link(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4}


def test_large_near_copy_group_is_one_component(spark):
    words = [f"w{i}" for i in range(300)]
    rows = [(k, " ".join(words[:k] + [f"edit{k}"] + words[k:])) for k in range(300)] + [(1000 + k, f"other text number {k} is not a copy of any") for k in range(50)]
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.link(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {got[k] for k in range(300)} == {0}


def test_surrogate_rules():
    text = "Mrs. Anna Schmidt (anna@web.de, +49 30 1234567) wrote to Dr. Иван Петров; Mrs. Anna Schmidt paid with 4111 1111 1111 1111 from 10.0.0.1."
    made, n = surrogates.rewrite(text, {})
    assert n == 7 and made == surrogates.rewrite(text, {})[0]
    assert not any(x in made for x in ("Schmidt", "anna@", "1234567", "Петров", "4111", "10.0.0.1"))
    kinds = [(k, made[s:e]) for k, s, e, _ in surrogates.mentions(made)]
    assert [k for k, _ in kinds] == ["person", "email", "phone", "person", "person", "card", "ip"]
    assert kinds[0] == kinds[4] and kinds[0][1].split()[0].endswith("a")
    assert all("Ѐ" <= c <= "ӿ" or c == " " for c in kinds[3][1])
    assert surrogates.luhn(surrogates.canonical("card", kinds[5][1])) == 0
    assert kinds[2][1].startswith("+49 ") and len(kinds[2][1]) == len("+49 30 1234567")
    assert surrogates.rewrite("numbers 12345 and 3.14 stay", {}) == ("numbers 12345 and 3.14 stay", 0)


def test_surrogates_keep_kind_and_person():
    text = "Mr. Robin Fox met Dr. Robin Fox and Mr. Fox. Robin Fox wrote from Марина@почта.рф. Frau Petra Fox has GB82 WEST 1234 5698 7654 32."
    made, n = surrogates.rewrite(text, {})
    assert n == 7
    names = [made[s:e] for k, s, e, _ in surrogates.mentions(made) if k == "person"]
    assert names[0] == names[1] == names[3] and names[0].split()[1] == names[2] == names[4].split()[1] and names[4].split()[0].endswith("a")
    mail = next(made[s:e] for k, s, e, _ in surrogates.mentions(made) if k == "email")
    assert mail[0].isupper() and all("Ѐ" <= c <= "ӿ" for c in mail.split(".")[0]) and sum(a == b for a, b in zip(mail, "Марина")) < 3
    iban = next(made[s:e] for k, s, e, _ in surrogates.mentions(made) if k == "iban").replace(" ", "")
    assert iban.startswith("GB") and surrogates._iban_rest(iban) == 1
    for one, kind in [("10.1.2.3", "ip"), ("192.168.7.9", "ip"), ("2001:db8::1", "ipv6"), ("fe80:0:0:0:1:2:3:4", "ipv6"), ("030 1234567", "phone"), ("06 12 34 56 78", "phone")]:
        found = surrogates.mentions(f"at {one} now")
        assert [(k, one) for k, *_ in found] == [(kind, one)]
        new = surrogates.rewrite(f"at {one} now", {})[0]
        assert one not in new and [k for k, *_ in surrogates.mentions(new)] == [kind]
    assert surrogates.rewrite("at 10.1.2.3", {})[0].startswith("at 10.")
    assert surrogates.canonical("ipv6", "2001:DB8::1") == surrogates.canonical("ipv6", "2001:db8:0:0:0:0:0:1")
    han, n = surrogates.rewrite("我叫王小明, 李先生说", {})
    assert n == 2 and "王小明" not in han and "李" not in han and all("一" <= c <= "鿿" for c in han.split(",")[0])
    for plain in ("std::vector and a::b", "01-02-2003 04/05/2006", "version 0 12", "Drive Miss", "12:30:45"):
        assert surrogates.rewrite(plain, {}) == (plain, 0)


def crowded():
    """More entities than draws of their format can tell apart, so that rounds are needed."""
    phones = [f"+1 {a} {b:02d}" for a in range(2) for b in range(0, 100, 2)]
    nets = [f"192.168.{a}.{b}" for a in range(3) for b in range(0, 256, 3)]
    names = [f"Mr. {c}{d}ov" for c in "BCDFG" for d in ("al", "el", "il", "ol", "ul")]
    return [(i, f"call {p} or {nets[i % len(nets)]} for {names[i % len(names)]} now") for i, p in enumerate(phones)]


def test_surrogates_stay_distinct(spark):
    """Against brute force: one surrogate for an entity, no two entities with one, and no surrogate that is an entity."""
    rows = crowded()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    redrawn = {(r["kind"], r["entity"]): r["attempt"] for r in surrogates.redraws(docs).collect()}
    assert max(redrawn.values()) > 1 and {k for k, _ in redrawn} >= {"phone"}
    out = {r["doc_id"]: r["text"] for r in surrogates.replace_pii(docs).collect()}
    pairs = {}
    for k, text in rows:
        assert out[k] == surrogates.rewrite(text, redrawn)[0]
        old, new = text.split(" or ")[0][5:], out[k].split(" or ")[0][5:]
        net, made = text.split(" or ")[1].split(" for ")[0], out[k].split(" or ")[1].split(" for ")[0]
        name, other = text.split(" for ")[1], out[k].split(" for ")[1]
        for a, b in ((old, new), (net, made), (name, other)):
            pairs.setdefault(a, set()).add(b)
    assert all(len(x) == 1 for x in pairs.values())
    assert len({x for v in pairs.values() for x in v}) == len(pairs)
    assert not {x for v in pairs.values() for x in v} & set(pairs)


def test_surrogates_by_join_are_those_by_broadcast(spark):
    docs = spark.createDataFrame([*crowded(), (900, None), (901, ""), (902, "plain")], "doc_id long, text string")
    one = sorted(map(str, surrogates.replace_pii(docs, count="n").collect()))
    assert one == sorted(map(str, surrogates.replace_pii(docs, count="n", block=0).collect()))


def test_license_words_and_places(spark):
    rows = [(1, "CC-BY cc by, CC  by"), (2, "General\nPublic\tLicense"), (3, "bcc by all rights reserved all rights reserved"), (4, "Released under the MIT license"), (5, "the mit of the license")]
    got = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1]["n_words"], got[1]["n_base"], got[1]["first_word"], got[1]["last_word"], got[1]["base_labels"]) == (6, 3, 0, 4, "cc-by")
    assert (got[2]["n_base"], got[2]["base_labels"]) == (1, "gpl")
    assert (got[3]["n_base"], got[3]["first_word"], got[3]["last_word"], got[3]["base_labels"]) == (2, 2, 5, "reserved")
    assert (got[4]["labels"], got[4]["base_labels"], got[4]["score"]) == ("mit", "", 1.0)
    assert got[5]["first_word"] is None and got[5]["labels"] == ""


def test_decontamination_short_items_and_thresholds(spark):
    item = " ".join(f"q{i}" for i in range(30))
    docs = spark.createDataFrame([(1, LONG + item.upper() + " " + LONG), (2, " ".join(item.split()[:27])), (3, " ".join(item.split()[:20])), (4, "say tiny item twice")], "doc_id long, text string")
    tests = spark.createDataFrame([(1, item), (2, "tiny item")], "item_id long, text string")
    got = {(r["_id"], r["item_id"]): r["containment"] for r in decontamination.contaminated(docs, tests).collect()}
    assert got == {(1, 1): 1.0, (2, 1): pytest.approx(23 / 26), (4, 2): 1.0}
    assert [r["doc_id"] for r in decontamination.decontaminate(docs, tests).collect()] == [3]


def test_html_consensus_and_furniture(spark):
    def page(k, body):
        return (k, f"https://h.example/{k}", f"<html><head><title>t</title><script>var x='</p>';</script></head><body><header>Top</header><nav><a href='#'>menu</a></nav>{body}<div class='cookie-notice'>accept</div><section id='comments'><p>first!</p></section><form>mail</form><footer>foot</footer></body></html>")

    text = "A long paragraph of the article&#39;s own words that goes on. " * 3
    pages = [page(k, f"<div class='post post-{k}'><h1>Title&nbsp;{k}</h1><p>{text}<p>two\n  lines</div><aside>side</aside>") for k in range(5)]
    pages.append(page(9, f"<div class='post post-9'><p>short</p></div><div class='promo-list'><p>{text * 5}</p></div><div class='links'><p>{text * 5}</p></div>"))
    pages += [(10, None, None), (11, "odd", ""), (12, "https://plain.example/", "just text &amp; more")]
    got = {r["page_id"]: r["text"] for r in html.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got[0] == "Title 0\n\n" + text.replace("&#39;", "'").strip() + "\n\ntwo lines"
    assert got[9] == "short"  # the host's path wins over the longer block of links
    assert (got[10], got[11], got[12]) == ("", "", "just text & more")


def test_fingerprint_shares_parts_at_any_offset():
    import random

    rng = random.Random(3)
    text = "".join(rng.choice("abcdefghij klmno") for _ in range(6000))
    a, b, c = fingerprints.fingerprints([text, "some other words before " + text, "".join(rng.sample(text, len(text)))])
    assert fingerprints.likeness(a[None], b[None])[0] > 0.8
    assert fingerprints.likeness(a[None], c[None])[0] < 0.2
    empty = fingerprints.fingerprints(["", ""])
    assert fingerprints.likeness(empty[:1], empty[1:])[0] == 1.0


def test_next_document_across_ranges(spark):
    rows = [(k, f"text {k} " + "abc" * k) for k in range(40)] + [(7, f"same id {k}") for k in range(60)] + [(None, "no id"), (None, None), (50, None), (51, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    one = sorted(map(str, fingerprints.fingerprint_documents(docs, ranges=1).collect()))
    assert len(one) == len(rows)
    assert one == sorted(map(str, fingerprints.fingerprint_documents(docs, ranges=7).collect()))
    assert one == sorted(map(str, fingerprints.fingerprint_documents(docs, ranges=500).collect()))
    (alone,) = fingerprints.fingerprint_documents(docs.where("doc_id = 50"), ranges=3).collect()
    assert (alone["n_chars"], alone["near_next"]) == (0, 1.0)


def test_likeness_of_long_unrelated_texts():
    import random

    one, two = ("".join(random.Random(k).choices("abcdefghij klmno", k=3_000_000)) for k in (1, 2))
    a, b = fingerprints.fingerprints([one, two])
    assert fingerprints.likeness(a[None], b[None])[0] < 0.05


def test_em_finds_the_better_labeller():
    posterior, accuracy = quality.expectation_maximisation(["1111111?", "0011111?", "1100000?", "00000000"], [800, 60, 20, 120])
    assert posterior["1111111?"] > 0.9 and posterior["00000000"] < 0.1
    assert (accuracy >= 0).all() and (accuracy <= 1).all()


def plain_tree(rows, held):
    """The suffix tree with dictionaries: functions that score a text and tell the divergence of a context."""
    import math
    from collections import Counter, defaultdict

    end = b""
    train = [scoring.words(t) + [end] for k, t in rows if not held[k]]
    words = Counter(w for d in train for w in d)
    total, kinds = sum(words.values()), len(words)
    spelled = defaultdict(Counter)

    def cell(run, depth):
        context = (run >> 9) & ((1 << 9 * depth) - 1)
        if depth in scoring.CELLS:
            context = ((context * int(scoring.STEP)) % (1 << 64) >> 40) % scoring.CELLS[depth]
        return depth, context

    def runs(word):
        s = [256] * 3 + list(word) + [32]
        return [sum(s[i - k] << 9 * k for k in range(4)) for i in range(3, len(s))]

    for w in words:
        for run in runs(w) if w else []:
            for depth in range(4):
                spelled[cell(run, depth)][run & 511] += 1

    def spell(word):
        if not word:
            return 1 / 257
        out = 256 / 257
        for run in runs(word):
            p = 1 / 256
            for depth in range(4):
                own = spelled.get(cell(run, depth))
                if own:
                    p = (own[run & 511] + len(own) * p) / (sum(own.values()) + len(own))
            out *= p
        return out

    follow = defaultdict(Counter)
    for d in train:
        s = [end, end, *d]
        for i in range(2, len(s)):
            follow[(s[i - 1],)][s[i]] += 1
            follow[s[i - 2], s[i - 1]][s[i]] += 1

    def chance(context, x):
        if not context:
            return (words[x] + max(1, kinds) * spell(x)) / (total + max(1, kinds))
        below, n = chance(context[1:], x), sum(follow[context].values()) if context in follow else 0
        m = scoring.ESCAPE * n**scoring.GROWTH
        return (follow[context][x] + m * below) / (n + m) if n >= scoring.MIN_COUNT else below

    def gain(context):
        n = sum(follow[context].values()) if context in follow else 0
        return sum(k * math.log(k / n / chance(context[1:], x)) for x, k in follow[context].items()) if n >= scoring.MIN_COUNT else 0.0

    def contexts(text):
        s = [end, end, *scoring.words(text), end]
        return [((s[i - 2], s[i - 1]), (s[i - 1],), s[i]) for i in range(2, len(s))]

    def score(text):
        return sum(math.log10(chance(next((c for c in (two, one) if gain(c) > scoring.DIVERGENCE), ()), x)) for two, one, x in contexts(text))

    def nearest(text):
        """How near the divergence of one of its contexts is to the limit."""
        return min(abs(gain(c) - scoring.DIVERGENCE) for two, one, _ in contexts(text) for c in (two, one))

    return score, gain, nearest


def tree_rows():
    import random

    rng = random.Random(5)
    names = ["".join(rng.choice("abcdeé漢") for _ in range(rng.randint(1, 7))) for _ in range(60)]
    rows = [(k, " ".join(rng.choice(names[: 5 + k % 50]) for _ in range(rng.randint(0, 80)))) for k in range(300)]
    return rows + [(1000, None), (1001, ""), (1002, " \n"), (1003, rows[7][1]), (1004, rows[7][1] + " never\udc80seen words")]


@pytest.mark.parametrize("hot", [scoring.HOT, 10])
def test_tree_is_that_of_dictionaries(spark, hot):
    """Many groups and shards, and hot contexts dealt over shards, against a plain implementation."""
    rows = [(k, t and t.replace("\udc80", "x")) for k, t in tree_rows()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3, "doc_id")
    got = {r["doc_id"]: r for r in scoring.score(docs, group=2000, hot=hot).collect()}
    assert len(got) == len(rows)
    score, gain, nearest = plain_tree(rows, {k: r["held_out"] for k, r in got.items()})
    pairs = {p for _, t in rows[:300] for p in zip(scoring.words(t), scoring.words(t)[1:])}
    assert 20 < sum(gain(p) > scoring.DIVERGENCE for p in pairs) < len(pairs) - 20
    clear = [(k, t) for k, t in rows if nearest(t) > 30 / 2 / scoring.NAT]  # each group's share of a divergence is rounded
    assert len(clear) > 0.5 * len(rows)
    assert [got[k]["score"] for k, _ in clear] == pytest.approx([score(t) for _, t in clear], rel=1e-9 if hot > 10 else 0.05)


def test_scores_behind_a_shuffle(spark):
    """Groups are named once, so rows that come in another order on every read stay whole."""
    rows = [(k, f"w{k} " * (k % 7) + "same words here") for k in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").groupBy("doc_id").agg(F.max("text").alias("text"))
    got = {r["doc_id"]: r["n_tokens"] for r in scoring.score(docs).collect()}
    assert got == {k: k % 7 + 4 for k, _ in rows}


def test_no_training_text(spark):
    """All held out: N = V = 0, and words are spelled uniformly."""
    import math
    import zlib

    ids = [k for k in range(200) if zlib.crc32(str(k).encode()) % 5 == 1][:3]
    got = scoring.score(spark.createDataFrame([(k, "ab") for k in ids], "doc_id long, text string")).collect()
    assert {(r["train_tokens"], r["n_known"], r["n_tokens"]) for r in got} == {(0, 0, 2)}
    assert all(r["score"] == pytest.approx(math.log10(256 / 257 / 256**3 / 257)) for r in got)


def test_held_out_texts_score_better_than_the_base(spark):
    rows = scoring.op10_lm_scoring(spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert rows[0] > rows[1]


def test_chances_sum_to_one():
    import itertools

    import numpy as np

    model = scoring.Spelling(*scoring.spelling_counts([b"ab", b"abc", b"c"]))
    assert sum(model.chance([bytes(x) for n in range(1, 4) for x in itertools.product(b"abcd", repeat=n)])) < 1
    seen = np.array([3, 2, 0, 0])
    parent = np.array([0.5, 0.2, 0.2, 0.1])
    assert scoring.smoothed(seen, np.full(4, 5), parent).sum() == pytest.approx(1)


@pytest.mark.parametrize(
    "body",
    [
        "<p class='notice'>Note<p>Kept one.</p><p>Kept two.</p>",
        "<section><p class='notice'>Note <b>well</b></section><p>Kept one.</p><p>Kept two.</p>",
        "<ul><li class='ad'>Buy<ul><li>a<li>b</ul><li>Kept one.</ul><p>Kept two.</p>",
        "<ol><li class='ad'>Buy</ol><p>Kept one.<p>Kept two.",
        "<table><tr><td class='ad'>Buy<table><tr><td>x</table><td>Kept one.</table><p>Kept two.</p>",
        "<dl><dt class='ad'>Buy<dd>Kept one.</dl><p>Kept two.</p>",
        "<p class='notice'>Note</p><p>Kept one.</p><p>Kept two.</p>",
    ],
)
def test_html_furniture_without_end_tag(body):
    found = html.blocks(f"<html><body><article>{body}</article></body></html>")
    assert [text for text, _, _ in found] == ["Kept one.", "Kept two."]


@pytest.mark.parametrize(
    "body",
    [
        "<article><h1>Head</h1><p>lead</p><section>{a}</section><section>{b}</section></article>",
        "<article><h1>Head</h1><p>lead</p><section class='x'>{a}</section><section class='y'>{b}</section></article>",
        "<article><section><div><h1>Head</h1><p>lead</p></div><div class='t'>{a}</div></section><section class='z'><div>{b}</div></section></article>",
        "<main><h1>Head</h1><p>lead</p><table><tr><td>{a}</td></tr></table><p>{b}</p></main>",
        "<div class='post'><h1>Head</h1><p>lead</p><div class='text'>{a}</div><table><tr><td>{b}</td></tr></table></div>",
        "<div class='post'><section class='i'><h1>Head</h1><p>lead</p></section><section class='x'>{a}</section><section class='y'>{b}</section></div>",
    ],
)
def test_html_nested_sections_and_tables(spark, body):
    a, b = "A long part of the article in words. " * 9, "Another long part of it that follows. " * 12
    page = f"<html><body><nav><a href='#'>menu</a></nav>{body.format(a=a, b=b)}<div class='more'><a href='#'>other story</a></div></body></html>"
    pages = [(k, f"https://h.example/{k}", page) for k in range(4)]
    got = html.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert {r["text"] for r in got} == {"\n\n".join(["Head", "lead", a.strip(), b.strip()])}


def test_variety_is_that_of_the_whole_text():
    place = quality.LABELLERS.index("variety")
    prose = " ".join(f"w{i}" for i in range(4000))
    assert quality.votes(prose)[place] == 1
    assert quality.votes(prose + " junk again" * 30_000)[place] == 0
    words = [f"{i * i % 97 * (i // 3000)}".encode() for i in range(9000)]
    runs = [len(set(words[i : i + 4000])) / 4000 for i in range(5001)]
    assert quality.variety(words) == pytest.approx(sum(runs) / len(runs))


def test_license_notices_wrapped_over_lines(spark):
    mit = "# Permission is hereby granted, free of\n# charge, to any person obtaining a copy\n# of this software and associated\n# documentation files"
    gpl = "some words\nThis program is free software: you can redistribute\n * it and/or modify it under the terms\n * of the GNU General Public\n\n * License as published"
    far = "permission is granted\n" + "other words here\n" * 9 + "hereby free of charge to any\n" + "other words here\n" * 9 + "person obtaining a copy of this software and associated documentation files"
    rows = [(1, mit), (2, gpl), (3, far), (4, "released under\nthe"), (5, "\n"), (6, "released\nunder the MIT")]
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == ("mit", 1.0) and got[2] == ("gpl,lgpl", 1.0)  # most words of the lgpl are the same
    assert got[3] == got[4] == got[5] == ("", 0.0)
    assert got[6] == ("mit", 0.8)


@pytest.mark.parametrize(
    "body, text",
    [
        ("<div class='post'><header><h1>Head</h1></header><p>{a}</p></div>", "Head\n\n{a}"),
        ("<nav><a href='#'>menu</a><article><h1>Head</h1><p>{a}</p></article>", "Head\n\n{a}"),
        ("<div><aside>side <b>bar</b></div><article><p>{a}</p></article>", "{a}"),
    ],
)
def test_html_headers_and_broken_furniture(spark, body, text):
    a = "A long part of the article in words. " * 9
    page = f"<html><body><header>Top</header>{body.format(a=a)}<footer>foot</footer></body></html>"
    got = html.extract(spark.createDataFrame([(1, "https://h.example/1", page)], "page_id long, url string, html string")).collect()
    assert [r["text"] for r in got] == [text.format(a=a.strip())]


def test_html_hosts_by_join_and_pages_without_host(spark):
    a = "A long part of the article in words. " * 9
    one, two = f"<body><div class='x'><p>{a}</p></div></body>", f"<body><div class='y'><p>{a}</p></div><div class='x'><p>short</p></div></body>"
    rows = [(k, f"https://h{k % 7}.example/{k}", one) for k in range(60)] + [(k, None, one) for k in range(100, 130)] + [(200, "//h.example/x", two), (201, "", two)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted(map(str, html.extract(pages).collect()))
    assert got == sorted(map(str, html.extract(pages, limit=0).collect()))
    assert sum(a.strip() in r for r in got) == len(rows)  # pages without a host do not decide for one another


def test_decontamination_by_join_and_ids(spark):
    """Every way of joining gives the same; null and repeated ids of documents and items do not mix."""
    import random

    rng = random.Random(3)
    items = [(k if k % 5 else None, " ".join(f"v{rng.randrange(5000)}" for _ in range(n))) for k, n in enumerate([2, 4, 5, 9, 19, 20, 25, 60, 150, 300, 700, 2000])]
    items += [(3, "another text under one id of nine words all"), (3, "another text under one id of nine words all")]
    docs = [(k if k % 4 else None, f"before {k} " + " ".join(x for i, x in enumerate(t.split()) if i != 7) + " after") for k, (_, t) in enumerate(items)]
    docs += [(100, items[-3][1][:6000]), (100, "harmless"), (None, "harmless too"), (101, None)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = sorted(map(str, decontamination.contaminated(d, b).collect()))
    assert got == sorted(map(str, decontamination.contaminated(d, b, rows=0, keys=0).collect()))

    def grams(text, n):
        w = text.lower().split()
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}

    want = set()
    for doc_id, text in docs:
        for item_id, item in items:
            n = min(5, len(item.split()))
            own = grams(item, n)
            common = len(own & grams(text or "", n))
            if 100 * common >= 80 * len(own):
                want.add((doc_id, text, item_id, item, common))
    rows = decontamination.contaminated(d, b).collect()
    assert sorted((str(r["_id"]), str(r["item_id"]), r["n_common"]) for r in rows) == sorted((str(a), str(c), n) for a, _, c, _, n in want)
    left = decontamination.decontaminate(d.withColumn("bad_id", F.lit(1)).withColumn("_key", F.lit(2)), b).collect()
    assert sorted(str(r["text"]) for r in left) == sorted(str(t) for k, t in docs if not any((k, t) == (x[0], x[1]) for x in want))


def test_templated_texts_branch_on(spark):
    """Many texts on one template, none alike enough but two: the pair is found, no other is linked, and large nodes are split."""
    template = [f"t{i}" for i in range(170)]
    rows = [(k, " ".join(template + [f"u{k}x{i}" for i in range(29)])) for k in range(180)]
    rows.append((500, " ".join(template + [f"u3x{i}" for i in range(27)] + ["z1", "z2"])))
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.link(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {**{k: k for k in range(180)}, 500: 3}


def test_dedup_keeps_one_row_of_an_id(spark):
    rows = [(1, "one two three four five six"), (1, "one two three four five six"), (2, "one two three four five six"), (3, "other"), (None, "other"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("gone", F.lit(0)).withColumn("times", F.lit(0))
    got = near_dedup.dedup(docs).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["1", "3", "None", "None"] and got[0].asDict().keys() == {"doc_id", "text", "gone", "times"}


def test_sample_of_the_classifier_is_bounded(spark):
    assert quality.sample_limit(100, 8000) == (1 << 63) - 1
    for n in (10**5, 10**10, 10**14):
        share = (quality.sample_limit(n, 8000) + (1 << 63)) / 2**64
        assert 8000 < share * n < 9000
    docs = spark.createDataFrame([(None, f"{PROSE} {k}") for k in range(300)] + [(7, "### !!! same $$$")] * 300, "doc_id long, text string")
    seen = []
    keep = quality.fit_scorer
    quality.fit_scorer = lambda rows: seen.append(len(rows)) or keep(rows)
    try:
        quality.fit(docs, sample=50)
    finally:
        quality.fit_scorer = keep
    assert seen == [50]


def test_em_is_that_of_dictionaries():
    """Dawid-Skene written out, over patterns one by one."""
    import math

    counts = {"1111111?": 800, "0011111?": 60, "1100000?": 20, "00000000": 120, "1?1?1?1?": 33, "0?0?1?0?": 12}
    post = {p: 0.1 if p.count("0") > p.count("1") else 0.6 if "0" in p else 0.95 for p in counts}
    for _ in range(quality.ROUNDS):
        prior, chance = {}, {}
        for y in (0, 1):
            share = {p: post[p] if y else 1 - post[p] for p in counts}
            prior[y] = max(1.0, sum(counts[p] * share[p] for p in counts)) / sum(counts.values())
            for k in range(8):
                held = {v: 0.5 + sum(counts[p] * share[p] for p in counts if p[k] == v) for v in "01"}
                for v in "01":
                    chance[y, k, v] = held[v] / (held["0"] + held["1"])
        for p in counts:
            logs = [math.log(prior[y]) + sum(math.log(chance[y, k, v]) for k, v in enumerate(p) if v != "?") for y in (0, 1)]
            post[p] = 1 / (1 + math.exp(max(-60, min(60, logs[0] - logs[1]))))
    got, _ = quality.expectation_maximisation(list(counts), list(counts.values()))
    assert {p: got[p] for p in counts} == pytest.approx(post, abs=1e-6)


@pytest.mark.parametrize("name", OPERATORS)
def test_private_names_do_not_clash(spark, name):
    """Columns with the names that operators use inside, in any case."""
    used = ("gone", "times", "done", "Row", "own", "_key", "_bits", "_bytes", "quality_score", "encoded", "low", "NORM", "list", "hits", "wide", "base", "_id", "_t", "_words", "bad_id", "bad_key", "h", "host", "path", "salt", "own_salt", "group", "held_out")
    docs = spark.createDataFrame([(1, PROSE), (2, None), (3, PROSE + "end")], "doc_id long, text string").withColumns({n: F.lit(f"kept {n}") for n in used})
    rows = OPERATORS[name](docs).collect()
    assert rows
    if name in ("1d", "2", "4", "5", "6", "7", "8"):
        assert all(r[n] == f"kept {n}" for r in rows for n in used)


def test_write_shards_keeps_rows(spark, tmp_path):
    docs = spark.createDataFrame([(k, "x" * (k % 300), "kept") for k in range(400)], "doc_id long, text string, lang string")
    sharding.write_shards(docs, str(tmp_path / "out"), limit=5000)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, back.select("doc_id", "text", "lang").collect())) == sorted(map(tuple, docs.collect()))
    assert back.groupBy("shard").agg(F.sum(F.length("text")).alias("n")).where("n > 5000").count() == 0
