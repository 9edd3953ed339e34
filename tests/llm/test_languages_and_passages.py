import random
import re
import zlib

import corpus_pipeline
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from silverbrook.llm import language_id as lang
from silverbrook.llm import queries as llm_queries
from silverbrook.llm import substring_dedup as sub
from silverbrook.llm.decontamination import Matcher, Pattern, budget, drop_contaminated, find_passages, plain

# ---- language identification


def test_gradients_agree_with_differences():
    rng = np.random.default_rng(0)
    net = lang.Network.random(["a", "b", "c"], 4)
    for way in (net.forward, net.backward):
        way.inputs, way.gates, way.new = (w.astype(np.float64) for w in way.weights())
    data, labels = rng.integers(97, 101, (7, 5)), rng.integers(0, 3, 5)
    _, gradients = net.gradients(data, labels)
    for weight, gradient in zip(net.weights(), gradients, strict=True):
        for _ in range(5):
            at = tuple(rng.integers(0, s) for s in weight.shape)
            if weight.shape[-1] == 256:
                at = (at[0], 97 + int(rng.integers(0, 4)))
            was, step = weight[at], 1e-2
            weight[at] = was + step
            up = net.gradients(data, labels)[0]
            weight[at] = was - step
            down = net.gradients(data, labels)[0]
            weight[at] = was
            assert abs((up - down) / (2 * step) - gradient[at]) < 1e-3


def test_every_byte_counts_once():
    assert [sum(lang.WINDOW - c for _, c in lang._windows(n, lang.WINDOW)) for n in (128, 129, 300, 1024)] == [128, 129, 300, 1024]
    net = lang.Network.random(["a", "b"], 3)
    text = bytes(range(32, 127)) * 5
    shares = lang.pooled(net, [text, b"x", text])
    assert np.allclose(shares.sum(axis=1), 1, atol=1e-4) and np.allclose(shares[0], shares[2], atol=1e-6)


WORDS = {"en": ["the", "and", "with", "that", "from", "this"], "fr": ["les", "avec", "dans", "pour", "être", "été"]}


def _docs(spark, count=600):
    rng = random.Random(5)
    rows = []
    for doc in range(count):
        name = rng.choice(list(WORDS))
        rows.append((doc, " ".join(rng.choices(WORDS[name], k=rng.randint(3, 60))), name))
    rows += [(count, None, "en"), (count + 1, "123 ...", "fr"), (None, "the and with that from this", None), (count + 2, "", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_held_out_accuracy(spark):
    docs = _docs(spark)
    found = lang.language_id(docs).join(docs, "doc_id").collect()
    out = [r for r in found if r.held_out and r.doc_id < 600]
    assert len(out) > 100
    assert sum(r.lang_pred == r.lang for r in out) / len(out) >= 0.97
    assert all(0 <= r.score <= 1 for r in found)
    unknown = {r.doc_id for r in found if r.lang_pred == "und"}
    assert unknown == {600, 601, 602} and all(r.score == 0 for r in found if r.doc_id in unknown)


def test_nothing_is_learned_from_held_out_rows(spark, edge_docs, no_docs):
    docs = _docs(spark)
    learned = sorted((r.lang, r.text) for r in lang.training_sample(docs, 10**6).collect())
    labelled = [r for r in docs.collect() if r.lang is not None and r.text is not None and r.doc_id is not None]
    assert learned == sorted((r.lang, r.text) for r in labelled if zlib.crc32(str(r.doc_id).encode()) % 4 != 2)
    assert lang.training_sample(docs, 5).count() == 10
    assert lang.predict_languages(edge_docs, None).filter("lang_pred <> 'und' OR score <> 0").isEmpty()
    assert lang.learn(no_docs) is None and lang.language_id(no_docs).count() == 0


def test_a_language_of_more_than_2_to_the_23_rows_is_drawn(spark):
    docs = spark.range(11_500_000).selectExpr("id AS doc_id", "'the and with' AS text", "'en' AS lang")
    assert docs.filter(~lang.held_out(docs["doc_id"])).count() > 2**23
    assert lang.training_sample(docs, 400).count() == 400


def test_documents_stay_where_nothing_or_many_languages_were_learned(spark):
    docs = _docs(spark, 40)
    ids = {r.doc_id for r in docs.collect()} - {40, 41, 42}
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.language(spark, unlabelled, "")
    assert {r.doc_id for r in kept.collect()} == ids and kept.columns == unlabelled.columns
    # One of ten languages at about three times an even choice.
    net = lang.Network.random([f"l{i}" for i in range(10)], 2)
    net.output[:], net.bias[:] = 0, 0
    net.bias[3] = np.log(3.9)
    assert 0.25 < lang.classify(net, ["some text"])[0][1] < 0.4
    assert {r.doc_id for r in lang.documents_in_known_languages(docs, net, 0.4).collect()} == ids
    net.bias[3] = 0
    assert lang.documents_in_known_languages(docs, net, 0.4).count() == 0


# ---- repeated passages


@given(st.one_of(st.binary(max_size=2000), st.text("ab ", max_size=500).map(str.encode), st.sampled_from([b"ab cd " * 90, b"x" * 300])))
@settings(max_examples=100, deadline=None)
def test_chunks_cover_a_text(data):
    ends, tied = sub.cuts(np.frombuffer(data, np.uint8))
    lengths = [int(b - a) for a, b in zip([0, *ends], ends, strict=False)]
    assert sum(lengths) == len(data) and all(x > 0 for x in lengths)
    assert all(x > sub.RADIUS for x in lengths[1:-1]) and len(tied) == len(ends)


def test_hash_rolls_over_its_window():
    data = np.frombuffer(random.Random(1).randbytes(100), np.uint8)
    got = sub.rolling_hash(data)
    for i in (0, 6, 7, 8, 15, 99):
        want = 0
        for j in range(max(0, i - sub.WINDOW + 1), i + 1):
            want = ((want << 1) + int(sub.GEAR[data[j]])) % 2**32
        assert int(got[i]) == want


def test_insertions_move_near_cuts_only():
    data = random.Random(2).randbytes(20_000)
    changed = data[:1000] + b"new" + data[1000:]
    a = set(sub.cuts(np.frombuffer(data, np.uint8))[0].tolist())
    b = {x - 3 if x > 1000 else x for x in sub.cuts(np.frombuffer(changed, np.uint8))[0].tolist()}
    reach = sub.RADIUS + sub.WINDOW + 3
    assert all(1000 - reach <= x <= 1000 + reach for x in a ^ b)


@pytest.mark.parametrize("block", [None, 16])
def test_windows_of_words_against_brute_force(monkeypatch, block):
    if block:  # a text of several blocks
        monkeypatch.setattr(sub, "_BLOCK", block)
        monkeypatch.setattr(sub, "_BLOCK_POWER", pow(sub._BASE, block, 2**64))
        monkeypatch.setattr(sub, "_BLOCK_INVERSE", pow(sub._INVERSE, block, 2**64))
    rng = random.Random(6)
    for _ in range(200):
        own, other = ("".join(rng.choices(["ab", "c", " ", "  ", "\n"], k=rng.randint(0, 60))).encode() for _ in range(2))
        text, part = sub._Words(own, 4), sub._Words(other, 4)
        text.sort()
        covered = set()
        for first, last in text.common(part):
            assert other[part.starts[first] : part.ends[last]] in own and last - first + 1 >= 4
            covered.update(range(first, last + 1))
        windows = {text.bytes(i, i) for i in range(len(text.hashes))}
        hits = [i for i in range(len(part.hashes)) if part.bytes(i, i) in windows]
        assert covered == {w for i in hits for w in range(i, i + 4)}


def _prose(rng, words, longest=9):
    return " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, longest))) for _ in range(words))


def _covered(rows):
    places = {}
    for r in rows:
        places.setdefault(r.doc_id, set()).update(range(r.start, r.start + r.length))
    return places


def _covered_by_hand(texts, width=sub.MIN_WORDS):
    """Bytes of every window of so many words that an earlier document holds too."""
    spans = {d: [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)] for d, raw in texts.items()}
    windows = [(d, p[i][0], p[i + width - 1][1]) for d, p in sorted(spans.items()) for i in range(len(p) - width + 1)]
    first, places = {}, {}
    for d, a, b in windows:
        if first.setdefault(texts[d][a:b], d) < d:
            places.setdefault(d, set()).update(range(a, b))
    return places


def test_query_against_all_windows(spark):
    sf_dir = "/root/testdata/sf0.01"
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = llm_queries.op1_substring_dedup(spark, sf_dir).collect()
    for r in rows:
        assert r.keep_id < r.doc_id and texts[r.doc_id][r.start : r.start + r.length] in texts[r.keep_id]
    assert _covered(rows) == _covered_by_hand(texts) != {}


def test_short_worded_and_periodic_passages(spark):
    rng = random.Random(7)
    texts, want = [], set()
    for n in range(300):
        pair = [_prose(rng, 1, 3) + str(n), _prose(rng, 1, 3)]
        passage = [_prose(rng, 51), _prose(rng, 51, 2), " ".join((pair * 26)[:51]), _prose(rng, 40)][n % 4]
        for _ in range(2):
            texts.append(f"{_prose(rng, rng.randint(5, 40))} {passage} {_prose(rng, rng.randint(5, 40))}")
        if n % 4 < 3:
            want.add((2 * n + 1, 2 * n, len(passage)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rows = sub.repeated_passages(docs).collect()
    # A passage of 40 words is none; one of 51 is told whole, from its first word to its last.
    assert {(r.doc_id, r.keep_id, r.length) for r in rows} <= want and len(rows) >= 0.99 * len(want)


def test_shared_passages_are_found_and_clean_texts_left(spark, monkeypatch):
    monkeypatch.setattr(sub, "ASKS_AT_ONCE", 2)  # owners' texts are sent several times
    rng = random.Random(3)
    texts = [_prose(rng, 200) for _ in range(120)]
    passages = [_prose(rng, 60) for _ in range(10)]
    for doc in range(60):
        p = passages[doc % 10]
        texts[doc] = f"{texts[doc][: 17 * doc]} after{doc} {p} before{doc} {texts[doc][17 * doc :]}"
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = sub.repeated_passages(docs)
    rows = found.collect()
    assert [(r.doc_id, r.keep_id, r.words) for r in sorted(rows)] == [(d, d % 10, 60) for d in range(10, 60)]
    left = {r.doc_id: r.text for r in sub.without_repeats(docs, found).collect()}
    assert left == {d: t.replace(passages[d % 10], "") if 10 <= d < 60 else t for d, t in enumerate(texts)}


def test_repeated_passages_edge_cases(edge_docs, clashing_docs, no_docs):
    for docs in (edge_docs, clashing_docs):
        rows = sub.repeated_passages(docs).collect()
        # The long text and its near copy; a repeated row is no other document.
        assert {(r.doc_id, r.keep_id) for r in rows} == {(10, 9)}
    assert sub.repeated_passages(no_docs).count() == 0
    assert sub.without_repeats(edge_docs, sub.repeated_passages(edge_docs)).count() == edge_docs.count()


def test_rows_without_id_are_told_apart(spark):
    rng = random.Random(8)
    passages = [_prose(rng, 80) for _ in range(6)]
    rows = [(5, _prose(rng, 100) + " " + passages[0])]
    rows += [(None, _prose(rng, 50 + 10 * i) + " " + passages[i % 6] + " " + _prose(rng, 40)) for i in range(24)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = sub.repeated_passages(docs)
    spans = found.collect()
    # Of each passage all rows but its owner's show it, whole.
    assert len({r.doc for r in spans}) == len(spans) == 24 + 1 - 6 and {r.keep_id for r in spans} == {5, None}
    assert all(r.doc_id is None and r.words == 80 for r in spans)
    left = [r.text for r in sub.without_repeats(docs, found).collect()]
    assert len(left) == 25
    for p in passages:
        assert sum(p in text for _, text in rows) >= 4 and sum(p in text for text in left) == 1


def test_texts_that_share_an_id_are_told_apart(spark):
    rng = random.Random(9)
    p, q, r = (_prose(rng, 70) for _ in range(3))
    rows = [(3, f"{p} {_prose(rng, 30)}"), (7, f"{_prose(rng, 20)} {p}"), (7, f"{_prose(rng, 45)} {q} {p}"), (8, f"{q} {r}"), (8, f"{q} {r}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = sub.repeated_passages(docs)
    # Texts under a shared id come after all others; equal rows are one document.
    assert sorted((x.doc_id, x.keep_id, x.words) for x in found.collect()) == [(7, 3, 70), (7, 3, 70), (7, 8, 70)]
    left = [x.text for x in sub.without_repeats(docs, found).collect()]
    assert [sum(x in text for text in left) for x in (p, q, r)] == [1, 2, 2]


# ---- benchmark passages


def _distance(item, text):
    """Smallest edit distance of the item to any substring, by the plain table."""
    before = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        row = [i] + [0] * len(text)
        for j, d in enumerate(text, 1):
            row[j] = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (c != d))
        before = row
    return min(before)


@given(st.text("abc", min_size=1, max_size=12), st.text("abc", max_size=20))
@settings(max_examples=300, deadline=None)
def test_bit_parallel_distance(item, text):
    distance, end = Pattern(item).best_end(text)
    assert distance == _distance(item, text) == _distance(item, text[:end])


def test_no_passage_within_the_budget_is_lost():
    rng = random.Random(4)
    for _ in range(150):
        items = ["".join(rng.choices("abcd ", k=rng.randint(8, 25))) for _ in range(5)]
        matcher = Matcher([(t, [n]) for n, t in enumerate(items)], 0.2)
        own = list(items[0])
        for _ in range(rng.randint(0, 5)):
            own[rng.randrange(len(own))] = rng.choice("abcd")
        text = "".join(rng.choices("abcd ", k=30)) + "".join(own) + "".join(rng.choices("abcd ", k=30))
        found = list(matcher.find(text))
        want = {n: _distance(t, text) for n, t in enumerate(items) if _distance(t, text) <= budget(t, 0.2)}
        assert {n: d for n, d, _, _ in found} == want
        assert all(_distance(items[n], text[a:b]) == d for n, d, a, b in found)


ITEM = "Which river flows through the old town, and how many bridges cross it today?"


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, ITEM), (2, ITEM), (3, None), (4, "too short"), (5, "The boiling point of water falls as one climbs; why is that so?")]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_passages_with_edits(spark, benchmark, monkeypatch):
    filler = " ".join(f"filler{i}" for i in range(300))
    rows = [
        (0, filler),
        (1, f"{filler} {ITEM} {filler}"),
        (2, f"{filler} {ITEM.upper().replace(' ', '  ').replace('?', '!')}"),
        (3, f"{ITEM.replace('river', 'rivers').replace('many', 'mny')} {filler}"),
        (4, f"{filler} {ITEM[: len(ITEM) // 2]}"),
        (5, None),
        (6, ""),
        (None, ITEM),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {(d, i) for d in (1, 2, 3, None) for i in (1, 2)}
    found = find_passages(docs, benchmark)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == want
    assert {r.distance for r in found.filter("doc_id = 3").collect()} == {2}
    assert sorted(r.doc_id for r in drop_contaminated(docs, benchmark).collect()) == [0, 4, 5, 6]
    # A benchmark beyond the bound is scanned in blocks, with the same result.
    monkeypatch.setattr("silverbrook.llm.decontamination.BLOCK_CHARS", 100)
    assert {(r.doc_id, r.item_id) for r in find_passages(docs, benchmark).collect()} == want
    assert sorted(r.doc_id for r in drop_contaminated(docs, benchmark).collect()) == [0, 4, 5, 6]


def test_passages_edge_cases(spark, benchmark, edge_docs, clashing_docs, no_docs):
    none = benchmark.filter("item_id < 0")
    assert find_passages(edge_docs, none).count() == find_passages(no_docs, benchmark).count() == 0
    assert drop_contaminated(edge_docs, none).count() == edge_docs.count()
    kept = drop_contaminated(clashing_docs, benchmark)
    assert kept.columns == clashing_docs.columns and kept.count() == clashing_docs.count()
    assert plain(" A,b\t\nC ") == "a b c"


def test_short_items_and_every_passage_of_an_item(spark, benchmark):
    filler = " ".join(f"filler{i}" for i in range(50))
    near = ITEM.replace("many", "mny")
    rows = [
        (0, f"{filler} Too, short! {filler} too short"),
        (1, f"{filler} too shorty, into short, too  long"),
        (2, f"{ITEM} {filler} {near} {ITEM}"),
        (3, filler),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.distance, r.passage_start, r.passage_end) for r in find_passages(docs, benchmark).collect())
    item, text = plain(ITEM), plain(filler)
    at = len(item) + 1 + len(text) + 1
    end = at + len(item) - 1
    places = [(0, 0, len(item)), (0, end + 1, end + 1 + len(item)), (1, at, end)]
    first = len(text) + 1
    again = first + 10 + len(text) + 1
    want = [(0, 4, 0, first, first + 9), (0, 4, 0, again, again + 9)]
    assert got == sorted(want + [(2, i, *p) for i in (1, 2) for p in places])
    assert sorted(r.doc_id for r in drop_contaminated(docs, benchmark).collect()) == [1, 3]
