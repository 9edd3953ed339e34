import random

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F

from silverbrook.llm.common import table
from silverbrook.llm.components import components
from silverbrook.llm.near_dedup import drop_near_repeats, near_groups, shingle_sets, signature


def shingles_by_hand(text, n=5):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def groups_by_hand(rows, threshold=85):
    """Component of each row by comparing all pairs; missing ids come last."""
    sets = [shingles_by_hand(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= threshold * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        r = root(i)
        least[r] = min(least.get(r, float("inf")), float("inf") if doc is None else doc)
    return sorted(
        (repr(doc), len(s), repr(None if not s and doc is None or least[root(i)] == float("inf") else (least[root(i)] if s else doc)))
        for i, ((doc, _), s) in enumerate(zip(rows, sets, strict=True))
    )


def found(docs):
    return sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id)) for r in near_groups(docs).collect())


def test_edge_cases(edge_docs, clashing_docs, edge_rows, no_docs):
    want = groups_by_hand([(d, t) for d, t, *_ in edge_rows])
    assert found(edge_docs) == want
    assert near_groups(no_docs).count() == 0
    kept = drop_near_repeats(clashing_docs)
    assert kept.columns == clashing_docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert {0, 1, 2, 3, 6, 7, 9, 11, 12, 2**60} <= ids and not {5, 8, 10} & ids


def test_chains_and_crowded_buckets_lose_no_link(spark, monkeypatch):
    """Texts that drift word by word: neighbours are linked, distant ones are not."""
    random.seed(7)
    words = [f"w{i}" for i in range(400)]
    rows, doc = [], 0
    for _ in range(4):
        base = [random.choice(words) for _ in range(80)]
        for _ in range(60):
            rows.append((doc, " ".join(base)))
            doc += 1
            if random.random() < 0.7:
                base[random.randrange(80)] = random.choice(words)
    # Copies that differ at random from one text, some over and some under the threshold.
    base = [random.choice(words) for _ in range(60)]
    for _ in range(150):
        own = list(base)
        for _ in range(random.randint(0, 4)):
            own[random.randrange(60)] = random.choice(words)
        rows.append((doc, " ".join(own)))
        doc += 1
    random.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(docs) == groups_by_hand(rows)
    # Buckets dealt in many small blocks give the same.
    monkeypatch.setattr("silverbrook.llm.near_dedup.BLOCK_BYTES", 3000)
    assert found(docs) == groups_by_hand(rows)


def test_signature_estimates_similarity():
    rng = np.random.default_rng(0)
    for share in (0.3, 0.6, 0.9):
        both = rng.integers(0, 2**64, 1000, dtype=np.uint64)
        cut = int(1000 * share)
        a = np.unique(both)
        b = np.unique(np.concatenate([both[:cut], rng.integers(0, 2**64, 1000 - cut, dtype=np.uint64)]))
        same = (signature(a, 192) == signature(b, 192)).mean()
        assert abs(same - len(np.intersect1d(a, b)) / len(np.union1d(a, b))) < 0.15
    few = np.array([5, 2**63], np.uint64)
    assert set(signature(few, 64).tolist()) == set(few.tolist())


def test_short_sequences_differ_from_their_parts():
    a, b, c = shingle_sets(iter(["a b", "a b c", "a b"]))
    assert a.tolist() == c.tolist() != b.tolist()


def test_components(spark):
    random.seed(1)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.label for r in components(frame).collect()}
    assert got == {x: root(x) for x in nodes}
    assert components(frame.filter(F.lit(False))).count() == 0


def _similar(a, b):
    a, b = shingles_by_hand(a), shingles_by_hand(b)
    return 100 * len(a & b) / len(a | b)


def test_the_stage_on_the_given_documents_against_all_pairs(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    ids, sets = zip(*((r.doc_id, shingles_by_hand(r.text)) for r in docs.collect()), strict=True)
    least = dict(zip(ids, ids, strict=True))
    pairs = [
        (ids[i], ids[j])
        for i, a in enumerate(sets)
        for j, b in enumerate(sets[:i])
        if a and b and 100 * len(a & b) >= 80 * len(a | b)
    ]
    for _ in ids:
        for a, b in pairs:
            least[a] = least[b] = min(least[a], least[b])
    out = corpus_pipeline.near(spark, docs, "").select("doc_id").collect()
    assert {r.doc_id for r in out} == {d for d in ids if least[d] == d} < set(ids)


def test_the_stage_takes_pairs_from_80_percent_on(spark):
    random.seed(11)
    words = iter(f"u{i}" for i in range(10**6))
    rows, want = [], set()
    # Sets of 4 n and 5 n shingles, one within the other: 0.80; with one shingle more, under it.
    for n in (1, 2, 5, 17, 60):
        for more in (0, 1):
            long = [next(words) for _ in range(5 * n + 4 + more)]
            pair = [" ".join(long), " ".join(long[: 4 * n + 4])]
            assert (_similar(*pair) == 80) == (not more) and _similar(*pair) <= 80
            want |= {len(rows), len(rows) + 1} if more else {len(rows)}
            rows += [(len(rows) + i, text) for i, text in enumerate(pair)]
    docs = spark.createDataFrame(random.sample(rows, len(rows)), "doc_id long, text string").repartition(3)
    assert {r.doc_id for r in drop_near_repeats(docs).collect()} == want
    # The query of the operator keeps its own threshold.
    assert near_groups(docs).filter("kept").count() == len(rows)
