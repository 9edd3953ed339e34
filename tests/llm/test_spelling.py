import random
import re
import zlib
from collections import Counter, defaultdict

from silverbrook.llm.common import table
from silverbrook.llm.queries import QUERIES
from silverbrook.llm.spelling import LONG, near_words, roots, spelling_forms

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def counts_by_hand(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def pairs_by_hand(words):
    """All pairs one edit apart: words that agree without one place, and words that are another without one."""
    words = set(words)
    near = defaultdict(set)
    without = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            short = w[:i] + w[i + 1 :]
            without[short, i].add(w)
            if short in words:
                near[w].add(short)
                near[short].add(w)
    for group in without.values():
        for w in group:
            near[w] |= group - {w}
    return near


def forms_by_hand(rows):
    counts = counts_by_hand(rows)
    near = pairs_by_hand(counts)
    form = {}
    for w, n in counts.items():
        if near[w]:
            best = min(near[w], key=lambda o: (-counts[o], o))
            if counts[best] >= 10 * n:
                form[w] = best
    found = []
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        found.append((w, form.get(w), root, n, len(near[w]), counts[form[w]] if w in form else None))
    return sorted(found)


def got(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


def test_query_against_all_words(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    want = forms_by_hand(rows)
    assert got(QUERIES["op13_spelling_variants"](spark, sf_dir)) == want
    assert sum(f is not None for _, f, *_ in want) > 100


def test_edge_cases(spark, edge_docs, clashing_docs, edge_rows, no_docs):
    want = forms_by_hand([(d, t) for d, t, *_ in edge_rows])
    assert want and max(len(w) for w, *_ in want) > 40_000
    assert got(spelling_forms(edge_docs)) == want
    assert got(spelling_forms(clashing_docs)) == want
    assert got(spelling_forms(no_docs)) == []


def found_pairs(spark, words):
    df = spark.createDataFrame([(w,) for w in words], "word string")
    pairs = [tuple(r) for r in near_words(df).collect()]
    assert len(pairs) == len(set(pairs))
    return set(pairs)


def by_hand(words):
    return {(w, o) for w, others in pairs_by_hand(words).items() for o in others}


def test_neighbours_of_crowded_words(spark):
    # Few letters, so that runs of equal letters, shared prefixes and hits are common.
    rng = random.Random(13)
    words = {"".join(rng.choices("abÿ", k=rng.randint(7, 10))) for _ in range(1500)}
    assert found_pairs(spark, words) == by_hand(words)
    words = {"a" * n for n in range(7, 12)} | {"a" * n + "b" for n in range(6, 11)}
    assert found_pairs(spark, words) == by_hand(words)


def test_neighbours_of_long_words(spark):
    rng = random.Random(14)
    words = set()
    for length in (LONG - 2, LONG - 1, LONG, LONG + 1, LONG + 200):
        base = "".join(rng.choices("xyé", k=length))
        words |= {base, "x" * length, "x" * (length - 1) + "y"}
        for _ in range(12):
            i, c = rng.randrange(length), rng.choice("xyé")
            words |= {base[:i] + base[i + 1 :], base[:i] + c + base[i:], base[:i] + c + base[i + 1 :]}
    words = {w for w in words if len(w) >= 7}
    assert found_pairs(spark, words) == by_hand(words)


def test_roots_follow_forms_to_the_last(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(9)] + [("v", "w3"), ("u", "t")]
    links = spark.createDataFrame(chain, "word string, form string")
    assert dict(map(tuple, roots(links).collect())) == {w: "t" if w == "u" else "w9" for w, _ in chain}


def test_a_frequent_word_in_every_document(spark):
    rng = random.Random(15)
    rows = [(i, "Wonderful " * 40 + rng.choice(["wonderfull", "wonderfu", "vonderful", "plainer"])) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found = got(spelling_forms(docs))
    assert found == forms_by_hand(rows)
    assert {w: r for w, _, r, *_ in found}["vonderful"] == "wonderful"
