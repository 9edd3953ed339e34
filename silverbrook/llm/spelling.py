"""Spelling variants of words, by walking a trie of all words as a relational frontier.

Words are counted first, then each is compared with all words one edit away.
All words lie in a trie whose edges are rows of a distributed table (node, next
code point); a node is named by the code points that lead to it. The frontier
holds states (word, position, node, edits): the word's code points before
``position`` led to ``node`` with that many edits. Level by level it is joined
with the edges of its nodes: the next code point may match, be replaced or be
passed over (a deletion), the latter two only as the first edit. A state that
comes to the end of a word with one edit has found a neighbour.

What keeps the frontier small, without losing a pair:

- A pair is found from its longer word or, of two equally long ones, from the
  smaller one, so insertions need no states.
- An edit lies in the second half of a word or of the reversed word. Every word
  is in the trie forwards and backwards, and edits are tried from the middle on
  only: the crowded nodes near the root are never branched at.
- A subtree with a single word is not walked: its edge holds the word's 64-bit
  hash, and the state's word as it would then be is compared with it at once. A
  word alone below a node has nothing to find there.
- An edge tells the code points that may follow, so a state with an edit that
  cannot go on is not stored.

A node has at most one edge for each of the 90 letters and the end, hence a word
few states at a level, whose number is bounded by its length and the letters. A
node that many words pass through sits in a plain inner join, which adaptive
execution splits. Each level is stored, so a lost executor repeats tasks of one level.

Words of over ``LONG`` code points, which would need as many levels, are paired
by hashes of the word without one code point, a row for each place, and then
compared; at one place of a word at most as many words differ as there are letters.

Defined cases: a null or empty text has no words; a missing doc_id stands as
empty text in the ``<doc_id>:<run>`` that is hashed; repeated rows count as
often as they stand there; no words give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverbrook.llm.common import stored, text_or_empty

# The code points of words, the share of damaged runs (one in so
# many), and the words and forms that count.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DAMAGED = 31
LEAST_LENGTH = 7
LEAST_COUNT = 2
#: A form is so many times as frequent as the word.
RATIO = 10
#: Code points of a word that the trie holds.
LONG = 64

#: Stand before a word, before a reversed word and after either; no letters, and END is before all of them.
FORWARD, BACKWARD, END = ">", "<", " "
#: Base of the hash of long words.
BASE = 6364136223846793005


def words_of(docs: DataFrame, least: int = LEAST_LENGTH) -> DataFrame:
    """One row per word that stands in a text: runs of letters, those of some (document, run) without a code point."""
    # Greedy, so a match is a whole run.
    runs = F.regexp_extract_all(
        text_or_empty(F.col("text").cast("string")), F.lit(f"[A-Za-z\u00C0-\u00FF]{{{least},}}"), F.lit(0)
    )
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    found = docs.select(doc.alias("doc"), F.explode(runs).alias("run"))
    found = found.withColumn("run", F.translate("run", UPPER, LOWER))
    found = found.withColumn("h", F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    rest = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % DAMAGED == 0, rest).otherwise(F.col("run"))
    return found.select(word.alias("word")).filter(F.length("word") >= least)


def word_counts(docs: DataFrame, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words with at least ``least_count`` occurrences."""
    counts = words_of(docs).groupBy("word").agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") >= least_count)


def _at(word: str, position: str | Column) -> Column:
    """The code point at a position (from 0) of a marked word; nothing behind its end."""
    place = F.col(position) if isinstance(position, str) else position
    return F.substring(word, place + 1, F.lit(1))


def _bit(letter: Column) -> Column:
    """A letter as one of 64 bits, which some letters share; no bit for no letter."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.ascii(letter) % 64)
    return F.when(letter != "", bit).otherwise(F.lit(0).cast("long"))


def _both_ways(words: DataFrame) -> DataFrame:
    """Each word forwards and backwards, with its marks, and the place from which on edits are tried."""
    half = F.length("word") / 2
    forward = words.select(
        F.concat(F.lit(FORWARD), "word", F.lit(END)).alias("word"), (1 + F.floor(half)).cast("int").alias("start")
    )
    backward = words.select(
        F.concat(F.lit(BACKWARD), F.reverse("word"), F.lit(END)).alias("word"),
        (1 + F.ceil(half)).cast("int").alias("start"),
    )
    return forward.unionByName(backward)


def _edges(frontier: DataFrame, depth: int) -> DataFrame:
    """(node, letter, leaf, follow) of the level's edges.

    ``leaf`` is the hash of the word of an edge with a single one below;
    ``follow`` has the bits of the letters that follow the edge. Both are
    numbers, so the aggregation needs no sort.
    """
    steps = frontier.filter("edits = 0").select(
        "node",
        _at("word", F.lit(depth)).alias("letter"),
        F.xxhash64("word").alias("hash"),
        _bit(_at("word", F.lit(depth + 1))).alias("bit"),
    )
    found = steps.groupBy("node", "letter").agg(
        F.count("*").alias("words"), F.bit_xor("hash").alias("hash"), F.bit_or("bit").alias("follow")
    )
    return found.select("node", "letter", F.when(F.col("words") == 1, F.col("hash")).alias("leaf"), "follow")


def _step(frontier: DataFrame, depth: int) -> DataFrame:
    """The states one level below ``depth``, and those that came to another word, the only one there (``other``)."""
    position, letter, own, then = (F.col(c) for c in ("position", "letter", "own", "then"))
    states = frontier.withColumns({"own": _at("word", position), "then": _at("word", position + 1)})
    may_edit = (F.col("edits") == 0) & (F.col("start") <= depth)
    matches = letter == own
    # Of equal code points in a row only the last is passed over: the others give the same word.
    passes = may_edit & (letter == then) & (then != own)
    replaces = may_edit & (letter > own) & (own != END)

    def moved(to: Column, edits: Column) -> Column:
        return F.struct(to.alias("position"), edits.alias("edits"))

    moves = F.array_compact(
        F.array(
            F.when(matches, moved(position + 1, F.col("edits"))),
            F.when(passes, moved(position + 2, F.lit(1))),
            F.when(replaces, moved(position + 1, F.lit(1))),
        )
    )
    joined = states.join(_edges(frontier, depth), "node").filter(matches | passes | replaces)
    found = joined.select(
        "word", "start", F.concat("node", "letter").alias("node"), "leaf", "follow", F.inline(moves)
    )
    follows = F.col("follow").bitwiseAND(_bit(_at("word", "position"))) != 0
    goes_on = F.col("leaf").isNull() & ((F.col("edits") == 0) | follows)
    rest = F.substring("word", F.col("position") + 1, F.length("word"))
    ends = (F.col("edits") == 1) & (F.xxhash64(F.concat("node", rest)) == F.col("leaf"))
    other = F.when(F.col("leaf").isNotNull(), F.concat("node", rest))
    return found.filter(goes_on | ends).select("word", "start", "position", "node", "edits", other.alias("other"))


def trie_pairs(words: DataFrame) -> DataFrame:
    """Pairs (word, other) of words of at most ``LONG`` code points, one edit apart, some of them twice."""
    both = _both_ways(words.select("word").filter(F.length("word") <= LONG))
    first = both.agg(F.min("start")).first()[0]
    pairs = both.select("word", F.col("word").alias("other")).filter("false")
    if first is not None:
        frontier = both.select(
            "word",
            "start",
            F.lit(first).alias("position"),
            F.substring("word", 1, first).alias("node"),
            F.lit(0).alias("edits"),
        )
        for depth in range(first, LONG + 2):
            moved = stored(_step(frontier, depth), "frontier")
            pairs = pairs.unionByName(moved.filter("other IS NOT NULL").select("word", "other"))
            frontier = moved.filter("other IS NULL").drop("other")
            if frontier.isEmpty():
                break

    def plain(marked: str) -> Column:
        bare = F.substring(marked, F.lit(2), F.length(marked) - 2)
        return F.when(F.startswith(F.col(marked), F.lit(FORWARD)), bare).otherwise(F.reverse(bare))

    return pairs.select(plain("word").alias("word"), plain("other").alias("other"))


def _without_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of each word (place -1) and of the word without each code point; ``passed`` of a run's last one only."""
    back = np.uint64(pow(BASE, -1, 2**64))
    names = ["id", "length", "place", "hash", "passed"]
    for batch in batches:
        for i, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            codes = np.frombuffer(word.encode("utf-32-le"), "<u4").astype(np.uint64)
            powers = np.cumprod(np.concatenate([[1], np.full(len(codes) - 1, BASE)]).astype(np.uint64))
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * powers)])
            without = sums[:-1] + (sums[-1] - sums[1:]) * back
            hashes = np.concatenate([sums[-1:], without]).view(np.int64)
            passed = np.concatenate([[False], codes[:-1] != codes[1:], [True]])
            places = np.arange(-1, len(codes))
            for at in range(0, len(places), 100_000):
                part = slice(at, at + 100_000)
                count = len(places[part])
                columns = [np.full(count, i), np.full(count, len(codes)), places[part], hashes[part], passed[part]]
                yield pa.record_batch(list(map(pa.array, columns)), names)


def long_pairs(words: DataFrame) -> DataFrame:
    """Pairs (word, other) one edit apart whose longer word has over ``LONG`` code points, some shorter ones too."""
    long_words = stored(
        words.filter(F.length("word") >= LONG).select(F.xxhash64("word").alias("id"), "word"), "long-words"
    )
    hashes = long_words.mapInArrow(_without_one, "id long, length long, place long, hash long, passed boolean")
    hashes = stored(hashes, "long-hashes")
    a, b = hashes.alias("a"), hashes.alias("b")
    same = (F.col("a.hash") == F.col("b.hash")) & (F.col("a.id") != F.col("b.id"))
    replaced = a.join(
        b,
        same
        & (F.col("a.place") == F.col("b.place"))
        & (F.col("a.length") == F.col("b.length"))
        & (F.col("a.place") >= 0)
        & (F.col("a.id") < F.col("b.id")),
    )
    passed = a.filter("passed").join(
        b.filter("place = -1"), same & (F.col("a.length") == F.col("b.length") + 1)
    )
    ids = [F.col("a.id").alias("id"), F.col("b.id").alias("other_id")]
    pairs = replaced.select(*ids).unionByName(passed.select(*ids)).distinct()
    others = long_words.select(F.col("id").alias("other_id"), F.col("word").alias("other"))
    found = pairs.join(long_words, "id").join(others, "other_id").select("word", "other")
    return found.filter(F.levenshtein("word", "other", 1) == 1)


def near_words(words: DataFrame) -> DataFrame:
    """(word, other) of all words that differ by one inserted, deleted or replaced code point, each pair both ways."""
    pairs = trie_pairs(words).unionByName(long_pairs(words))
    swapped = pairs.select(F.col("other").alias("word"), F.col("word").alias("other"))
    return pairs.unionByName(swapped).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last form on the way from each word with a (word, form).

    Every form is at least ``RATIO`` times as frequent as its word, so a way has
    a step for each digit of the largest count at most; rounds double their reach.
    """
    links = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("last"))
        joined = stored(links.join(further, "root", "left").select("word", "root", "last"), "roots")
        if joined.filter("last IS NOT NULL").isEmpty():
            return links
        links = joined.select("word", F.coalesce("last", "root").alias("root"))


def spelling_forms(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the texts."""
    words = stored(word_counts(docs), "words")
    others = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    # The most frequent other word first, then the first in code-point order.
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")
    near = near_words(words).join(others, "other").groupBy("word").agg(F.count("*").alias("n_near"), best)
    best_n = -F.col("best.less")
    found = words.join(near, "word", "left").select(
        "word",
        F.when(best_n >= RATIO * F.col("n"), F.col("best.other")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(best_n >= RATIO * F.col("n"), best_n).alias("form_n"),
    )
    found = stored(found, "forms")
    last = roots(found.filter("form IS NOT NULL"))
    return found.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
