"""Benchmark passages in documents, within an edit budget.

Texts are compared in a plain form: lower case, ASCII punctuation and white
space as single spaces. An item of n characters may differ from a passage by
``ERROR_RATE * n`` edits, k. Cut into k + 1 pieces, at least one piece must stand
in the passage unchanged (pigeonhole), so exact hits of all pieces, found in one
walk over the text by an Aho-Corasick automaton, lose no passage. The text
around a hit is verified with Myers' bit-parallel edit distance, one machine
operation per character for the whole item; neighbouring hits of an item share
one verification, which tells every passage that overlaps no closer one.

Documents are scanned where they are read; nothing is shuffled. The items are
sent to every task after their size was measured: up to ``BLOCK_CHARS`` at once,
a larger benchmark in blocks, one pass each, whose results are stored.

Defined cases: a null or empty document matches nothing; items whose plain form
has under ``MIN_CHARS`` characters match without edits and as whole words only;
an item without any character matches nothing; repeated
items are reported under each of their ids, repeated documents once per row;
empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import string
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverbrook.llm.common import Decide, give_back, keep_by_text, stored

#: Edits allowed per character of an item.
ERROR_RATE = 0.08
#: Plain characters below which an item with edits is too short to be told from chance.
MIN_CHARS = 32
#: Characters of items that are sent to the tasks at once.
BLOCK_CHARS = 4_000_000

_HITS = "doc_id long, item_id long, distance long, passage_start long, passage_end long"
_PLAIN = bytes.maketrans(
    (string.punctuation + string.whitespace).encode(), b" " * len(string.punctuation + string.whitespace)
)


def plain(text: str | None) -> str:
    """Lower case, with each run of ASCII punctuation and white space as one space."""
    data = (text or "").lower().encode("utf-8", "surrogatepass").translate(_PLAIN)
    return b" ".join(data.split()).decode("utf-8", "surrogatepass")


def budget(item: str, rate: float) -> int:
    return int(len(item) * rate)


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """The item cut into k + 1 pieces of nearly equal length, each with its place."""
    edges = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(edges, edges[1:], strict=False)]


class Pattern:
    """Myers' bit vectors of an item."""

    def __init__(self, item: str) -> None:
        self.length = len(item)
        self.masks: dict[str, int] = defaultdict(int)
        for i, c in enumerate(item):
            self.masks[c] |= 1 << i

    def scores(self, text: str) -> Iterator[int]:
        """At each character the smallest distance of the item to a substring that ends there."""
        ones, top = (1 << self.length) - 1, 1 << (self.length - 1)
        up, down, score = ones, 0, self.length
        masks = self.masks
        for c in text:
            eq = masks.get(c, 0)
            x = eq | down
            diagonal = ((((x & up) + up) & ones) ^ up) | x
            down_row = up & diagonal
            up_row = down | (ones & ~(up | diagonal))
            if up_row & top:
                score += 1
            elif down_row & top:
                score -= 1
            yield score
            # A passage may start anywhere: the row above the item is all zeros.
            up_row = (up_row << 1) & ones
            down_row = (down_row << 1) & ones
            up = down_row | (ones & ~(x | up_row))
            down = up_row & x

    def best_end(self, text: str) -> tuple[int, int]:
        """The smallest distance of the item to any substring, and the first place where one ends."""
        best, end = self.length, 0
        for at, score in enumerate(self.scores(text), 1):
            if score < best:
                best, end = score, at
        return best, end


class Matcher:
    """The items of a block, their pieces in one automaton.

    Items of fewer characters than ``least`` must stand unchanged, between word bounds.
    """

    def __init__(self, items: list[tuple[str, list[int]]], rate: float, least: int = 0) -> None:
        self.items = items
        self.least = least
        self.budgets = [budget(text, rate) if len(text) >= least else 0 for text, _ in items]
        self.patterns: dict[int, tuple[Pattern, Pattern]] = {}
        owners: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for number, (text, _) in enumerate(items):
            for at, piece in pieces(text, self.budgets[number]):
                owners[piece].append((number, at))
        self.automaton = ahocorasick.Automaton()
        for piece, places in owners.items():
            self.automaton.add_word(piece, (len(piece), places))
        if owners:
            self.automaton.make_automaton()

    def _pattern(self, number: int) -> tuple[Pattern, Pattern]:
        if number not in self.patterns:
            text = self.items[number][0]
            self.patterns[number] = Pattern(text), Pattern(text[::-1])
        return self.patterns[number]

    def find(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """Passages of items within their budgets, an item's closest last: its number, distance, start and end."""
        if not self.items or not text:
            return
        starts: dict[int, set[int]] = defaultdict(set)
        for end, (length, places) in self.automaton.iter(text):
            for number, at in places:
                starts[number].add(end + 1 - length - at)
        for number, begun in starts.items():
            length = len(self.items[number][0])
            if length < self.least:
                whole = (a for a in sorted(begun) if text[a - 1 : a] in ("", " ") and text[a + length :][:1] in ("", " "))
                found = [(0, a, a + length) for a in whole]
            else:
                found = sorted(set(self._verify(number, sorted(begun), text)), key=lambda x: (-x[0], x[1:]))
            for passage in found:
                yield number, *passage

    def _verify(self, number: int, begun: list[int], text: str) -> Iterator[tuple[int, int, int]]:
        k, item = self.budgets[number], self.items[number][0]
        forward, backward = self._pattern(number)
        at = 0
        while at < len(begun):
            low = high = begun[at]
            # Starts within 2k of each other share a window.
            while at < len(begun) and begun[at] <= high + 2 * k + 1:
                high = begun[at]
                at += 1
            first = max(0, low - k)
            window = text[first : high + len(item) + k]
            ends = sorted((score, end) for end, score in enumerate(forward.scores(window), 1) if score <= k)
            taken: list[tuple[int, int]] = []
            for distance, end in ends:
                # Any passage that ends here has len(item) - k characters at least.
                place = bisect_left(taken, (end,))
                before = taken[place - 1 : place]
                if before and before[0][1] > end - max(1, len(item) - k):
                    continue
                # The same walk backwards from that end finds where the passage starts.
                _, length = backward.best_end(window[max(0, end - len(item) - k) : end][::-1])
                if before and before[0][1] > end - length:
                    continue
                taken.insert(place, (end - length, end))
                yield distance, first + end - length, first + end


def _scanner(items: list[tuple[str, list[int]]], rate: float):
    held: list[Matcher] = []

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not held:
            held.append(Matcher(items, rate, MIN_CHARS))
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for number, distance, start, end in held[0].find(plain(text.as_py())):
                    rows.extend((doc, item_id, distance, start, end) for item_id in items[number][1])
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            yield pa.record_batch(
                [pa.array(c, pa.int64()) for c in columns],
                ["doc_id", "item_id", "distance", "passage_start", "passage_end"],
            )
        give_back()

    return scan


def _plain_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [plain(t.as_py()) for t in batch.column(1)]
        yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], ["item_id", "text"])


def _item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[str, list[int]]]]:
    """The items' plain texts and ids, in blocks of a bounded size."""
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    items = items.mapInArrow(_plain_items, "item_id long, text string").filter("text <> ''")
    items = stored(items.groupBy("text").agg(F.array_sort(F.collect_set("item_id")).alias("ids")), "items")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-2 * chars // BLOCK_CHARS) if chars > BLOCK_CHARS else 1
    for block in range(blocks):
        mine = items.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block)
        yield sorted((r["text"], list(r["ids"])) for r in mine.collect())


def find_passages(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """(doc_id, item_id, distance, passage_start, passage_end) of every passage within its item's budget.

    Places count characters of the document's plain form.
    """
    rows = docs.select("doc_id", F.col("text").cast("string"))
    every: DataFrame | None = None
    for items in _item_blocks(benchmark):
        if every is not None:
            every = stored(every, "passages")  # so that one block is held at a time
        hits = rows.mapInArrow(_scanner(items, rate), _HITS)
        every = hits if every is None else every.unionByName(hits)
    return every


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """The rows, with all their columns, that hold no passage within the budget of an item."""

    def cleaner(items: list[tuple[str, list[int]]]) -> Callable[[], Decide]:
        def prepare() -> Decide:
            matcher = Matcher(items, rate, MIN_CHARS)
            return lambda texts: [next(matcher.find(plain(t)), None) is None for t in texts]

        return prepare

    for number, items in enumerate(_item_blocks(benchmark)):
        docs = keep_by_text(stored(docs, "clean") if number else docs, cleaner(items))
    return docs
