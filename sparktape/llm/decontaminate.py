"""Operator 1: benchmark decontamination with a generalised suffix automaton.

The automaton of all test items is small and goes to every task; documents stream through
it without a shuffle. Where the longest match reaches the window, its words are hit. Test
items beyond the size of one automaton are dealt into several, one after the other.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import computed_once, lean, materialise, text_bytes

WINDOW = 13
MAX_COVERAGE = 0.05
# Words of test items in one automaton (about 100 MB in a task), and automata in one pass.
BLOCK_WORDS = 100_000
BLOCKS_AT_ONCE = 2

# Words of lower-cased UTF-8: digits, a to z and every byte of a character beyond ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: bytes | None) -> list[bytes]:
    return WORD.findall(text.lower()) if text else []


class SuffixAutomaton:
    """All runs of words of all items, and which items a run of `window` words belongs to.

    An item of fewer words is one window of its own length.
    """

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [
            (name, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words])
            for name, words in items
            if words
        ]
        for _, codes in coded:
            last = 0
            for code in codes:
                last = self._extend(last, code)
        self.shortest = min((min(len(codes), window) for _, codes in coded), default=window)
        self.windows: dict[int, set[str]] = {}
        self.whole: dict[int, list[tuple[int, str | None]]] = {}
        for name, codes in coded:
            state = 0
            for i, code in enumerate(codes):
                state = self.next[state][code]
                if i + 1 >= window:
                    names = self.windows.setdefault(self._holding(state, window), set())
                    names.update([name] if name is not None else [])
            if len(codes) < window:
                self.whole.setdefault(self._holding(state, len(codes)), []).append((len(codes), name))

    def _add(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, state: int, code: int, target: int) -> int:
        """The target of `state` by `code`, cut down to the runs that go on from `state`."""
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._add(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while state != -1 and self.next[state].get(code) == target:
            self.next[state][code] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, code: int) -> int:
        if code in self.next[last]:
            return self._split(last, code, self.next[last][code])
        new = self._add(self.length[last] + 1, 0, {})
        state = last
        while state != -1 and code not in self.next[state]:
            self.next[state][code] = new
            state = self.link[state]
        if state != -1:
            self.link[new] = self._split(state, code, self.next[state][code])
        return new

    def _holding(self, state: int, length: int) -> int:
        """The state on the way of suffix links that holds the suffix of `length` words."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def matches(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit spans of words (end exclusive, disjoint, in order), and the items hit."""
        known = bytes(map(self.vocabulary.__contains__, words))
        spans: list[tuple[int, int]] = []
        names: set[str] = set()
        start = known.find(b"\x01" * self.shortest)
        while start >= 0:
            end = known.find(b"\x00", start)
            end = len(known) if end < 0 else end
            self._match_run(words, start, end, spans, names)
            start = known.find(b"\x01" * self.shortest, end)
        return spans, names

    def _match_run(self, words, start, end, spans, names) -> None:
        state = matched = 0
        for i in range(start, end):
            code = self.vocabulary[words[i]]
            while state and code not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if code not in self.next[state]:
                continue
            state = self.next[state][code]
            matched += 1
            reach = 0
            if matched >= self.window:
                reach = self.window
                names |= self.windows[self._holding(state, self.window)]
            if self.whole:
                suffix = state
                while suffix > 0:
                    for n, name in self.whole.get(suffix, ()):
                        if n <= matched:
                            reach = max(reach, n)
                            names.update([name] if name is not None else [])
                    suffix = self.link[suffix]
            if reach:
                low = i + 1 - reach
                while spans and spans[-1][1] >= low:
                    low = min(low, spans.pop()[0])
                spans.append((low, i + 1))


_FOUND = "struct<n_words:long,spans:array<struct<low:long,high:long>>,items:array<string>>"
_FOUND_TYPE = pa.struct(
    [
        ("n_words", pa.int64()),
        ("spans", pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))),
        ("items", pa.list_(pa.string())),
    ]
)


def _match_udf(items, window: int) -> Callable[[Column], Column]:
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        automaton = SuffixAutomaton([(n, words_of(t)) for n, t in items.value], window)
        for texts in batches:
            out = []
            for value in texts:
                words = words_of(value.as_py())
                spans, names = automaton.matches(words)
                out.append(
                    {
                        "n_words": len(words),
                        "spans": [{"low": a, "high": b} for a, b in spans],
                        "items": sorted(names),
                    }
                )
            yield pa.array(out, _FOUND_TYPE)

    return F.arrow_udf(lean(run), _FOUND)


def _piece_udf(window: int) -> Callable[[Column], Column]:
    """Items as pieces of at most a tenth of a block, overlapping so that no window is cut."""
    size = max(BLOCK_WORDS // 10, window)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out = []
            for text in texts.to_pylist():
                words = words_of(text)
                starts = range(0, max(1, len(words) - window + 1), size - window + 1)
                out.append([b" ".join(words[i : i + size]) for i in starts] if words else [])
            yield pa.array(out, pa.list_(pa.binary()))

    return F.arrow_udf(lean(run), "array<binary>")


def _item_blocks(benchmark: DataFrame, window: int) -> list[list[tuple[str | None, bytes]]]:
    """The items' pieces, dealt into blocks of a bounded number of words."""
    pieces = benchmark.select(
        F.col("item_id").cast("string").alias("name"),
        F.explode(_piece_udf(window)(text_bytes())).alias("words"),
    )
    pieces = materialise(pieces, "benchmark-pieces")
    size = F.length("words") - F.length(F.regexp_replace(F.col("words").cast("string"), " ", "")) + 1
    total = pieces.agg(F.sum(size)).first()[0] or 0
    n_blocks = max(1, -(-total // BLOCK_WORDS))
    block = F.pmod(F.xxhash64("name", "words"), F.lit(n_blocks))
    return [
        [(r.name, bytes(r.words)) for r in pieces.where(block == k).collect()] for k in range(n_blocks)
    ]


def match_benchmark(
    docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, found: str = "found"
) -> DataFrame:
    """The documents with a column `found`: number of words, hit spans of words, items hit.

    A window is `window` neighbouring words of an item, or the whole item where it has
    fewer. A null text has no words; an item without words has no window; an item with a
    null id hits words but is not named. Equal ids of items count once.
    """
    spark, parts = docs.sparkSession, []
    blocks = _item_blocks(benchmark, window)
    rows = docs
    for at in range(0, len(blocks), BLOCKS_AT_ONCE):
        if at:
            rows = materialise(rows, "decontaminate")
        now = []
        for k, items in enumerate(blocks[at : at + BLOCKS_AT_ONCE], at):
            match = _match_udf(spark.sparkContext.broadcast(items), window)
            now.append((f"{found}_{k}", match(text_bytes())))
        rows = rows.withColumns(dict(now))
        parts += [name for name, _ in now]
    if len(parts) == 1:
        return rows.withColumnRenamed(parts[0], found)
    merged = F.struct(
        F.col(f"{parts[0]}.n_words").alias("n_words"),
        F.flatten(F.array(*[F.col(f"{p}.spans") for p in parts])).alias("spans"),
        F.array_distinct(F.flatten(F.array(*[F.col(f"{p}.items") for p in parts]))).alias("items"),
    )
    return rows.withColumn(found, merged).drop(*parts)


def hit_words(spans: Column) -> Column:
    """Number of words inside the spans, each counted once."""
    places = F.transform(spans, lambda s: F.sequence(s["low"], s["high"] - 1))
    return F.size(F.array_distinct(F.flatten(places))).cast("long")


def contamination(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """One row per document: `doc_id, n_words, n_hit, items`; items sorted as strings."""
    rows = match_benchmark(docs.select("doc_id", "text"), benchmark, window=window)
    return rows.select(
        "doc_id",
        "found.n_words",
        hit_words(F.col("found.spans")).alias("n_hit"),
        F.array_sort("found.items").alias("items"),
    )


def _cut_udf() -> Callable[[Column, Column], Column]:
    """Texts without the spans of words; a null span list leaves the text out."""

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, spans in batches:
            out = []
            for text, cuts in zip(texts.to_pylist(), spans.to_pylist(), strict=True):
                if not text or not cuts:
                    out.append(None)
                    continue
                places = [m.span() for m in WORD.finditer(text.lower())]
                kept, at = [], 0
                for cut in sorted(cuts, key=lambda c: c["low"]):
                    low, high = places[cut["low"]][0], places[cut["high"] - 1][1]
                    kept.append(text[at : max(at, low)])
                    at = max(at, high)
                out.append(b"".join([*kept, text[at:]]).decode("utf-8", "replace"))
            yield pa.array(out, pa.string())

    return F.arrow_udf(lean(run), "string")


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    window: int = WINDOW,
    max_coverage: float = MAX_COVERAGE,
) -> DataFrame:
    """The documents, with all their columns, without test passages.

    A document of which `max_coverage` of the words or more are hit goes; from the others
    the hit spans are cut out of the text. Texts without a hit stay as they are.
    """
    found = "found"
    while any(c.startswith(found) for c in docs.columns):
        found = f"_{found}"
    rows = match_benchmark(docs, benchmark, window=window, found=found)
    rows = computed_once(rows, found)
    spans = F.col(f"{found}.spans")
    n_hit, n_words = hit_words(spans), F.col(f"{found}.n_words")
    share = round(max_coverage * 1_000_000)
    rows = rows.where((n_hit == 0) | (n_hit * 1_000_000 < n_words * share))
    # Matching and cutting in turn: a task then holds one Python worker, not two at once.
    rows = materialise(rows, "decontaminate")
    hit = F.size(spans) > 0
    cut = _cut_udf()(F.when(hit, text_bytes()), F.when(hit, spans))
    return rows.withColumn("text", F.coalesce(cut, F.col("text"))).select(*docs.columns)
