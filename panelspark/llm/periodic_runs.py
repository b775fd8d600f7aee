"""Runs of repeated words in a text: maximal stretches with a smallest period, found by longest common extensions.

The words of a text (cut at ASCII white space) are its letters. Ukkonen's algorithm builds the suffix tree of the words
and that of their reversal; an Euler tour with range minima in blocks gives the string depth of the lowest common
ancestor of two leaves, so the length to which two places agree, forwards or backwards, in constant time. By each of the
two orders of the letters the longest Lyndon word at a place ends before the next smaller suffix; it is the
root of a run if it can be extended in both directions to twice its length. Every run has such a root, so the candidates,
two for each place, give all runs and their smallest periods.

Before that, a text is cut where no long run can pass. In a run of ``repeats`` periods or more, two neighbouring words
occur together at least ``repeats - 1`` times, so the parts between rarer pairs of neighbours hold all runs.
This is exact, and leaves trees to be built for repetitive parts only. Memory follows the longest such part: about
500 bytes a word.

A null, empty or blank text has no words and no runs, and its collapsed text is empty. Each row stands for itself,
whether its id is null or repeated. Only ``id_col`` and ``text_col`` are read, whatever other columns there are; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.store import text_or_empty

MIN_WORDS, REPEATS = 6, 4
BLOCK = 32
BYTES_AT_ONCE = 4 << 20
RUNS_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


class SuffixTree:
    """Ukkonen's tree over the numbers of ``letters`` (1 or more) and an end mark 0."""

    def __init__(self, letters: list[int]):
        self.text = text = [*letters, 0]
        self.sigma = sigma = max(text) + 1
        n = len(text)
        begin, end, link, edges = [0], [0], [0], {}  # node 0 is the root; an edge belongs to the node below it
        node, edge, depth, left = 0, 0, 0, 0  # the active point, and the suffixes still to be added
        for i, letter in enumerate(text):
            left += 1
            last = 0  # the inner node that waits for its suffix link
            while left:
                if not depth:
                    edge = i
                at = node * sigma + text[edge]
                child = edges.get(at)
                if child is None:
                    begin.append(i), end.append(n), link.append(0)
                    edges[at] = len(begin) - 1
                    if last:
                        link[last] = node
                        last = 0
                else:
                    length = (end[child] if end[child] <= i else i + 1) - begin[child]
                    if depth >= length:
                        node, edge, depth = child, edge + length, depth - length
                        continue
                    if text[begin[child] + depth] == letter:
                        depth += 1
                        if last:
                            link[last] = node
                        break
                    middle = len(begin)
                    begin.append(begin[child]), end.append(begin[child] + depth), link.append(0)
                    edges[at] = middle
                    begin.append(i), end.append(n), link.append(0)
                    edges[middle * sigma + letter] = middle + 1
                    begin[child] += depth
                    edges[middle * sigma + text[begin[child]]] = child
                    if last:
                        link[last] = middle
                    last = middle
                left -= 1
                if node:
                    node = link[node]
                elif depth:
                    depth, edge = depth - 1, i - left + 1
        self.n, self.lengths = n, (np.array(end) - np.array(begin)).tolist()
        keys, below = np.fromiter(edges, np.int64, len(edges)), np.fromiter(edges.values(), np.int64, len(edges))
        self.above, self.letter, self.below = keys // sigma, keys % sigma, below

    def tour(self, reverse: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """An Euler tour with children by letter (from the largest if ``reverse``; the end mark always first): string
        depths along it, the first place of each suffix, and the order of the suffixes."""
        order = np.where(reverse & (self.letter > 0), self.sigma - self.letter, self.letter)
        at = np.lexsort((order, self.above))
        children = self.below[at].tolist()
        nodes = len(self.lengths)
        first = np.searchsorted(self.above[at], np.arange(nodes + 1)).tolist()
        n, lengths = self.n, self.lengths
        depths, place, ranked = [0], [0] * n, []
        path, depth, following = [0], [0], first[:nodes]
        while path:
            node = path[-1]
            k = following[node]
            if k < first[node + 1]:
                following[node] = k + 1
                child = children[k]
                d = depth[-1] + lengths[child]
                depths.append(d)
                if first[child] == first[child + 1]:  # a leaf: the suffix of that length
                    place[n - d] = len(depths) - 1
                    ranked.append(n - d)
                    depths.append(depth[-1])
                else:
                    path.append(child), depth.append(d)
            else:
                path.pop(), depth.pop()
                if path:
                    depths.append(depth[-1])
        return np.array(depths), np.array(place), np.array(ranked)


class Extensions:
    """How far the suffixes at two places agree: a range minimum over the Euler tour, in blocks."""

    def __init__(self, depths: np.ndarray, place: np.ndarray):
        padded = np.append(depths, np.full(-len(depths) % BLOCK, depths.max()))
        blocks = padded.reshape(-1, BLOCK)
        self.blocks, self.place = blocks, place
        self.ahead = np.minimum.accumulate(blocks, 1)
        self.behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1]
        self.powers = [blocks.min(1)]
        while 2 << (len(self.powers) - 1) <= len(blocks):
            low, half = self.powers[-1], 1 << (len(self.powers) - 1)
            self.powers.append(np.minimum(low[:-half], low[half:]))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        a, b = self.place[a], self.place[b]
        a, b = np.minimum(a, b), np.maximum(a, b)
        first, last = a // BLOCK, b // BLOCK
        out = np.minimum(self.behind[first, a % BLOCK], self.ahead[last, b % BLOCK])
        wide = np.flatnonzero(last - first > 1)
        span = last[wide] - first[wide] - 1
        power = np.frexp(span)[1] - 1
        for p in np.unique(power).tolist():
            some = wide[power == p]
            low = self.powers[p]
            out[some] = np.minimum(out[some], np.minimum(low[first[some] + 1], low[last[some] - (1 << p)]))
        same = np.flatnonzero(first == last)
        columns = np.arange(BLOCK)
        inside = (columns >= (a[same] % BLOCK)[:, None]) & (columns <= (b[same] % BLOCK)[:, None])
        out[same] = np.where(inside, self.blocks[first[same]], np.iinfo(np.int64).max).min(1)
        return out


def lyndon_lengths(ranked: np.ndarray) -> np.ndarray:
    """For each place the length of its longest Lyndon word: up to the next suffix that is smaller."""
    n = len(ranked)
    rank = np.empty(n, np.int64)
    rank[ranked] = np.arange(n)
    rank, out, waiting = rank.tolist(), [0] * n, []
    for i, r in enumerate(rank):
        while waiting and rank[waiting[-1]] > r:
            j = waiting.pop()
            out[j] = i - j
        waiting.append(i)
    return np.array(out[:-1])  # the last suffix is the end mark alone, which is smaller than all


def all_runs(letters: list[int]) -> np.ndarray:
    """``start, length, period`` of all runs of two periods or more, each once, by start and period."""
    n = len(letters)
    tree = SuffixTree(letters)
    depths, place, ranked = tree.tour()
    ahead = Extensions(depths, place)
    lengths = [lyndon_lengths(ranked), lyndon_lengths(tree.tour(reverse=True)[2])]
    behind = Extensions(*SuffixTree(letters[::-1]).tour()[:2])
    at, period = np.tile(np.arange(n), 2), np.concatenate(lengths)
    inside = at + period < n
    at, period = at[inside], period[inside]
    after = ahead(at, at + period)
    before = np.zeros(len(at), np.int64)
    inner = np.flatnonzero(at > 0)
    before[inner] = behind(n - at[inner], n - at[inner] - period[inner])  # the suffixes of the reversal before both places
    found = after + before >= period
    rows = np.stack([at[found] - before[found], (after + before + period)[found], period[found]], 1)
    return np.unique(rows, axis=0)[:, [0, 1, 2]] if len(rows) else rows.reshape(0, 3)


def repetitive_parts(letters: np.ndarray, least: int, repeats: int) -> list[tuple[int, int]]:
    """Begin and end of the parts in which runs can lie."""
    if len(letters) < least:
        return []
    pairs = letters[:-1].astype(np.int64) * (int(letters.max()) + 1) + letters[1:]
    _, number, times = np.unique(pairs, return_inverse=True, return_counts=True)
    open_ = np.concatenate([[False], times[number] >= repeats - 1, [False]])
    change = np.flatnonzero(open_[1:] != open_[:-1])
    return [(b, e + 1) for b, e in zip(change[::2].tolist(), change[1::2].tolist()) if e + 1 - b >= least]


def runs_of(letters: np.ndarray, least: int = MIN_WORDS, repeats: int = REPEATS) -> np.ndarray:
    """``start, length, period`` of the runs with ``least`` words and ``repeats`` periods or more, by start and period."""
    out = [np.zeros((0, 3), np.int64)]
    for begin, end in repetitive_parts(letters, least, repeats):
        _, part = np.unique(letters[begin:end], return_inverse=True)
        rows = all_runs((part + 1).tolist())
        rows = rows[rows[:, 1] >= np.maximum(least, repeats * rows[:, 2])]
        out.append(rows + [begin, 0, 0])
    rows = np.concatenate(out)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which words stay: those that no run holds after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) == 0


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_WORDS,
                  repeats: int = REPEATS) -> DataFrame:
    """``doc_id, n_words, runs, collapsed``: the runs (``start, length, period``, counted in words from 0) by start and
    period, and the words that stay, joined by one space. ``repeats`` is 2 or more."""
    if repeats < 2:
        raise ValueError("a run has two periods or more")

    names, kinds = ("doc_id", "n_words", "runs", "collapsed"), (pa.int64(), pa.int64(), RUNS_TYPE, pa.string())

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, held = [], 0
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].cast(pa.binary())):
                words = text.as_py().split()
                number: dict[bytes, int] = {}
                letters = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
                runs = runs_of(letters, least, repeats)
                if len(runs):
                    words = [words[k] for k in np.flatnonzero(kept_words(len(words), runs)).tolist()]
                rows = [dict(zip(("start", "length", "period"), r)) for r in runs.tolist()]
                out.append((doc_id, len(letters), rows, b" ".join(words).decode()))
                held += len(out[-1][3])
                if held >= BYTES_AT_ONCE:
                    yield table(out)
                    out, held = [], 0
            if out:
                yield table(out)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(
        run, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
