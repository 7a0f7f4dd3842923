"""Periodic runs of words: suffix trees, constant-time common extensions, Lyndon roots.

A run is a stretch of consecutive words with smallest period q that no neighbouring word extends. Every
run starts a longest Lyndon word (its root) at some position, under the order of the letters or under the
reverse order, so there are at most two candidates (position, root length) per word. A candidate is
extended to both sides by the longest common extension of two positions, which is the depth of their
lowest common ancestor in a suffix tree: that of the words to the right, that of the reversed words to the
left. Trees are built by Ukkonen's algorithm; the ancestor is a range minimum over the Euler tour, answered
in constant time by blocks and a sparse table. The suffix order that gives the Lyndon words comes from the
same tree, its children visited in one order and in the reverse.

Runs that count repeat a third of their length at least, so each stretch of words as long as a third of the
shortest run occurs in them again one period away. Where a stretch occurs once only no run passes: a text
is cut there before trees are built, which changes no run.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from panelith.llm.wordbatch import BASE, WordBatch, chunks, mix, powers

MIN_LENGTH, MIN_EXPONENT = 24, 3
#: times that a text is cut further; more would change no run, only the size of what is searched
LOOKS = 4
#: words of a block of the Euler tour
STEP = 16
#: the tour's end and beyond
DEEP = np.int32(2**31 - 1)
U = np.uint64


class SuffixTree:
    """Ukkonen's tree over symbols 1..k; symbol 0 ends the text and is smaller than all."""

    def __init__(self, symbols: list[int]):
        text = [*symbols, 0]
        n, k = len(text), max(text) + 1
        start, stop, link, edges = [0], [0], [0], {}
        node = at = length = rest = 0
        for i, c in enumerate(text):
            rest += 1
            last = 0
            while rest:
                if not length:
                    at = i
                key = node * k + text[at]
                child = edges.get(key)
                if child is None:
                    edges[key] = len(start)
                    start.append(i)
                    stop.append(n)
                    link.append(0)
                    if last:
                        link[last] = node
                        last = 0
                else:
                    s = start[child]
                    size = stop[child] - s
                    if length >= size:
                        node, at, length = child, at + size, length - size
                        continue
                    if text[s + length] == c:
                        if last:
                            link[last] = node
                        length += 1
                        break
                    split = len(start)
                    start += [s, i]
                    stop += [s + length, n]
                    link += [0, 0]
                    edges[key] = split
                    edges[split * k + c] = split + 1
                    start[child] = s + length
                    edges[split * k + text[s + length]] = child
                    if last:
                        link[last] = split
                    last = split
                rest -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    at = i - rest + 1
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        order = np.argsort(keys)
        self.size, self.nodes = n, len(start)
        self.children = np.fromiter(edges.values(), np.int64, len(edges))[order]
        parents = keys[order] // k
        self.begin = np.searchsorted(parents, np.arange(self.nodes + 1))
        self.ends = keys[order] % k == 0
        self.width = np.array(stop) - np.array(start)
        self._tour()

    def _tour(self) -> None:
        """Text depths in the order of an Euler tour, where each suffix stands in it, and the suffixes in order."""
        children, begin, width = self.children.tolist(), self.begin.tolist(), self.width.tolist()
        after = begin[:]
        depth = [0] * self.nodes
        tour, place, suffixes, path = [], [0] * self.size, [], []
        node = 0
        while True:
            d = depth[node]
            tour.append(d)
            k = after[node]
            if k < begin[node + 1]:
                after[node] = k + 1
                child = children[k]
                depth[child] = d + width[child]
                if begin[child] == begin[child + 1]:
                    suffix = self.size - depth[child]
                    place[suffix] = len(tour)
                    suffixes.append(suffix)
                    tour.append(depth[child])
                else:
                    path.append(node)
                    node = child
            elif path:
                node = path.pop()
            else:
                break
        self.depth, self.place, self.suffixes = depth, np.array(place), suffixes
        padded = np.full(-(-len(tour) // STEP) * STEP, DEEP, np.int32)
        padded[: len(tour)] = tour
        blocks = padded.reshape(-1, STEP)
        self.tour = padded
        self.from_left = np.minimum.accumulate(blocks, axis=1).ravel()
        self.from_right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        self.sparse = [blocks.min(axis=1)]
        while 2 ** len(self.sparse) <= len(blocks):
            row, half = self.sparse[-1], 2 ** (len(self.sparse) - 1)
            self.sparse.append(np.minimum(row[:-half], row[half:]))

    def reversed_order(self) -> list[int]:
        """The suffixes in the order that reverses the symbols; a beginning still precedes what continues it."""
        children, begin, ends = self.children.tolist(), self.begin.tolist(), self.ends.tolist()
        order, path = [], [0]
        while path:
            node = path.pop()
            a, b = begin[node], begin[node + 1]
            if a == b:
                order.append(self.size - self.depth[node])
                continue
            # taken from the end of the list: the leaf of the end of the text, then the largest symbol
            if ends[a]:
                path += [*children[a + 1 : b], children[a]]
            else:
                path += children[a:b]
        return order

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How far the suffixes at i and j (different) agree."""
        a, b = self.place[i], self.place[j]
        a, b = np.minimum(a, b), np.maximum(a, b)
        first, last = a // STEP, b // STEP
        out = np.minimum(self.from_right[a], self.from_left[b])
        near = np.flatnonzero(first == last)
        if len(near):
            at = a[near][:, None] + np.arange(STEP)
            inside = at <= b[near][:, None]
            out[near] = np.where(inside, self.tour[np.minimum(at, len(self.tour) - 1)], DEEP).min(axis=1)
        gap = last - first - 1
        level = np.zeros(len(gap), np.int64)
        wide = gap > 0
        level[wide] = np.frexp(gap[wide])[1] - 1
        for k in np.unique(level[wide]).tolist():
            mine = np.flatnonzero(wide & (level == k))
            row = self.sparse[k]
            out[mine] = np.minimum(out[mine], np.minimum(row[first[mine] + 1], row[last[mine] - 2**k]))
        return out


def lyndon_lengths(suffixes: list[int]) -> np.ndarray:
    """Length of the longest Lyndon word at each position, from the suffixes in order (the empty one first):
    up to the next smaller suffix."""
    n = len(suffixes) - 1
    rank = [0] * (n + 1)
    for r, s in enumerate(suffixes):
        rank[s] = r
    out, open_at = [0] * n, []
    for i, r in enumerate(rank):
        while open_at and rank[open_at[-1]] > r:
            j = open_at.pop()
            out[j] = i - j
        open_at.append(i)
    return np.array(out, np.int64)


def runs_of(symbols: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> np.ndarray:
    """(start, length, period) of all runs of at least ``min_length`` symbols and ``min_exponent`` >= 2 periods,
    by start, then period. Symbols are numbers from 1."""
    n = len(symbols)
    none = np.zeros((0, 3), np.int64)
    if n < max(min_length, min_exponent):
        return none
    right = SuffixTree(symbols.tolist())
    found = []
    for order in (right.suffixes, right.reversed_order()):
        period = lyndon_lengths(order)
        start = np.arange(n)
        # the first root of a run of two periods or more is followed by its own beginning
        fits = start + period < n
        start, period = start[fits], period[fits]
        same = (symbols[start] == symbols[start + period]) & (period * min_exponent <= n)
        found.append(np.stack([start[same], period[same]], axis=1))
    start, period = np.unique(np.concatenate(found), axis=0).T
    if not len(start):
        return none
    ahead = right.common(start, start + period)
    del right
    left = SuffixTree(symbols[::-1].tolist())
    behind = np.zeros(len(start), np.int64)
    inner = start > 0
    behind[inner] = left.common(n - start[inner], n - start[inner] - period[inner])
    runs = np.stack([start - behind, behind + period + ahead, period], axis=1)
    runs = runs[(runs[:, 1] >= min_length) & (runs[:, 1] >= min_exponent * period)]
    runs = np.unique(runs, axis=0)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def stretches(words: np.ndarray, text: np.ndarray, min_length: int) -> list[tuple[int, int]]:
    """Ranges of words outside which no run of three periods and ``min_length`` words passes.

    Such a run of period q has every window of min_length // 3 words again, q words away and within the
    run; hashes that meet by chance only keep more.
    """
    width = max(1, min_length // 3)
    n = len(words) - width + 1
    if n < 1:
        return []
    window = np.zeros(n, U)
    for j in range(width):
        window += words[j : j + n] * powers(BASE, width)[j]
    window = mix(window)
    at = np.flatnonzero(text[:n] == text[width - 1 :])
    group = text[at].astype(np.int64)
    longest = np.full(len(at), len(words))
    for look in range(LOOKS):
        if not len(at):
            break
        order = np.lexsort((at, window[at], group))
        here, key, mine = at[order], window[at[order]], group[order]
        step = np.diff(here)
        step[(key[1:] != key[:-1]) | (mine[1:] != mine[:-1])] = len(words) + 1
        gap = np.minimum(np.append(step, len(words) + 1), np.append(len(words) + 1, step))
        again = np.zeros(len(at), bool)
        again[order] = gap * 3 <= longest[order]
        at, group = at[again], group[again]
        # consecutive windows of a text are one stretch; the next look asks within it
        new = np.append(True, (np.diff(at) != 1) | (np.diff(group) != 0))[: len(at)]
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(at))) + width - 1
        long = np.repeat(size >= min_length, size - width + 1)
        group, longest = np.repeat(np.arange(len(begin)), size - width + 1), np.repeat(size, size - width + 1)
        if look == LOOKS - 1 or (again.all() and long.all()):
            return [(int(at[b]), int(at[b] + s)) for b, s in zip(begin, size) if s >= min_length]
        at, group, longest = at[long], group[long], longest[long]
    return []


def repeated_tail(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """(a, p) if the words from a on are to become the p words at a, again and again: a tenth of the ids."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    a = h // 10 % n
    return a, 1 + (n - a) // (3 + h // 10 % 8)


def _find(texts: list[bytes], ids: list, edit: Callable | None, min_length: int, min_exponent: int):
    """Per text: words, runs, and the words that stay, joined by blanks."""
    batch = WordBatch(texts)
    source = np.arange(len(batch.starts))
    edited = np.zeros(len(texts), bool)
    if edit:
        for d, doc_id in enumerate(ids):
            first, n = int(batch.first[d]), int(batch.last[d] - batch.first[d])
            change = edit(doc_id, n)
            if change:
                a, p = change
                source[first + a : first + n] = first + a + np.arange(n - a) % p
                edited[d] = True
    words = batch.hashes()[source]
    runs: list[list[np.ndarray]] = [[] for _ in texts]
    for s, e in stretches(words, batch.doc, min_length):
        _, symbols = np.unique(words[s:e], return_inverse=True)
        found = runs_of(symbols + 1, min_length, min_exponent)
        if len(found):
            d = int(batch.doc[s])
            found[:, 0] += s - batch.first[d]
            runs[d].append(found)
    for d in range(len(texts)):
        n = int(batch.last[d] - batch.first[d])
        mine = np.concatenate(runs[d]) if runs[d] else np.zeros((0, 3), np.int64)
        mine = mine[np.lexsort((mine[:, 2], mine[:, 0]))]
        if not len(mine) and not edited[d]:
            yield n, mine, batch.words(d)
            continue
        gone = np.zeros(n + 1, np.int64)
        np.add.at(gone, mine[:, 0] + mine[:, 2], 1)
        np.add.at(gone, mine[:, 0] + mine[:, 1], -1)
        stays = source[batch.first[d] : batch.last[d]][np.cumsum(gone[:n]) == 0]
        raw = batch.bytes
        yield n, mine, b" ".join([raw[s:e].tobytes() for s, e in zip(batch.starts[stays], batch.ends[stays])])


TEXT = "__body"
RUN = StructType([StructField(n, LongType()) for n in ("start", "length", "period")])


def periodic_runs(
    docs: DataFrame, edit: Callable[[int | None, int], tuple[int, int] | None] | None = None,
    min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT,
) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period, by start, then period) and collapsed.

    Words are maximal stretches of ``[^\\x20\\x09-\\x0D]``, numbered from 0; ``collapsed`` is the text without
    the words that stand in any run after its first period, one blank between words. ``edit``, given doc_id
    and the number of words, may repeat words before runs are sought. One row per input row, no shuffle. A null
    or empty text has no words, no runs and an empty ``collapsed``. Null ids and repeated rows stay, an
    empty table gives no rows; other columns are ignored. Words are known by 64-bit hashes within a batch.
    """
    if min_exponent < 3:
        raise ValueError("texts are cut by a rule that needs three periods")
    source = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias(TEXT))
    schema = StructType([
        docs.schema["doc_id"], StructField("n_words", LongType()), StructField("runs", ArrayType(RUN)),
        StructField("collapsed", StringType()),
    ])

    def run(batches):
        kind = pa.list_(pa.struct([(n, pa.int64()) for n in RUN.names]))
        for rows in batches:
            texts, ids = rows.column(TEXT).to_pylist(), rows.column("doc_id").to_pylist()
            for a, b, part in chunks(texts):
                found = list(_find(part, ids[a:b], edit, min_length, min_exponent))
                flat = np.concatenate([r for _, r, _ in found])
                bounds = np.concatenate([[0], np.cumsum([len(r) for _, r, _ in found])]).astype(np.int32)
                items = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(kind.value_type))
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id").slice(a, b - a), pa.array([n for n, _, _ in found], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(bounds), items), pa.array([t.decode() for _, _, t in found], pa.string()),
                    ],
                    names=schema.names,
                )

    return source.mapInArrow(run, schema)


def longest_run(runs: Column) -> Column:
    """Of runs by start and period, the first with the greatest length / period, compared as whole numbers."""
    return F.aggregate(
        F.slice(runs, 2, F.greatest(F.size(runs) - 1, F.lit(0))), F.try_element_at(runs, F.lit(1)),
        lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best),
    )


def run_digest(found: DataFrame) -> DataFrame:
    """Counts, the run of the greatest exponent (nulls without a run), and digests of runs and collapsed text."""
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = longest_run(F.col("runs"))
    return found.withColumn("__best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("__best.start").alias("start"),
        F.col("__best.length").alias("length"), F.col("__best.period").alias("period"),
        F.expr("1000 * __best.length div __best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
