"""Token counts of byte-level merge (BPE) tokenizers, by rank-synchronous merging of ragged numpy arrays.

Texts are cut at the tokenizer's special strings (each is one token wherever it stands) and then into
pre-tokens, by runs of character classes over one array of code points. The distinct pre-tokens of a batch
lie one behind the other as symbols; in a round every sequence finds its lowest-ranked pair and joins all
occurrences of it at the same time, leftmost first where they overlap. That equals one merge after the
other, as no merge makes a symbol whose own merges have a lower rank (checked when the file is loaded).
What is left of a sequence when no pair has a rank is its count. Sequences of more than ``LONG`` symbols
go through the same ranks over linked positions, so that a round costs what it joins and not the length.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from panelith.llm.wordbatch import LETTERS, chunks, spans_hash

NEVER = np.int64(2**40)
LIMIT, LONG = 1024, 256
OTHER, LETTER, NUMBER, SPACE, UNKNOWN = 0, 1, 2, 3, 9
BLANK, QUOTE = 0x20, 0x27
#: endings split off behind an apostrophe (fixed values of the byte-level pattern)
ENDINGS = ("s", "t", "m", "d", "re", "ve", "ll")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass(frozen=True)
class MergeTable:
    """Merges as sorted pairs of symbols with their ranks and products; small enough to ship with a task."""

    byte_symbols: np.ndarray
    pairs: np.ndarray
    ranks: np.ndarray
    made: np.ndarray
    special: tuple[str, ...]

    @classmethod
    def build(cls, vocab: dict[str, int], merges: list[tuple[str, str]], special: tuple[str, ...] = ()) -> MergeTable:
        byte_symbols = np.zeros(256, np.int64)
        for letter, byte in byte_letters().items():
            byte_symbols[byte] = vocab[letter]
        rows, made_at = [], {}
        for rank, (a, b) in enumerate(merges):
            rows.append((vocab[a] << 32 | vocab[b], rank, vocab[a + b]))
            made_at[vocab[a + b]] = rank
        if any(max(made_at.get(k >> 32, -1), made_at.get(k & 0xFFFFFFFF, -1)) >= rank for k, rank, _ in rows):
            raise ValueError("a merge stands before the merge that makes one of its sides")
        table = np.array(sorted(rows), np.int64).reshape(-1, 3)
        return cls(byte_symbols, *table.T.copy(), tuple(sorted(special, key=len, reverse=True)))

    @classmethod
    def load(cls, path: str) -> MergeTable:
        """From a byte-level BPE file of the tokenizers library; other kinds are refused."""
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model, before = whole["model"], whole["pre_tokenizer"] or {}
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
        if model["type"] != "BPE" or odd or whole["normalizer"] or before.get("type") != "ByteLevel":
            raise ValueError(f"not a plain byte-level BPE tokenizer: {path}")
        if before.get("add_prefix_space") or not before.get("use_regex", True):
            raise ValueError("a blank in front or texts without pre-tokens are not built")
        added = whole["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("added tokens that look at their surroundings are not built")
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        return cls.build(model["vocab"], merges, tuple(t["content"] for t in added))

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (``NEVER`` without a merge) and product of each pair."""
        if not len(self.pairs):
            return np.full(len(left), NEVER), np.zeros(len(left), np.int64)
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        hit = self.pairs[at] == key
        return np.where(hit, self.ranks[at], NEVER), self.made[at]


class CharacterClasses:
    """Letter, number, space or other, asked of the library's own pre-tokenizer once per character and task:
    the classes depend on its Unicode version."""

    def __init__(self):
        from tokenizers import pre_tokenizers

        self.cut = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
        self.known = np.full(0x110000, UNKNOWN, np.int8)

    def __call__(self, points: np.ndarray) -> np.ndarray:
        found = self.known[points]
        if (found == UNKNOWN).any():
            for p in np.unique(points[found == UNKNOWN]).tolist():
                joins = [k for k, x in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")) if len(self.cut(x + chr(p))) == 1]
                self.known[p] = joins[0] if joins else SPACE
            found = self.known[points]
        return found


def pre_tokens(points: np.ndarray, head: np.ndarray, classes: CharacterClasses) -> np.ndarray:
    """Where each pre-token starts. ``head`` marks the first character of each piece of text."""
    if not len(points):
        return np.zeros(0, np.int64)
    kind = classes(points)
    first = head.copy()
    first[1:] |= kind[1:] != kind[:-1]
    start = np.flatnonzero(first)
    end = np.append(start[1:], len(points))
    run = kind[start]
    followed = np.append(~head[start[1:]], False)
    # the last blank before a run of another class belongs to that run; any other last space stands alone
    space = (run == SPACE) & followed
    joins = space & (points[end - 1] == BLANK)
    size = end - start
    begins = [start[~joins], end[joins] - 1, end[space & ~joins & (size > 1)] - 1, start[joins & (size > 1)]]
    attached = np.append(False, joins[:-1])
    # an apostrophe that starts a pre-token takes its ending along, and what is left of the letters starts anew
    quote = np.flatnonzero((run == OTHER) & (size == 1) & (points[start] == QUOTE) & ~attached & followed)
    quote = quote[run[quote + 1] == LETTER]
    a = points[start[quote + 1]]
    b = np.where(size[quote + 1] > 1, points[np.minimum(start[quote + 1] + 1, len(points) - 1)], 0)
    takes = np.zeros(len(quote), np.int64)
    for e in ENDINGS:
        takes[(a == ord(e[0])) & ((len(e) == 1) | (b == ord(e[-1])))] = len(e)
    gone = start[quote + 1][takes > 0]
    rest = quote[(takes > 0) & (size[quote + 1] > takes)] + 1
    begins.append(start[rest] + takes[(takes > 0) & (size[quote + 1] > takes)])
    mark = np.zeros(len(points) + 1, bool)
    # runs that a blank is attached to start at the blank
    mark[start[~attached & ~joins]] = True
    for x in begins[1:]:
        mark[x] = True
    mark[gone] = False
    return np.flatnonzero(mark[:-1])


def _alternate(hit: np.ndarray) -> np.ndarray:
    """Of each run of neighbouring positions every second one, from the first."""
    if len(hit) < 2 or not (np.diff(hit) == 1).any():
        return hit
    new = np.append(True, np.diff(hit) != 1)
    begin = np.flatnonzero(new)
    offset = np.arange(len(hit)) - np.repeat(begin, np.diff(np.append(begin, len(hit))))
    return hit[offset % 2 == 0]


def _merge_short(table: MergeTable, symbols: np.ndarray, owner: np.ndarray, counts: np.ndarray) -> None:
    """Rounds over all sequences; ``counts[owner]`` gets the symbols left."""
    rank, made = np.full(len(symbols), NEVER), np.zeros(len(symbols), np.int64)
    same = np.flatnonzero(owner[1:] == owner[:-1])
    rank[same], made[same] = table.look_up(symbols[same], symbols[same + 1])
    while len(owner):
        begin = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        size = np.diff(np.append(begin, len(owner)))
        best = np.minimum.reduceat(rank, begin)
        more = best < NEVER
        counts[owner[begin[~more]]] = size[~more]
        lowest = np.repeat(best, size)
        hit = _alternate(np.flatnonzero((rank == lowest) & (lowest < NEVER)))
        symbols[hit] = made[hit]
        keep = np.repeat(more, size)
        keep[hit + 1] = False
        hit = (np.cumsum(keep) - 1)[hit]
        symbols, owner, rank, made = symbols[keep], owner[keep], rank[keep], made[keep]
        # the products have new neighbours on both sides
        rank[hit] = NEVER
        left = np.union1d(hit, hit[hit > 0] - 1)
        left = left[left + 1 < len(owner)]
        left = left[owner[left] == owner[left + 1]]
        rank[left], made[left] = table.look_up(symbols[left], symbols[left + 1])


def _merge_long(table: MergeTable, symbols: np.ndarray) -> int:
    """The symbols left of one sequence: positions wait under the rank of their pair, ranks go in order."""
    n = len(symbols)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    alive = np.append(np.ones(n, bool), False)
    waiting: dict[int, list[np.ndarray]] = {}
    queue: list[int] = []

    def offer(at: np.ndarray) -> None:
        rank, _ = table.look_up(symbols[at], symbols[after[at]])
        at, rank = at[rank < NEVER], rank[rank < NEVER]
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        begin = np.flatnonzero(np.append(True, rank[1:] != rank[:-1])) if len(at) else []
        for r, part in zip(rank[begin].tolist(), np.split(at, begin[1:])):
            if r not in waiting:
                waiting[r] = []
                heappush(queue, r)
            waiting[r].append(part)

    offer(np.arange(n - 1))
    while queue:
        r = heappop(queue)
        at = np.unique(np.concatenate(waiting.pop(r)))
        at = at[alive[at]]
        at = at[after[at] < n]
        rank, made = table.look_up(symbols[at], symbols[after[at]])
        at, made = at[rank == r], made[rank == r]
        if not len(at):
            continue
        # where the product's two sides are equal, neighbours in the list overlap: every second one
        chain = np.append(False, after[at[:-1]] == at[1:])
        if chain.any():
            begin = np.flatnonzero(~chain)
            offset = np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at))))
            at, made = at[offset % 2 == 0], made[offset % 2 == 0]
        gone = after[at]
        symbols[at], alive[gone] = made, False
        after[at] = after[gone]
        inner = after[at] < n
        before[after[at][inner]] = at[inner]
        new = np.union1d(at, before[at][before[at] >= 0])
        offer(new[after[new] < n])
    return int(alive.sum())


def merged_sizes(table: MergeTable, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Tokens of each byte range of ``raw``."""
    size = end - start
    counts = np.minimum(size, 1)
    for i in np.flatnonzero(size > LONG).tolist():
        counts[i] = _merge_long(table, table.byte_symbols[raw[start[i] : end[i]]])
    short = np.flatnonzero((size > 1) & (size <= LONG))
    size = size[short]
    owner = np.repeat(short, size)
    at = np.repeat(start[short] - (np.cumsum(size) - size), size) + np.arange(len(owner))
    _merge_short(table, table.byte_symbols[raw[at]], owner, counts)
    return counts


class Counter:
    """Token counts of lists of texts; keeps what it has learned about characters."""

    def __init__(self, table: MergeTable):
        self.table, self.classes = table, CharacterClasses()
        self.special = re.compile("|".join(map(re.escape, table.special))) if table.special else None

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        parts, owner, specials = [], [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            pieces = [text.decode()]
            if self.special:
                pieces = self.special.split(pieces[0])
                specials[i] = len(pieces) - 1
            parts += pieces
            owner += [i] * len(pieces)
        joined = "".join(parts)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        if not len(points):
            return specials
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        at = np.cumsum(sizes) - sizes
        head = np.zeros(len(points), bool)
        head[at[sizes > 0]] = True
        first = pre_tokens(points, head, self.classes)
        width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        place = np.concatenate([[0], np.cumsum(width)])
        start, end = place[first], place[np.append(first[1:], len(points))]
        raw = np.frombuffer(joined.encode(), np.uint8)
        _, one, which = np.unique(spans_hash(LETTERS[raw], start, end), return_index=True, return_inverse=True)
        counts = merged_sizes(self.table, raw, start[one], end[one])[which]
        text_of = np.repeat(np.array(owner), sizes)[first]
        return specials + np.bincount(text_of, counts, len(texts)).astype(np.int64)


TEXT = "__body"


def count_tokens(
    docs: DataFrame, columns: tuple[str, ...] = ("doc_id",), tokenizer: str | MergeTable | None = None, limit: int = LIMIT
) -> DataFrame:
    """``columns`` with n_bytes (UTF-8), n_tokens and over_limit (more than ``limit`` tokens).

    Counts are those of the tokenizers library without begin, end or added tokens; special strings inside a
    text count as the one token they name. One row per input row, no shuffle. A null or empty text has no
    tokens. Repeated rows give repeated rows, null ids stay, an empty table gives no rows. Columns of the
    result's names must not be among ``columns``; other columns are ignored. Equal pre-tokens of a batch are
    known by 64-bit hashes.
    """
    table = tokenizer if isinstance(tokenizer, MergeTable) else MergeTable.load(tokenizer or default_path())
    source = docs.select(*[f"`{c}`" for c in columns], F.coalesce("text", F.lit("")).cast("binary").alias(TEXT))
    schema = StructType([
        *[docs.schema[c] for c in columns], StructField("n_bytes", LongType()), StructField("n_tokens", LongType()),
        StructField("over_limit", BooleanType()),
    ])

    def run(batches):
        count = Counter(table)
        for rows in batches:
            texts = rows.column(TEXT).to_pylist()
            for a, b, part in chunks(texts):
                n = count(part)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(c).slice(a, b - a) for c in columns]
                    + [pa.array([len(t) for t in part], pa.int64()), pa.array(n), pa.array(n > limit)],
                    names=schema.names,
                )

    return source.mapInArrow(run, schema)
