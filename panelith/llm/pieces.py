"""SentencePiece encoding and decoding, batched in numpy.

A text is segmented into pieces with the best sum of log probabilities (Viterbi). A unigram model brings its
own; a merge (BPE) model only has the order of its pieces, from which log probabilities follow by Zipf's
law: the piece of rank r has probability proportional to 1 / r. Nothing is estimated from texts. Blanks are
written as U+2581 with one in front of the text. No piece has U+2581 behind another character, so a text
may be cut in front of every U+2581 that follows something else: the cuts are words, and their
segmentations are the text's.

The distinct words of a batch are grouped by length, and all words of a length advance together, one
character at a time: substring hashes probe the sorted keys of the pieces, and the running maximum over
piece lengths stores the backpointers. Characters in no piece are spelled in byte pieces, and so is a U+2581
of the text itself (only blanks are written as such), which makes decoding exact for every text.

Beside the lattice, ``merges`` makes a merge model's own segmentation: parts of words make their best merge
at the same time, until none has one; parts of more than ``LONG`` characters use a heap each.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cached_property
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

from panelith.llm.wordbatch import BASE, BASE_INVERSE, chunks, mix, powers

BLANK = "▁"
#: stands for a U+2581 of the text; no Unicode character, so no piece holds it
OWN_BLANK = 0x110000
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: below the worst piece, as unknown characters are scored
PENALTY = 10.0
#: bytes of one lattice, about; more words of a length advance in several lots
LIMIT = 60_000_000
#: bytes of text whose distinct words are encoded together
CHUNK = 500_000
#: parts of more characters merge by a heap, as their joint steps would cost the square of the length
LONG = 128
#: sentencepiece's number for merge models (trainer_spec.model_type)
BPE = 2
U = np.uint64


@dataclass(frozen=True)
class Merges:
    """What two neighbouring symbols make. Symbols are numbers: the normal pieces, then characters that are none."""

    chars: np.ndarray
    char_symbols: np.ndarray
    pairs: np.ndarray
    ranks: np.ndarray
    made: np.ndarray
    beside: np.ndarray
    ids: np.ndarray

    @classmethod
    def build(cls, normal: list[tuple[str, float, int]]) -> Merges:
        symbols = {p: k for k, (p, _, _) in enumerate(normal)}
        for c in sorted({c for p, _, _ in normal for c in p}):
            symbols.setdefault(c, len(symbols))
        rank = {s: r for r, s in enumerate(sorted({s for _, s, _ in normal}, reverse=True))}
        found, beside = [], set()
        for p, score, _ in normal:
            beside.update(ord(a) << 21 | ord(b) for a, b in zip(p, p[1:]))
            for i in range(1, len(p)):
                a, b = symbols.get(p[:i]), symbols.get(p[i:])
                if a is not None and b is not None:
                    found.append((a << 32 | b, rank[score], symbols[p]))
        table = np.array(sorted(found), np.int64).reshape(-1, 3)
        single = sorted((ord(c), k) for c, k in symbols.items() if len(c) == 1)
        ids = np.full(len(symbols), -1, np.int32)
        ids[: len(normal)] = [i for _, _, i in normal]
        chars = np.array(single, np.int64).reshape(-1, 2)
        return cls(chars[:, 0].copy(), chars[:, 1].copy(), *table.T.copy(), np.array(sorted(beside), np.int64), ids)

    @cached_property
    def by_pair(self) -> dict[int, tuple[int, int]]:
        return dict(zip(self.pairs.tolist(), zip(self.ranks.tolist(), self.made.tolist())))

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (``NEVER`` without a merge) and symbol that each pair makes."""
        if not len(self.pairs):
            return np.full(len(left), NEVER), np.zeros(len(left), np.int64)
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        hit = (self.pairs[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.ranks[at], NEVER), self.made[at]


NEVER = np.int64(2**30)


def zipf_scores(scores: list[float]) -> list[float]:
    """Log probabilities of pieces by the rank of their scores (the best first; equal ones in their order)."""
    order = sorted(range(len(scores)), key=lambda i: -scores[i])
    total = math.log(sum(1.0 / r for r in range(1, len(scores) + 1)))
    out = [0.0] * len(scores)
    for r, i in enumerate(order):
        # as a model file stores them
        out[i] = float(np.float32(-math.log(r + 1) - total))
    return out


@dataclass(frozen=True)
class PieceTable:
    """Pieces sorted by hash within each length, their scores and ids; small enough to ship with a task."""

    keys: dict[int, np.ndarray]
    scores: dict[int, np.ndarray]
    ids: dict[int, np.ndarray]
    byte_ids: np.ndarray
    unknown: float
    texts: list[bytes | int | None]
    #: of a merge model; a unigram model has none
    merges: Merges | None = None

    @classmethod
    def build(cls, pieces: list[tuple[str, float, str]], merge: bool = False) -> PieceTable:
        """From (piece, score, kind) in the order of ids; kind: normal, byte or control. ``merge``: a merge model,
        whose scores give no more than an order."""
        normal = [(p, s, i) for i, (p, s, kind) in enumerate(pieces) if kind == "normal"]
        merges = Merges.build(normal) if merge else None
        if merge:
            normal = [(p, z, i) for (p, _, i), z in zip(normal, zipf_scores([s for _, s, _ in normal]))]
        if any(BLANK in p.lstrip(BLANK) for p, _, _ in normal):
            raise ValueError("a piece crosses words")
        byte_ids = np.full(256, -1, np.int32)
        texts: list[bytes | int | None] = [None] * len(pieces)
        for i, (p, _, kind) in enumerate(pieces):
            if kind == "byte":
                byte_ids[int(p[3:-1], 16)] = i
                texts[i] = int(p[3:-1], 16)
            elif kind == "normal":
                texts[i] = p.replace(BLANK, " ").encode()
        if (byte_ids < 0).any():
            raise ValueError("byte pieces are needed for an exact round trip")
        keys, scores, ids = {}, {}, {}
        for n in sorted({len(p) for p, _, _ in normal}):
            mine = [x for x in normal if len(x[0]) == n]
            points = np.array([[ord(c) for c in p] for p, _, _ in mine], np.uint64)
            h = hash_columns(points)
            order = np.argsort(h)
            if (np.diff(h[order].view(np.int64)) == 0).any():
                raise ValueError("two pieces share a hash")
            keys[n], scores[n] = h[order], np.array([s for _, s, _ in mine])[order]
            ids[n] = np.array([i for _, _, i in mine], np.int32)[order]
        return cls(keys, scores, ids, byte_ids, min(s for _, s, _ in normal) - PENALTY, texts, merges)


def letter(points: np.ndarray) -> np.ndarray:
    return mix(points.astype(U), 5)


def hash_columns(points: np.ndarray) -> np.ndarray:
    """Polynomial hash of every row of a matrix of code points."""
    return (letter(points) * powers(BASE, points.shape[1])[::-1]).sum(axis=1, dtype=U)


def load_pieces(path: str = MODEL) -> PieceTable:
    """The piece table of a SentencePiece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)

    def kind(i: int) -> str:
        if model.is_byte(i):
            return "byte"
        return "control" if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) else "normal"

    pieces = [(model.id_to_piece(i), model.get_score(i), kind(i)) for i in range(model.get_piece_size())]
    merge = model_type(model.serialized_model_proto()) == BPE
    if merge and any(map(model.is_unused, range(len(pieces)))):
        raise ValueError("unused pieces are merged and taken apart again, which is not built")
    return PieceTable.build(pieces, merge)


def _fields(message: bytes):
    """(number, value) of the varint and length-delimited fields of a protocol buffer."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        number, wire = divmod(varint(), 8)
        if wire == 0:
            yield number, varint()
        else:
            size = varint() if wire == 2 else {1: 8, 5: 4}[wire]
            yield number, message[at : at + size]
            at += size


def model_type(model: bytes) -> int:
    """trainer_spec.model_type of a serialised model: 1 unigram (also if it is not set), 2 merges."""
    trainer = b"".join(v for n, v in _fields(model) if n == 2)
    return [1, *(v for n, v in _fields(trainer) if n == 3)][-1]


def _viterbi(table: PieceTable, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal-length words (rows of code points): per row its pieces, as (row, end, id) in text order.

    id -1 marks a character in no piece.
    """
    rows, length = words.shape
    prefix = np.zeros((length + 1, rows), U)
    letters = letter(words.T)
    for j in range(length):
        prefix[j + 1] = prefix[j] * BASE + letters[j]
    best = np.full((length + 1, rows), -np.inf)
    best[0] = 0
    back = np.ones((length + 1, rows), np.int32)
    piece = np.full((length + 1, rows), -1, np.int32)
    power = powers(BASE, max(table.keys) + 1)
    for j in range(1, length + 1):
        best[j] = best[j - 1] + table.unknown
        for n, keys in table.keys.items():
            if n > j:
                break
            probe = prefix[j] - prefix[j - n] * power[n]
            at = np.searchsorted(keys, probe)
            at[at == len(keys)] = 0
            hit = np.flatnonzero(keys[at] == probe)
            if not len(hit):
                continue
            at = at[hit]
            score = best[j - n, hit] + table.scores[n][at]
            # a piece beats the unknown character even at equal scores; longer pieces win ties
            better = score >= best[j, hit]
            hit, at = hit[better], at[better]
            best[j, hit] = score[better]
            back[j, hit] = n
            piece[j, hit] = table.ids[n][at]
    row_parts, end_parts = [], []
    alive, end = np.arange(rows), np.full(rows, length)
    while len(alive):
        row_parts.append(alive)
        end_parts.append(end)
        end = end - back[end, alive]
        alive, end = alive[end > 0], end[end > 0]
    row, end = np.concatenate(row_parts), np.concatenate(end_parts)
    order = np.lexsort((end, row))
    row, end = row[order], end[order]
    return row, end, piece[end, row]


def _merge_long(m: Merges, symbols: list[int]) -> list[tuple[int, int]]:
    """(start, symbol) of one part's pieces."""
    n = len(symbols)
    after, before, size = list(range(1, n + 1)), list(range(-1, n - 1)), [1] * n
    heap: list[tuple[int, int, int, int, int]] = []

    def offer(i: int, j: int) -> tuple[int, int, int, int, int] | None:
        if i < 0 or j >= n or symbols[i] < 0 or symbols[j] < 0:
            return None
        found = m.by_pair.get(symbols[i] << 32 | symbols[j])
        return found and (found[0], i, j, size[i] + size[j], found[1])

    heap = [x for i in range(n - 1) if (x := offer(i, i + 1))]
    heapify(heap)
    while heap:
        _, i, j, whole, made = heappop(heap)
        # stale if either side has been merged since
        if not size[i] or not size[j] or size[i] + size[j] != whole:
            continue
        symbols[i], size[i], size[j], k = made, whole, 0, after[j]
        after[i] = k
        if k < n:
            before[k] = i
        for x in (offer(before[i], i), offer(i, k)):
            if x:
                heappush(heap, x)
    return [(i, symbols[i]) for i in range(n) if size[i]]


def _merge(m: Merges, points: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words one behind the other, ``word`` numbering them: where each piece starts, in order, and its id.

    id -1 marks a character in no piece.
    """

    def found(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(sorted_keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
        return at, sorted_keys[at] == keys

    at, known = found(m.chars, points)
    symbol = np.full(len(points), -1, np.int64)
    symbol[known] = m.char_symbols[at[known]]
    joint = found(m.beside, points[:-1] << 21 | points[1:])[1] & (word[1:] == word[:-1])
    first = np.flatnonzero(np.concatenate([[True], ~joint]))
    size = np.diff(np.append(first, len(points)))
    stays = np.ones(len(points), bool)
    for s, n in zip(first[size > LONG].tolist(), size[size > LONG].tolist()):
        stays[s : s + n] = False
        for i, made in _merge_long(m, symbol[s : s + n].tolist()):
            stays[s + i], symbol[s + i] = True, made
    mine = np.repeat((size > 1) & (size <= LONG), size)
    pos, part = np.flatnonzero(mine), np.repeat(np.arange(len(size)), size)[mine]
    now = symbol[mine]
    rank, made = np.full(len(pos), NEVER), np.zeros(len(pos), np.int64)
    same = np.flatnonzero(part[1:] == part[:-1])
    rank[same], made[same] = m.look_up(now[same], now[same + 1])
    while len(pos):
        begin = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        best = np.minimum.reduceat(rank << 32 | np.arange(len(pos)), begin)
        more = best >> 32 < NEVER
        keep = np.repeat(more, np.diff(np.append(begin, len(pos))))
        symbol[pos[~keep]] = now[~keep]
        i = best[more] & 0xFFFFFFFF
        now[i] = made[i]
        stays[pos[i + 1]] = False
        keep[i + 1] = False
        i = (np.cumsum(keep) - 1)[i]
        pos, part, now, rank, made = pos[keep], part[keep], now[keep], rank[keep], made[keep]
        # the merged symbol has a new pair on each side
        rank[i] = NEVER
        left = np.concatenate([i, i[i > 0] - 1])
        left = left[left + 1 < len(pos)]
        left = left[part[left] == part[left + 1]]
        rank[left], made[left] = m.look_up(now[left], now[left + 1])
    start = np.flatnonzero(stays)
    return start, np.where(symbol[start] < 0, -1, m.ids[symbol[start]])


def _utf8(point: int) -> bytes:
    return (BLANK if point == OWN_BLANK else chr(point)).encode()


def _code_points(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts with the leading blank, as code points, and where each starts."""
    joined = " " + "\0 ".join(t.decode() for t in texts)
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.int64)
    sizes = np.array([len(t.decode()) for t in texts]) + 2
    starts = np.concatenate([[0], np.cumsum(sizes)])
    starts[-1] -= 1
    keep = np.ones(len(points), bool)
    keep[starts[1:-1] - 1] = False
    points = np.where(points == 0x2581, OWN_BLANK, np.where(points == 32, 0x2581, points))[keep]
    return points, starts - np.minimum(np.arange(len(starts)), len(texts) - 1)


def encode_batch(table: PieceTable, texts: list[bytes], merges: Merges | None = None) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts, and where each text's ids start: by the lattice, or by ``merges``."""
    if not texts:
        return np.zeros(0, np.int32), np.zeros(1, np.int64)
    points, bounds = _code_points(texts)
    blank = points == 0x2581
    cut = np.flatnonzero(blank & np.concatenate([[True], ~blank[:-1]]))
    cut = np.union1d(cut, bounds[:-1])
    size = np.diff(np.append(cut, len(points)))
    run = np.zeros(len(points) + 1, U)
    np.cumsum(letter(points) * powers(BASE, len(points)), out=run[1:])
    inverse = powers(BASE_INVERSE, len(points) + 1)
    key = mix((run[cut + size] - run[cut]) * inverse[cut] + size.astype(U))
    _, first, word = np.unique(key, return_index=True, return_inverse=True)
    lengths = size[first]
    # pieces of the distinct words, by the lattice one length at a time
    found: list[tuple[np.ndarray, np.ndarray]] = []
    if merges:
        owner = np.repeat(np.arange(len(first)), lengths)
        flat = points[np.repeat(cut[first] - (np.cumsum(lengths) - lengths), lengths) + np.arange(len(owner))]
        start, ids = _merge(merges, flat, owner)
        row = owner[start]
        if (ids < 0).any():
            row, ids = _spell(table, row, ids, flat[start])
        found.append((row, ids))
    by_size = np.argsort(lengths, kind="stable")
    edges = np.flatnonzero(np.diff(lengths[by_size])) + 1
    for group in [] if merges else np.split(by_size, edges):
        n = int(lengths[group[0]])
        step = max(1, LIMIT // (32 * (n + 1)) // 8)
        for at in range(0, len(group), step):
            part = group[at : at + step]
            row, end, ids = _viterbi(table, points[cut[first[part]][:, None] + np.arange(n)])
            if (ids < 0).any():
                row, ids = _spell(table, row, ids, points[cut[first[part]][row] + end - 1])
            found.append((part[row], ids))
    owner = np.concatenate([o for o, _ in found])
    ids = np.concatenate([i for _, i in found])
    order = np.argsort(owner, kind="stable")
    owner, ids = owner[order], ids[order]
    begin = np.searchsorted(owner, np.arange(len(first) + 1))
    counts = np.diff(begin)[word]
    ends = np.cumsum(counts)
    out = ids[np.repeat(begin[word] - (ends - counts), counts) + np.arange(ends[-1])]
    bounds, sizes = np.concatenate([[0], ends])[np.searchsorted(cut, bounds)], np.diff(bounds)
    # an empty text has no leading blank either
    empty = sizes == 1
    return np.delete(out, bounds[:-1][empty]), bounds - np.concatenate([[0], np.cumsum(empty)])


def _spell(table: PieceTable, row: np.ndarray, ids: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Replaces characters in no piece by their bytes."""
    strange = ids < 0
    spelled = {int(p): table.byte_ids[np.frombuffer(_utf8(int(p)), np.uint8)] for p in np.unique(last[strange])}
    times = np.ones(len(ids), np.int64)
    times[strange] = [len(spelled[int(p)]) for p in last[strange]]
    out = np.repeat(ids, times)
    out[np.repeat(strange, times)] = np.concatenate([spelled[int(p)] for p in last[strange]])
    return np.repeat(row, times), out


def decode_ids(table: PieceTable, ids: np.ndarray) -> bytes:
    """The UTF-8 text of a sequence of ids: the exact text that was encoded."""
    out = bytearray()
    for i in ids.tolist():
        text = table.texts[i]
        if isinstance(text, int):
            out.append(text)
        elif text:
            out += text
    return bytes(out[1:]) if out[:1] == b" " else bytes(out)


class FastDecoder:
    """Decodes many ids at once: piece texts are gathered from one buffer."""

    def __init__(self, table: PieceTable):
        parts = [bytes([t]) if isinstance(t, int) else t or b"" for t in table.texts]
        self.size = np.array([len(p) for p in parts])
        self.start = np.concatenate([[0], np.cumsum(self.size)[:-1]])
        self.buffer = np.frombuffer(b"".join(parts), np.uint8)

    def __call__(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """Texts of the id slices between consecutive bounds, without the leading blank."""
        size = self.size[ids]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        raw = self.buffer[np.repeat(self.start[ids] - (ends - size), size) + np.arange(total)].tobytes()
        at = np.concatenate([[0], ends])[bounds]
        return [raw[s + (raw[s : s + 1] == b" ") : e] for s, e in zip(at[:-1].tolist(), at[1:].tolist())]


TEXT, NULL = "__body", "__null"


def _encode(table: PieceTable, names: list[str], merges: bool):
    def run(batches):
        decode = FastDecoder(table)
        for rows in batches:
            texts = rows.column(TEXT).to_pylist()
            for a, b, part in chunks(texts, CHUNK):
                ids, bounds = encode_batch(table, part, table.merges if merges else None)
                back = decode(ids, bounds)
                none = pa.array(rows.column(NULL).slice(a, b - a))
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(n).slice(a, b - a) for n in names]
                    + [lists, pa.array(np.diff(bounds).astype(np.int32)), none_where(back, none), pa.array([x == y for x, y in zip(back, part)])],
                    names=[*names, "ids", "n_pieces", "decoded", "exact"],
                )

    return run


def none_where(texts: list[bytes], none: pa.Array) -> pa.Array:
    return pa.array([None if gone else t.decode() for t, gone in zip(texts, none.to_pylist())], pa.string())


def encode_texts(
    docs: DataFrame, columns: tuple[str, ...] = ("doc_id",), model: str | PieceTable = MODEL, merges: bool = False
) -> DataFrame:
    """``columns`` with ids array<int>, n_pieces, decoded (the text read back from ids) and exact. ``merges``:
    by a merge model's merges instead of the lattice.

    One row per input row, no shuffle. A null or empty text has no ids; ``decoded`` is null for
    a null text. Columns of the result's names must not be among ``columns``;
    other columns are ignored. An empty table gives no rows.
    """
    table = load_pieces(model) if isinstance(model, str) else model
    source = docs.select(
        *[f"`{c}`" for c in columns], F.coalesce("text", F.lit("")).cast("binary").alias(TEXT), F.col("text").isNull().alias(NULL)
    )
    fields = [docs.schema[c] for c in columns]
    schema = StructType([
        *fields, StructField("ids", ArrayType(IntegerType())), StructField("n_pieces", IntegerType()),
        StructField("decoded", StringType()), StructField("exact", BooleanType()),
    ])
    return source.mapInArrow(_encode(table, list(columns), merges), schema)


def decode_pieces(rows: DataFrame, ids: str = "ids", model: str | PieceTable = MODEL) -> DataFrame:
    """``rows`` with a column ``decoded``: the text of each array of ids (null for null)."""
    table = load_pieces(model) if isinstance(model, str) else model
    schema = StructType([*rows.schema.fields, StructField("decoded", StringType())])

    def run(batches):
        decode = FastDecoder(table)
        for batch in batches:
            lists = batch.column(ids).to_pylist()
            flat = np.array([i for x in lists for i in x or ()], np.int64)
            bounds = np.concatenate([[0], np.cumsum([len(x or ()) for x in lists])])
            texts = none_where(decode(flat, bounds), pa.array([x is None for x in lists]))
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, "decoded"])

    return rows.mapInArrow(run, schema)
