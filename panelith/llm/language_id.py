"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the bytes of one word at a time (ASCII letters lower-cased, a blank on either side),
forwards and backwards, and labels every byte position from both states. It is trained in numpy by
backpropagation through time. A document's probabilities are pooled from its letter positions, over its
whole text. As the states start anew with each word, equal words have equal labels: a task runs the
network once per distinct word of a batch, and no text is cut or sampled. Words of any lengths advance
together, the longest first, so that those still being read are a prefix. A word is read whole: states are
carried over segments of ``SEGMENT`` bytes, those of the reverse direction from its state at each segment's
end, kept by a first pass. Memory is bounded by ``LOT`` words of a segment, whatever the length of a word.

Training takes a bounded hash sample of labelled documents (``PER_LANG`` per language, about) and at most
``TOKENS`` of their words to the driver, longer words in spans of ``SPAN`` bytes at most that end between
characters; the weights (some thousand numbers) travel with the tasks. Texts are never shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, DoubleType, LongType, StringType, StructField, StructType,
)

from panelith.llm.wordbatch import LETTERS, WordBatch, chunks, spans_hash

PER_LANG, TOKENS, HIDDEN, STEPS, BATCH, RATE = 400, 30_000, 16, 900, 256, 0.01
#: bytes of a training example; prediction reads words whole
SPAN = 32
#: words that advance together, few enough for their states to stay in a cache
LOT = 1024
#: bytes between kept states of the reverse direction
SEGMENT = 256
UNKNOWN = "und"
KNOWN_LETTERS = np.zeros(256, bool)
KNOWN_LETTERS[[*range(97, 123), *range(128, 256)]] = True


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


@dataclass
class Direction:
    """One gated recurrent layer: input rows per byte (update, reset, candidate) and recurrent weights."""

    rows: np.ndarray
    gates: np.ndarray
    candidate: np.ndarray
    tape: list = field(default_factory=list, repr=False)

    @classmethod
    def fresh(cls, rng: np.random.Generator, hidden: int) -> Direction:
        scale = 1 / np.sqrt(hidden)
        draw = lambda *shape: rng.uniform(-scale, scale, shape).astype(np.float32)
        return cls(draw(256, 3 * hidden), draw(hidden, 2 * hidden), draw(hidden, hidden))

    def forward(self, x: np.ndarray, keep: bool = False) -> np.ndarray:
        """States (time, batch, hidden) for bytes (time, batch)."""
        size = self.candidate.shape[0]
        h = np.zeros((x.shape[1], size), np.float32)
        out = np.empty((*x.shape, size), np.float32)
        self.tape = []
        for t in range(len(x)):
            given = self.rows[x[t]]
            gate = _sigmoid(given[:, : 2 * size] + h @ self.gates)
            update, reset = gate[:, :size], gate[:, size:]
            carried = h @ self.candidate
            new = np.tanh(given[:, 2 * size :] + reset * carried)
            if keep:
                self.tape.append((h, update, reset, carried, new))
            h = new + update * (h - new)
            out[t] = h
        return out

    def carry(self, x: np.ndarray, alive: np.ndarray, h: np.ndarray, times: range) -> np.ndarray:
        """States (time, words, hidden) for bytes (time, words), read in the order of ``times``; at time t the
        first ``alive[t]`` words are read. ``h`` holds the states before and, changed in place, after."""
        size = self.candidate.shape[0]
        out = np.zeros((*x.shape, size), np.float32)
        for t in times:
            n = alive[t]
            held = h[:n]
            given = self.rows[x[t, :n]]
            gate = _sigmoid(given[:, : 2 * size] + held @ self.gates)
            new = np.tanh(given[:, 2 * size :] + gate[:, size:] * (held @ self.candidate))
            out[t, :n] = new + gate[:, :size] * (held - new)
            held[:] = out[t, :n]
        return out

    def backward(self, x: np.ndarray, grad: np.ndarray) -> list[np.ndarray]:
        """Gradients of the weights, from gradients of the states: backpropagation through time."""
        d_rows, d_gates, d_candidate = map(np.zeros_like, (self.rows, self.gates, self.candidate))
        dh = np.zeros_like(grad[0])
        for t in range(len(x) - 1, -1, -1):
            h, update, reset, carried, new = self.tape[t]
            dh = dh + grad[t]
            d_new = dh * (1 - update) * (1 - new * new)
            d_reset = d_new * carried * reset * (1 - reset)
            d_update = dh * (h - new) * update * (1 - update)
            d_gate = np.concatenate([d_update, d_reset], axis=1)
            np.add.at(d_rows, x[t], np.concatenate([d_gate, d_new], axis=1))
            d_gates += h.T @ d_gate
            d_candidate += h.T @ (d_new * reset)
            dh = dh * update + d_gate @ self.gates.T + (d_new * reset) @ self.candidate.T
        return [d_rows, d_gates, d_candidate]


@dataclass
class ByteTagger:
    """Both directions and the output layer."""

    langs: list[str]
    onward: Direction
    reverse: Direction
    out: np.ndarray
    bias: np.ndarray

    @classmethod
    def fresh(cls, langs: list[str], hidden: int, rng: np.random.Generator) -> ByteTagger:
        out = rng.normal(0, 0.1, (2 * hidden, len(langs))).astype(np.float32)
        return cls(langs, Direction.fresh(rng, hidden), Direction.fresh(rng, hidden), out, np.zeros(len(langs), np.float32))

    def weights(self) -> list[np.ndarray]:
        a, b = self.onward, self.reverse
        return [a.rows, a.gates, a.candidate, b.rows, b.gates, b.candidate, self.out, self.bias]

    def label(self, x: np.ndarray, keep: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(states, probabilities) for every position of equally long words (time, batch)."""
        states = np.concatenate([self.onward.forward(x, keep), self.reverse.forward(x[::-1], keep)[::-1]], axis=2)
        return states, self.odds(states)

    def gradients(self, x: np.ndarray, truth: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross-entropy over all positions, and its gradients in the order of ``weights``."""
        states, prob = self.label(x, keep=True)
        time, batch, _ = prob.shape
        loss = -np.log(prob[:, np.arange(batch), truth] + 1e-12).mean()
        d = prob.copy()
        d[:, np.arange(batch), truth] -= 1
        d /= time * batch
        size = self.onward.candidate.shape[0]
        d_states = d @ self.out.T
        grads = self.onward.backward(x, d_states[..., :size])
        grads += self.reverse.backward(x[::-1], d_states[::-1, :, size:])
        grads += [np.einsum("tbh,tbl->hl", states, d), d.sum(axis=(0, 1))]
        return float(loss), grads

    def fit(self, words: list[bytes], truth: np.ndarray, steps: int, rng: np.random.Generator) -> None:
        """Adam over batches of equally long words."""
        lengths = np.array([len(w) for w in words])
        groups = [np.flatnonzero(lengths == n) for n in np.unique(lengths)]
        matrices = [np.frombuffer(b"".join(words[i] for i in g), np.uint8).reshape(len(g), -1) for g in groups]
        share = np.array([len(g) for g in groups], float)
        first, second = ([np.zeros_like(w) for w in self.weights()] for _ in range(2))
        for step, at in enumerate(rng.choice(len(groups), steps, p=share / share.sum()), 1):
            pick = rng.integers(0, len(groups[at]), BATCH)
            _, grads = self.gradients(matrices[at][pick].T, truth[groups[at][pick]])
            rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
            for w, g, m, v in zip(self.weights(), grads, first, second):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)

    def odds(self, states: np.ndarray) -> np.ndarray:
        logits = states @ self.out + self.bias
        logits -= logits.max(axis=2, keepdims=True)
        odds = np.exp(logits)
        return odds / odds.sum(axis=2, keepdims=True)

    def read(self, raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per word, the longest first: sums of probabilities and labels over its letter positions."""
        frames, hidden = sizes + 2, self.reverse.candidate.shape[0]
        share, counts = np.zeros((len(starts), len(self.langs))), np.zeros((len(starts), len(self.langs)), np.int64)

        def segment(a: int) -> tuple[np.ndarray, np.ndarray]:
            """Bytes a .. a + SEGMENT - 1 of the words that reach a, each framed by a blank, and words alive there."""
            place = np.arange(a, min(a + SEGMENT, int(frames[0])))
            alive = np.searchsorted(-frames, -place, side="left")
            inside = (place[:, None] >= 1) & (place[:, None] <= sizes[: alive[0]])
            x = np.where(inside, raw[np.where(inside, starts[: alive[0]] + place[:, None] - 1, 0)], 32)
            return x.astype(np.uint8), alive

        cuts, ends = range(0, int(frames[0]), SEGMENT), []
        after = np.zeros((len(starts), hidden), np.float32)
        for a in reversed(cuts):
            ends.append(after[: np.searchsorted(-frames, -(a + SEGMENT), side="left")].copy())
            if a:
                x, alive = segment(a)
                self.reverse.carry(x, alive, after, range(len(x) - 1, -1, -1))
        before = np.zeros((len(starts), hidden), np.float32)
        for a in cuts:
            x, alive = segment(a)
            n, kept = alive[0], ends.pop()
            after = np.zeros((n, hidden), np.float32)
            after[: len(kept)] = kept
            prob = self.odds(np.concatenate([
                self.onward.carry(x, alive, before, range(len(x))),
                self.reverse.carry(x, alive, after, range(len(x) - 1, -1, -1)),
            ], axis=2))
            letters = KNOWN_LETTERS[x]
            share[:n] += (prob * letters[:, :, None]).sum(axis=0)
            best = prob.argmax(axis=2)
            for k in range(len(self.langs)):
                counts[:n, k] += ((best == k) & letters).sum(axis=0)
        return share, counts

    def pooled(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Per text: mean probabilities over its letter positions; positions labelled per language."""
        rows, owner = word_rows(texts)
        sums, labelled = np.zeros((len(texts), len(self.langs))), np.zeros((len(texts), len(self.langs)), np.int64)
        if not len(owner):
            return sums, labelled
        _, at, word = np.unique(rows[0], return_index=True, return_inverse=True)
        share, counts = np.zeros((len(at), len(self.langs))), np.zeros((len(at), len(self.langs)), np.int64)
        starts, sizes = rows[1][at], rows[2][at] - rows[1][at]
        order = np.argsort(-sizes, kind="stable")
        for lot in np.array_split(order, -(-len(order) // LOT)):
            share[lot], counts[lot] = self.read(rows[3], starts[lot], sizes[lot])
        for k in range(len(self.langs)):
            sums[:, k] = np.bincount(owner, share[word, k], len(texts))
            labelled[:, k] = np.bincount(owner, counts[word, k], len(texts))
        total = sums.sum(axis=1, keepdims=True)
        return np.divide(sums, total, out=np.zeros_like(sums), where=total > 0), labelled


def word_rows(texts: list[bytes]):
    """((hash, start, end, bytes) of the words with a letter, their texts)."""
    words = WordBatch(texts, lower=True)
    starts, ends = words.starts, words.ends
    letters = np.concatenate([[0], np.cumsum(KNOWN_LETTERS[words.bytes])])
    has = letters[ends] > letters[starts]
    starts, ends = starts[has], ends[has]
    return (spans_hash(LETTERS[words.bytes], starts, ends), starts, ends, words.bytes), words.doc[has]


def spans(starts: np.ndarray, ends: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words as spans of at most ``SPAN`` bytes that end between characters; spans without letters are left out."""
    out_starts, out_ends = [starts[:0]], [ends[:0]]
    while len(starts):
        stop = np.minimum(starts + SPAN, ends)
        for _ in range(3):
            stop -= (stop < ends) & (raw[np.minimum(stop, len(raw) - 1)] & 0xC0 == 0x80)
        out_starts.append(starts), out_ends.append(stop)
        starts, ends = stop[stop < ends], ends[stop < ends]
    starts, ends = np.concatenate(out_starts), np.concatenate(out_ends)
    letters = np.concatenate([[0], np.cumsum(KNOWN_LETTERS[raw])])
    order = np.argsort(starts, kind="stable")
    order = order[letters[ends[order]] > letters[starts[order]]]
    return starts[order], ends[order]


def training_words(texts: list[bytes], langs: list[str], names: list[str], limit: int, rng) -> tuple[list[bytes], np.ndarray]:
    """At most ``limit`` words per language, drawn evenly from all words of its texts."""
    words, truth = [], []
    for k, name in enumerate(names):
        (_, starts, ends, raw), _ = word_rows([t for t, lang in zip(texts, langs) if lang == name])
        starts, ends = spans(starts, ends, raw)
        pick = np.arange(len(starts)) if len(starts) <= limit else rng.choice(len(starts), limit, replace=False)
        words += [b" " + raw[s:e].tobytes() + b" " for s, e in zip(starts[pick], ends[pick])]
        truth += [k] * len(pick)
    return words, np.array(truth)


def fit_tagger(
    labelled: DataFrame, per_lang: int = PER_LANG, tokens: int = TOKENS, hidden: int = HIDDEN, steps: int = STEPS
) -> ByteTagger | None:
    """Trains on (doc_id, text, lang); None if there is no labelled text with a letter.

    ``per_lang``: documents of a language in the sample, on average (a hash of doc_id decides).
    """
    known = labelled.where("lang IS NOT NULL AND text IS NOT NULL")
    counts = known.groupBy("lang").count()
    rate = F.least(F.lit(1.0), F.lit(float(per_lang)) / F.col("count"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    sample = (
        known.select("doc_id", "text", "lang").join(F.broadcast(counts), "lang").where(place < rate)
        .select("doc_id", "lang", F.col("text").cast("binary").alias("body")).collect()
    )
    sample.sort(key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["lang"], bytes(r["body"])))
    names = sorted({r["lang"] for r in sample})
    rng = np.random.default_rng(7)
    words, truth = training_words([bytes(r["body"]) for r in sample], [r["lang"] for r in sample], names, tokens, rng)
    if not words:
        return None
    tagger = ByteTagger.fresh(names, hidden, rng)
    tagger.fit(words, truth, steps, rng)
    return tagger


BODY, LETTER = "__body", "__letter"


def _predict(tagger: ByteTagger | None, names: list[str]):
    def run(batches):
        for rows in batches:
            texts, has = rows.column(BODY).to_pylist(), rows.column(LETTER).to_pylist()
            for a, b, part in chunks(texts):
                langs, scores, shares, labelled = [], [], [], []
                prob, counts = (None, None) if tagger is None else tagger.pooled(part)
                for i in range(b - a):
                    if tagger is None or not has[a + i]:
                        langs.append(UNKNOWN), scores.append(0.0), shares.append([]), labelled.append([])
                        continue
                    best = int(prob[i].argmax())
                    langs.append(tagger.langs[best]), scores.append(float(prob[i][best]))
                    shares.append(prob[i]), labelled.append(counts[i])
                yield pa.RecordBatch.from_arrays(
                    [rows.column(n).slice(a, b - a) for n in names] + [
                        pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                        pa.array(shares, pa.list_(pa.float64())), pa.array(labelled, pa.list_(pa.int64())),
                    ], names=[*names, "lang_pred", "score", "shares", "positions"],
                )

    return run


def identify(docs: DataFrame, tagger: ByteTagger | None, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``columns`` with lang_pred, score, shares and positions.

    shares: pooled probabilities in the order of the tagger's languages; positions: how many letter
    positions were labelled with each. A text that is null or has no letter is ``und`` with score 0, and
    so is every text if there was nothing to learn from; ties go to the first language. One row per
    input row; other columns are ignored. An empty table gives no rows.
    """
    source = docs.select(
        *[f"`{c}`" for c in columns], F.coalesce("text", F.lit("")).cast("binary").alias(BODY),
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias(LETTER),
    )
    schema = StructType([
        *[docs.schema[c] for c in columns], StructField("lang_pred", StringType()), StructField("score", DoubleType()),
        StructField("shares", ArrayType(DoubleType())), StructField("positions", ArrayType(LongType())),
    ])
    return source.mapInArrow(_predict(tagger, list(columns)), schema)


def held_out(doc_id: str = "doc_id"):
    """Documents that training must not see: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))
