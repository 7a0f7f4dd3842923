"""Token counts, hard negatives and periodic runs against the tokenizer's library, SQL and plain Python."""

import random
import zlib

import numpy as np
import pytest

from panelith.llm import hard_negatives as N
from panelith.llm import queries as Q
from panelith.llm.periodic_runs import SuffixTree, lyndon_lengths, periodic_runs, repeated_tail, run_digest, runs_of, stretches
from panelith.llm.token_counts import LONG, Counter, MergeTable, count_tokens, default_path
from tests.llm import brute

VECTOR = "vec_id long, label int, embedding array<float>, size int, ask long, rank int, score long, v string"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_path())


@pytest.fixture(scope="module")
def counter():
    return Counter(MergeTable.load(default_path()))


def test_token_counts_of_documents(spark, sf, library):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = {r["doc_id"]: r for r in Q.op11_token_counts(spark, sf).collect()}
    assert got.keys() == docs.keys()
    for d, text in docs.items():
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert (got[d]["n_bytes"], got[d]["n_tokens"], got[d]["over_limit"]) == (len((text or "").encode()), n, n > 1024)


def test_token_counts_of_odd_texts(counter, library):
    rng = random.Random(1)
    parts = [
        "'", "s", "t", "re", "ve", "ll", "m", "d", "'S", " ", "  ", "\n", "\r\n", "\t", "　", "\x85", "\x1c", "​", "é", "漢", "🙂",
        "1", "²", "Ⅷ", "!", "…", "x", "ab", "a", "<|endoftext|>", "<|endof", "́", "\x00", "\U0001e5d0", "ᲊ",
    ]
    texts = ["".join(rng.choices(parts, k=rng.randrange(60))) for _ in range(2500)]
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert counter([t.encode() for t in texts]).tolist() == want


def test_long_words_merge_by_the_same_ranks(counter, library):
    rng = random.Random(2)
    letters = "abcdefghijklmnopqrstuvwxyz"
    texts = ["x" * 5000, "aaab" * 500 + "a" * 777, "漢字" * 600, "".join(rng.choices(letters, k=8000)), "-=" * 900]
    for n in (LONG - 1, LONG, LONG + 1):
        texts += ["".join(rng.choices("abt", k=n)) for _ in range(5)]
    assert counter([t.encode() for t in texts]).tolist() == [len(library.encode(t).ids) for t in texts]


def test_merge_order_is_checked():
    vocab = {c: i for i, c in enumerate([*sorted(__import__("panelith.llm.token_counts", fromlist=["x"]).byte_letters()), "ab", "abc"])}
    MergeTable.build(vocab, [("a", "b"), ("ab", "c")])
    with pytest.raises(ValueError):
        MergeTable.build(vocab, [("ab", "c"), ("a", "b")])
    import public_tokenizers

    with pytest.raises(ValueError):
        MergeTable.load(public_tokenizers.path("word_bpe_49k.json"))


def test_token_counts_of_odd_rows(odd, library):
    out = count_tokens(odd, limit=100).collect()
    assert len(out) == odd.count()
    want = sorted(
        (r["doc_id"] is None, r["doc_id"] or 0, len((r["text"] or "").encode()), len(library.encode(r["text"] or "").ids)) for r in odd.collect()
    )
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_bytes"], r["n_tokens"]) for r in out) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 100) for r in out)
    assert count_tokens(odd.limit(0)).count() == 0


def plain_runs(w, shortest=24, least=3):
    found = set()
    for q in range(1, len(w) // least + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(shortest, least * q):
                found.add((i, j - i + q, q))
            i = j + 1
    return sorted((s, n, q) for s, n, q in found if not any((s, n, p) in found for p in range(1, q)))


@pytest.fixture(scope="module")
def periodic_words():
    rng = random.Random(3)

    def draw():
        n, k = rng.randrange(1, 130), rng.choice([1, 2, 2, 3, 6])
        w = [rng.randrange(k) for _ in range(n)]
        if rng.random() < 0.7:
            a = rng.randrange(n)
            p = rng.randrange(1, max(2, (n - a) // 3 + 1))
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
        return w

    return [draw() for _ in range(600)]


def test_suffix_tree_extensions_and_orders(periodic_words):
    rng = np.random.default_rng(1)
    for w in periodic_words[:150]:
        tree = SuffixTree([x + 1 for x in w])
        n = len(w)
        assert tree.suffixes == sorted(range(n + 1), key=lambda i: w[i:])
        assert tree.reversed_order() == sorted(range(n + 1), key=lambda i: [-x for x in w[i:]])
        i, j = rng.integers(0, n + 1, 40), rng.integers(0, n + 1, 40)
        i, j = i[i != j], j[i != j]
        for a, b, c in zip(i.tolist(), j.tolist(), tree.common(i, j).tolist()):
            x, y = w[a:], w[b:]
            assert c == next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
        lengths = lyndon_lengths(tree.suffixes).tolist()
        for a in range(0, n, 7):
            lyndon = [m for m in range(1, n - a + 1) if all(w[a : a + m] < w[b : a + m] for b in range(a + 1, a + m))]
            assert lengths[a] == max(lyndon)


def test_runs_with_and_without_cutting(periodic_words):
    for w in periodic_words:
        for shortest in (24, 6, 9):
            want = plain_runs(w, shortest)
            assert [tuple(r) for r in runs_of(np.array(w) + 1, shortest).tolist()] == want
            words = np.array(w, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            cut = stretches(words, np.zeros(len(w), int), shortest)
            got = [(s + a, n, q) for a, b in cut for s, n, q in runs_of(np.array(w[a:b]) + 1, shortest).tolist()]
            assert sorted(got) == want


def plain_digest(doc_id, text):
    w = brute.words(text)
    n, h = len(w), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    head = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    return len(runs), *head, brute.sha(lines), brute.sha(" ".join(x for i, x in enumerate(w) if i not in gone))


COLUMNS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_runs_of_documents(spark, sf):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = {r["doc_id"]: r for r in Q.op13_periodic_runs(spark, sf).collect()}
    assert got.keys() == docs.keys()
    # the plain version is quadratic in the words
    for d, text in docs.items():
        if len(brute.words(text)) <= 1500:
            assert tuple(got[d][c] for c in COLUMNS) == plain_digest(d, text)
    assert sum(r["n_runs"] > 0 for r in got.values()) > len(docs) / 20


def test_runs_of_odd_rows(odd):
    out = run_digest(periodic_runs(odd, repeated_tail)).collect()
    want = [(r["doc_id"], *plain_digest(r["doc_id"], r["text"])) for r in odd.collect() if len(r["text"] or "") < 5000 or " " not in r["text"]]
    got = [(r["doc_id"], *(r[c] for c in COLUMNS)) for r in out]
    assert len(got) == odd.count()
    assert set(want) <= set(got)
    assert run_digest(periodic_runs(odd.limit(0))).count() == 0
    with pytest.raises(ValueError):
        periodic_runs(odd, min_exponent=2)


def test_runs_keep_real_texts(make):
    text = " ".join(["head"] + ["tick", "tock"] * 20 + ["tail"] + ["same"] * 30 + ["end"])
    row = periodic_runs(make([(1, text)])).first()
    assert [tuple(r) for r in row["runs"]] == [(1, 40, 2), (42, 30, 1)]
    assert row["collapsed"] == "head tick tock tail same end"


def plain_negatives(rows, anchors, positives=5, negatives=3):
    out = []
    good = {}
    sizes = [len(v) for _, _, v in rows if v]
    size = max(set(sizes), key=lambda s: (sizes.count(s), s)) if sizes else 0

    def whole(r):
        i, label, v = r
        ok = i is not None and label is not None and v is not None and len(v) == size and all(x is not None and np.isfinite(x) for x in v)
        return (i, label, tuple(int(np.floor(256 * float(np.float32(x)))) for x in v)) if ok else None

    good = sorted({w for r in rows if (w := whole(r))})
    for i, label, q in sorted({w for r in anchors if (w := whole(r))}):
        score = lambda v: sum(a * b for a, b in zip(q, v))
        near = sorted((-score(v), j) for j, other, v in good if other == label and j != i)[:positives]
        far = sorted((-score(v), j) for j, other, v in good if other != label)
        for p, pid in near:
            fit = [(s, j) for s, j in far if 50 * -p <= 100 * -s <= 95 * -p][:negatives]
            out += [(i, pid, k + 1, j, -p, -s) for k, (s, j) in enumerate(fit)]
    return sorted(out)


@pytest.mark.parametrize("bucket,pack", [(2048, 256), (16, 3)])
def test_negatives_match_the_plain_version(spark, monkeypatch, bucket, pack):
    monkeypatch.setattr(N, "BUCKET", bucket)
    monkeypatch.setattr(N, "PACK", pack)
    rng = random.Random(bucket)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = []
    for i in range(400):
        label = rng.choice([0, 0, 0, 1, 2, 3])
        if i % 5 == 0:  # ties, and one vector very often
            v = [1.0, 0.5, 0.0, 0.0, 0.25, -0.5]
        elif i % 7 == 0:
            v = [x * rng.choice([0.01, 1, 30]) for x in centres[label]]
        else:
            v = [x + rng.gauss(0, 0.2) for x in centres[label]]
        rows.append((i, label, v))
    rows += [
        (401, None, [1.0] * 6), (402, 1, None), (403, 1, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (404, 1, [float("nan")] * 6), (405, 1, [float("inf")] * 6),
        (406, 1, [1.0, 2.0]), (407, 1, []), (None, 1, [1.0] * 6), (408, 1, [0.0] * 6), (450, 1, [0.0] * 6), (500, 99, [1.0] * 6), (10, 0, [2.0] * 6),
        rows[3], rows[50], (550, 0, [3e38] * 6),
    ]
    df = spark.createDataFrame([(*r, 1, 2, 3, 4, "x") for r in rows], VECTOR)
    got = N.mine_hard_negatives(df, df.where("vec_id % 10 = 0")).collect()
    sound = [r for r in rows if r[0] != 550]
    anchors = [r for r in sound if r[0] is not None and r[0] % 10 == 0]
    assert sorted(tuple(r) for r in got) == plain_negatives(sound, anchors)


def test_negatives_of_large_numbers_stay_exact(spark):
    rng = random.Random(8)
    rows = [(i, i % 3, [float(rng.randrange(-600_000, 600_000)) for _ in range(4)]) for i in range(200)]
    df = spark.createDataFrame([(*r, 1, 2, 3, 4, "x") for r in rows], VECTOR)
    got = N.mine_hard_negatives(df, df.where("vec_id % 10 = 0")).collect()
    sound = [r for r in rows if sum(x * x for x in r[2]) * 256**2 < N.TOO_LONG]
    assert 20 < len(sound) < 200
    assert sorted(tuple(r) for r in got) == plain_negatives(sound, [r for r in sound if r[0] % 10 == 0])


def test_no_negatives_without_rows(spark):
    empty = spark.createDataFrame([], VECTOR)
    one = spark.createDataFrame([(50, 1, [1.0, 2.0], 1, 2, 3, 4, "x")], VECTOR)
    for vectors, anchors in ((empty, empty), (one, empty), (one, one), (empty, one)):
        assert N.mine_hard_negatives(vectors, anchors).count() == 0


def test_ranges_lose_no_row():
    rng = np.random.default_rng(4)
    for _ in range(50):
        q, rows = rng.normal(size=(1, 5)), rng.normal(size=(300, 5))
        q /= np.linalg.norm(q)
        rows /= np.linalg.norm(rows, axis=1)[:, None]
        theta = rng.uniform(-1, 1)
        low, high = N.feasible(q, np.array([theta]))
        inside = ((rows >= low) & (rows <= high)).all(axis=1)
        assert inside[(rows @ q[0]) >= theta].all()


def test_queries_are_registered():
    names = list(Q.QUERIES)
    assert names[-3:] == ["op11_token_counts", "op12_hard_negatives", "op13_periodic_runs"]
    assert "op12_hard_negatives" in Q.SQL
