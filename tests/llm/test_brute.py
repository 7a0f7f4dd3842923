"""Operators against plain Python versions, an independent encoder, or held-out accuracy."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from panelith.llm import queries as Q
from panelith.llm.imatch import HIGH, LOW, lexicons, set_hashes
from panelith.llm.language_id import ByteTagger
from panelith.llm.minhash_dedup import near_duplicates
from panelith.llm.nearest import Tree, chi_square_quantile
from panelith.llm.pieces import FastDecoder, decode_ids, decode_pieces, encode_batch, encode_texts, load_pieces
from panelith.llm.pii import find_personal, sanitise
from panelith.llm.substring_dedup import dedup_substrings
from panelith.llm.wordbatch import WordBatch, sliding_min
from tests.llm import brute


@pytest.fixture(scope="module")
def documents(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] for r in rows}


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def test_words_and_sliding_minimum():
    texts = ["", "a", " a\tb  ", "über\x0bx\x0c y", "é é z"]
    batch = WordBatch([t.encode() for t in texts])
    for i, t in enumerate(texts):
        assert [batch.word(k).decode() for k in range(batch.first[i], batch.last[i])] == brute.words(t)
        assert batch.words(i).decode() == " ".join(brute.words(t))
    rng = np.random.default_rng(0)
    for width in (1, 2, 5, 43):
        x = rng.integers(0, 50, 100)
        assert sliding_min(x, width).tolist() == [x[i : i + width].min() for i in range(101 - width)]


def test_substrings(spark, sf, documents):
    got = by_id(Q.op2_substring_dedup(spark, sf))
    for d, gone in brute.removed_words(documents, 50).items():
        w = brute.words(documents[d])
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        assert (got[d]["n_words"], got[d]["n_removed"], got[d]["kept_sha256"]) == (len(w), len(gone), brute.sha(kept))


def test_substring_intervals(make, words_of):
    rng = random.Random(3)
    passage, line = words_of(rng, 70), ["again"] * 60
    docs = {i: words_of(rng, 30) + (passage if i % 3 else []) + words_of(rng, 20) + (line if i % 4 == 0 else []) for i in range(24)}
    docs[30], docs[31] = docs[2], docs[2][:-1]
    texts = {d: " ".join(w) for d, w in docs.items()}
    got = by_id(dedup_substrings(make(list(texts.items()))))
    for d, gone in brute.removed_words(texts, 50).items():
        spans = [(s["first"], s["end"]) for s in got[d]["intervals"]]
        assert {k for s, e in spans for k in range(s, e)} == gone
        assert all(e < s for (_, e), (s, _) in zip(spans, spans[1:]))


def test_near_duplicates(spark, sf, documents):
    got = by_id(Q.op9_minhash_near_dedup(spark, sf))
    for d, c in brute.near_components(documents, 4, 80).items():
        assert got[d]["n_shingles"] == len(brute.shingles(documents[d], 4))
        assert (got[d]["component_id"], got[d]["kept"]) == (c, c == d)


def test_dense_group_of_near_copies(make, words_of):
    """Many copies that share bands without being linked, so that packs are compared."""
    rng = random.Random(11)
    base, docs = words_of(rng, 90, 5000), {}
    for i in range(160):
        w = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 6])):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        docs[1000 - 5 * i] = " ".join(w)
    got = by_id(near_duplicates(make(list(docs.items()))))
    want = brute.near_components(docs, 4, 80)
    assert len(set(want.values())) > 5
    assert {d: r["component_id"] for d, r in got.items()} == want


def test_fingerprints(spark, sf, documents):
    import xxhash

    def signed(v):
        return v - 2**64 if v >= 2**63 else v

    def mix(*values):
        """xxhash64 of columns: long values, except that literals are four bytes."""
        seed = 42
        for v, size in values:
            seed = xxhash.xxh64((v & (2 ** (8 * size) - 1)).to_bytes(size, "little"), seed=seed).intdigest()
        return seed

    def marks(text, lexicon):
        kept = {t for t in map(term, set(brute.words(text))) if t in lexicon}
        if not kept:
            return f"{xxhash.xxh64(text.encode(), seed=42).intdigest():016x}"
        out = []
        for r, level in lexicons():
            mine = sorted(t for t in kept if not level or mix((t, 8), (r, 4)) >> (64 - level) == 0)
            out.append(f"{mix(*[(t, 8) for t in mine]):016x}" if mine else "-" * 16)
        return "".join(out)

    def term(w):
        return signed(xxhash.xxh64(w.encode(), seed=42).intdigest())

    df = {}
    for t in documents.values():
        for w in set(brute.words(t)):
            df[w] = df.get(w, 0) + 1
    n = len(documents)
    lexicon = {term(w) for w, c in df.items() if LOW * n <= c <= HIGH * n}
    got = by_id(Q.op7_imatch_fingerprints(spark, sf))
    order = sorted(documents, reverse=True)

    def alike(a, b):
        if len(a) != len(b):
            return 0.0
        both = [(a[i : i + 16], b[i : i + 16]) for i in range(0, len(a), 16)]
        both = [x for x in both if x != ("-" * 16, "-" * 16)]
        return sum(x == y for x, y in both) / len(both)

    own = {d: marks(documents[d], lexicon) for d in order}
    for i, d in enumerate(order):
        after = order[(i + 1) % n]
        text, part = documents[d], len(documents[d]) // 3
        edited = text[: len(text) - part] + documents[after][:part]
        r = got[d]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), brute.sha(edited))
        assert (r["fingerprint"], r["edited_fingerprint"]) == (own[d], marks(edited, lexicon))
        assert r["near_edited"] == pytest.approx(alike(own[d], r["edited_fingerprint"]))
        assert r["near_next"] == pytest.approx(alike(own[d], own[after]))
    mean = lambda c: np.mean([r[c] for r in got.values()])

    assert mean("near_edited") > 0.15 > 0.03 > mean("near_next")


def test_every_term_reaches_the_marks(spark):
    """Whatever term of a text goes, its fingerprint changes; the sparse lexicons' marks mostly stay."""
    terms = list(range(1000, 1150))
    rows = [(-1, t) for t in terms] + [(i, t) for i in range(len(terms)) for j, t in enumerate(terms) if i != j]
    got = {r["key"]: r["marks"] for r in set_hashes(spark.createDataFrame(rows, "key long, term long"), ["key"]).collect()}
    assert all(got[i] != got[-1] for i in range(len(terms)))
    kept = [np.mean([x == y for x, y in zip(got[i], got[-1]) if x is not None]) for i in range(len(terms))]
    assert 0.6 < np.mean(kept) < 0.95


def test_no_control_string_inside_a_text(spark):
    from panelith.llm.chat_format import ANSWER_END, ASK_END, format_chats

    marks = ["</s>", "<s>", "[INST]", "[/INST]", "[ANS]", "<s>[INST] ", " [/INST]", "<\x1b/s>", "[\x1b\x1bINST]", "<", "[/", "s>", "plain"]
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["user", "assistant", "system"]), "".join(rng.choices(marks, k=rng.randrange(5)))) for c in range(200) for t in range(3)]
    for r in format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect():
        mine = [x for x in rows if x[0] == r["conv_id"]]
        answers = sum(x[2] == "assistant" for x in mine)
        assert r["identical"] and [(t["role"], t["text"]) for t in r["turns"]] == [x[2:] for x in mine]
        assert r["formatted"].count(ANSWER_END) == answers and r["formatted"].count(ASK_END) == 3 - answers
        assert r["formatted"].count("<s>") == 3 and r["formatted"].count("[ANS]") == answers
        assert r["formatted"].count("[INST]") == r["formatted"].count("[/INST]") == 3 - answers


def test_personal_data(spark, sf, documents, make):
    tricky = [
        "a@b.c_d@e.f x@y z@q.w.", "1.2.3.4.5.6.7.8 999.1.1.1 1.2.3.256 0001.02.3.4", "4111 1111 1111 1111 and 4111-1111-1111-1112",
        "4111 1111 1111 1111 4111 1111 1111 1111", "+1 (499) 555-6503) +12 +1.2.3.4.5.6.7.8 ++49 30 123456-", "é@x.y ü 10.0.0.1é",
        "no@dot " + "a" * 20_000 + " " + "7" * 20_000, "a.b+c%d@e-f.g-h.i",
    ]
    docs = {**{10**6 + i: t for i, t in enumerate(tricky)}, **documents}
    for d, r in by_id(find_personal(make(list(docs.items())))).items():
        assert [(s["kind"], s["start"], s["end"]) for s in r["base"]] == brute.personal(docs[d])
        assert all(docs[d][s["start"] : s["end"]] == s["value"] for s in [*r["base"], *r["terms"]])


def test_terms_that_disclose(make, words_of):
    rng = random.Random(2)
    docs = {i: " ".join(words_of(rng, 40)) for i in range(60)}
    for i in range(5):  # a name that stands with one address only
        docs[100 + i] = " ".join([*words_of(rng, 20), "Zanzibar", f"mail bob@corp{9}.example.com", *words_of(rng, 20)])
    found = by_id(find_personal(make(list(docs.items()))))
    for i in range(5):
        assert {s["value"] for s in found[100 + i]["terms"]} == {"Zanzibar", "mail"}
    assert not any(found[i]["terms"] for i in range(60))
    clean = by_id(sanitise(make(list(docs.items()))))
    for d, text in docs.items():
        got = clean[d]["text"]
        assert got == text if d < 100 else "[EMAIL]" in got and "Zanzibar" not in got and "bob@" not in got
        assert clean[d]["n_chars"] == len(got)


def test_names_beside_values_seen_once(make, words_of):
    """Thirty addresses of one text each, a name of its own before each; rare words elsewhere stay."""
    rng = random.Random(6)
    docs = {i: " ".join(words_of(rng, 40, 50)) for i in range(800)}
    names, strange = {}, set()
    for i in range(30):
        names[5000 + i] = f"Name{chr(97 + i % 26)}{chr(97 + i // 26)}x"
        odd = [f"rare{i}a", f"rare{i}b", f"rare{i}c"]
        strange |= set(odd)
        left, right = words_of(rng, 20, 50), words_of(rng, 20, 50)
        left[5], left[11], right[9] = odd
        docs[5000 + i] = " ".join([*left, names[5000 + i], f"u{i}@corp{i}.example.com", *right])
    found = by_id(find_personal(make(list(docs.items()))))
    got = {(d, s["value"], s["kind"]) for d, r in found.items() for s in r["terms"]}
    assert got == {(d, name, "name") for d, name in names.items()}
    clean = by_id(sanitise(make(list(docs.items()))))
    assert all("[NAME] [EMAIL]" in clean[d]["text"] for d in names)
    assert all(w in " ".join(r["text"] for r in clean.values()) for w in strange)


def test_rare_words_beside_values_stay_without_a_pattern(make, words_of):
    rng = random.Random(9)
    docs = {i: " ".join(words_of(rng, 60, 5000)) for i in range(300)}
    for i in range(60):
        docs[900 + i] = " ".join([*words_of(rng, 30, 5000), f"u{i}@corp{i}.example.com", *words_of(rng, 30, 5000)])
    for n in (1, 7):  # whatever the size of the corpus
        more = {(n + 1) * 10_000 + i: " ".join(words_of(rng, 60, 5000)) for i in range(300 * n)}
        found = by_id(find_personal(make(list({**docs, **more}.items()))))
        assert not any(r["terms"] for r in found.values())


def test_near_copies_are_one_meeting(make, words_of):
    rng = random.Random(10)
    docs = {i: " ".join(words_of(rng, 60, 80)) for i in range(200)}
    body = [f"own{i}" for i in range(30)] + ["bob@corp9.example.com"] + [f"tail{i}" for i in range(30)]
    for i in range(6):
        docs[900 + i] = " ".join([*body, f"end{i}"])
    assert not any(s["value"] == "own9" for r in find_personal(make(list(docs.items()))).collect() for s in r["terms"])


def test_terms_anywhere_in_the_text(make, words_of):
    rng = random.Random(7)
    docs = {i: " ".join(words_of(rng, 60, 50)) for i in range(300)}
    for i in range(500, 504):
        docs[i] = " ".join(["Zanzibar", *words_of(rng, 60, 50), "bob@corp9.example.com", *words_of(rng, 60, 50), "\u00fc\tZanzibar"])
    for d, r in by_id(find_personal(make(list(docs.items())))).items():
        want = [(m, m + 8) for m in range(len(docs[d])) if docs[d].startswith("Zanzibar", m)]
        assert [(s["start"], s["end"]) for s in r["terms"] if s["value"] == "Zanzibar"] == want
    assert not any("Zanzibar" in r["text"] for r in sanitise(make(list(docs.items()))).collect())


def test_terms_whatever_the_copies(make, words_of):
    rng = random.Random(8)
    docs = [(i, " ".join(words_of(rng, 40, 50))) for i in range(300)]
    docs += [(500 + i, " ".join([*words_of(rng, 40, 50), "Zanzibar", "bob@corp9.example.com"])) for i in range(3)]
    kinds = lambda rows: {(r["doc_id"], s["value"], s["kind"]) for r in find_personal(make(rows)).collect() for s in r["terms"]}
    alone = kinds(docs)
    assert {(d, v) for d, v, _ in alone} == {(500 + i, "Zanzibar") for i in range(3)}
    assert kinds(docs + [docs[-1]] * 500 + [(None, docs[0][1])] * 200) == alone


def test_pieces_equal_an_independent_encoder(spark, sf, documents):
    """The library's own unigram encoder over the same pieces and log probabilities."""
    spm = pytest.importorskip("sentencepiece")
    proto = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    from panelith.llm.pieces import MODEL, zipf_scores

    with open(MODEL, "rb") as f:
        model = proto.ModelProto.FromString(f.read())
    model.trainer_spec.model_type = 1
    normal = [p for p in model.pieces if p.type == p.NORMAL]
    for p, s in zip(normal, zipf_scores([p.score for p in normal])):
        p.score = s
    other = spm.SentencePieceProcessor(model_proto=model.SerializeToString())
    table = load_pieces(MODEL)
    assert sum(math.exp(s) for part in table.scores.values() for s in part) == pytest.approx(1, abs=1e-4)
    got = by_id(Q.op8_sentencepiece(spark, sf))
    rng = random.Random(4)
    pieces = [other.id_to_piece(i).replace("▁", " ") for i in range(300, other.get_piece_size())]
    odd = ["", " ", "  a  b   ", "漢字x🙂🙂" * 90, "\x00\n\t", "thatand" * 40 + " that", "ก" * 200, "a test and that"]
    odd += ["".join(rng.choices(pieces, k=rng.choice([1, 2, 3, 5, 20, 200]))) for _ in range(600)]
    ids, bounds = encode_batch(table, [t.encode() for t in odd])
    score = lambda ids: sum(0 if other.is_byte(i) else other.get_score(i) for i in ids)
    pairs = [(ids[s:e].tolist(), other.encode(t)) for t, s, e in zip(odd, bounds[:-1], bounds[1:])]
    pairs += [(got[d]["ids"], other.encode(t)) for d, t in documents.items()]
    for mine, theirs in pairs:
        # the library adds single-precision numbers, which may part segmentations of equal sums
        assert mine == theirs or score(mine) == pytest.approx(score(theirs), abs=1e-6 * len(mine) + 1e-9)
    assert np.mean([mine == theirs for mine, theirs in pairs]) > 0.97


def test_merges_equal_the_unmodified_model(spark, sf, documents):
    spm = pytest.importorskip("sentencepiece")
    from panelith.llm.pieces import MODEL

    other, table = spm.SentencePieceProcessor(model_file=MODEL), load_pieces(MODEL)
    assert other.encode("a test and that") == encode_batch(table, [b"a test and that"], table.merges)[0].tolist()
    got = by_id(encode_texts(spark.read.parquet(f"{sf}/documents.parquet"), merges=True))
    assert all(got[d]["ids"] == other.encode(t) for d, t in documents.items())
    rng = random.Random(4)
    pieces = [other.id_to_piece(i).replace("▁", " ") for i in range(300, other.get_piece_size())]
    odd = ["", " ", "  a  b   ", "x" * 5000, "ab" * 300, "漢字x🙂🙂" * 90, "\x00\n\t", "thatand" * 40 + " that", "\u0e01\u0e32" * 200]
    odd += ["".join(rng.choices(pieces, k=rng.choice([1, 2, 3, 5, 20, 200]))) for _ in range(600)]
    odd += ["".join(rng.choices("aehinst", k=rng.choice([2, 5, 9, 127, 128, 129, 130, 900]))) for _ in range(300)]
    ids, bounds = encode_batch(table, [t.encode() for t in odd], table.merges)
    assert [ids[s:e].tolist() for s, e in zip(bounds[:-1], bounds[1:])] == [other.encode(t) for t in odd]


def test_pieces_round_trip(spark, sf, documents):
    got = by_id(encode_texts(spark.read.parquet(f"{sf}/documents.parquet")))
    assert all(r["exact"] and r["decoded"] == documents[d] for d, r in got.items())
    table = load_pieces()
    odd = ["", " ", "  a  b ", "▁a▁ ▁", "\x00\n\t", "漢🙂" * 50, "x" * 5000]
    ids, bounds = encode_batch(table, [t.encode() for t in odd])
    assert [t.decode() for t in FastDecoder(table)(ids, bounds)] == odd
    assert [decode_ids(table, ids[s:e]).decode() for s, e in zip(bounds[:-1], bounds[1:])] == odd
    encoded = encode_texts(spark.createDataFrame(enumerate(odd), "doc_id long, text string")).drop("decoded")
    assert {r["doc_id"]: r["decoded"] for r in decode_pieces(encoded).collect()} == dict(enumerate(odd))


def test_quality_on_held_out_labels(spark, sf):
    from panelith.llm.quality import classify_quality

    sf = sf.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    out = classify_quality(docs, labels.where("doc_id % 3 <> 0")).join(labels.where("doc_id % 3 = 0"), "doc_id").toPandas()
    assert len(out) > 100
    assert (out.keep == (out.quality == 1)).mean() > 0.97


def plain_grams(text):
    """Word unigrams and bigrams of token shapes, as text."""
    tokens = re.findall("[A-Za-z\\u0080-\\U0010ffff]+|[0-9]+|[^A-Za-z0-9\\u0080-\\U0010ffff\x20\x09-\x0d]+", text or "")
    shapes, last, grams = [], None, []
    for t in tokens:
        if t[0].isascii() and t[0].isdigit():
            shapes.append("9")
        elif not t[0].isascii() or t[0].isalpha():
            ups = sum("A" <= c <= "Z" for c in t)
            shapes.append("again" if t == last else "UP" if ups >= 2 else "Up" if "A" <= t[0] <= "Z" else "low")
            grams.append(("word", t))
            last = t
        else:
            shapes.append("symbols " + t)
    return grams + list(zip(shapes, shapes[1:]))


def test_quality_weights_and_threshold(make):
    from panelith.llm.quality import SMOOTHING, _threshold, classify_quality

    rng = random.Random(2)
    good_words, bad_words = [f"w{chr(97 + i)}x" for i in range(20)], ["JUNK", "junk", "$$$", "!!", "77"]
    docs, labels = [], []
    for i in range(300):
        share = i / 300
        docs.append((i, " ".join(rng.choice(bad_words if rng.random() < share else good_words) for _ in range(rng.randrange(3, 60)))))
        if i % 2:
            labels.append((i, int(share < 0.4), 0))
    docs += [(1000, None), (1001, ""), (1002, "é漢 é漢 A1!")]
    frame = make(docs)
    marks = frame.sparkSession.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = by_id(classify_quality(frame, marks, buckets=1 << 20))
    grams = {d: plain_grams(t) for d, t in docs}
    quality = {d: q for d, q, _ in labels}
    raw, seen = Counter(g for x in grams.values() for g in x), Counter(g for d, x in grams.items() if quality.get(d) == 1 for g in x)
    scale = sum(seen.values()) / sum(raw.values())
    for d, mine in grams.items():
        want = sum(math.log(seen[g] + SMOOTHING) - math.log(raw[g] * scale + SMOOTHING) for g in mine) / math.sqrt(max(len(mine), 1))
        assert got[d]["n_grams"] == len(mine) and got[d]["log_weight"] == pytest.approx(want, abs=1e-9)
    # the threshold by trying every cut
    w, g = np.array([1.0, 2.0, 2.0, 3.0, 0.5, 5.0]), np.array([False, True, False, True, True, True])
    line = _threshold(w, g)
    errors = lambda t: ((w > t) != g).sum()
    assert errors(line) == min(errors(t) for t in [-1, *(w + 0.25)])


def test_sampling_follows_the_weights(make):
    """Documents near the threshold are drawn: over many seeds as often as their weights say."""
    from panelith.llm.quality import ImportanceModel, classify_quality

    weights = np.linspace(-6, 6, 400)
    keys, sizes, k, draws = np.arange(400), np.ones(400, int), 200, 400
    taken, lines = np.zeros(400), []
    for seed in range(draws):
        places = ImportanceModel(np.zeros(1), (np.zeros(1),) * 2, 1.0, seed).perturb(keys, weights, sizes)
        order = np.argsort(-places, kind="stable")
        taken[order[:k]] += 1
        x = int(places[order[k - 1]])
        lines.append(float(np.array(x if x >= 0 else ~(x ^ -(2**63)), np.int64).view(float)))
    want = 1 - np.exp(-np.exp(weights - np.mean(lines)))
    assert np.abs(taken / draws - want).max() < 0.12
    assert ((taken > 0) & (taken < draws)).sum() > 100
    rng = random.Random(2)
    docs = [(i, " ".join(rng.choice(["bad!!", "good"][j < 20 - i // 20:][:1] or ["good"]) for j in range(20))) for i in range(400)]
    frame = make(docs)
    labels = frame.sparkSession.createDataFrame([(i, int(i < 200), 0) for i in range(0, 400, 2)], "doc_id long, quality int, toxic int")
    picks = [{d for d, r in by_id(classify_quality(frame, labels, seed=s)).items() if r["keep"]} for s in (1, 2, 1)]
    assert picks[0] == picks[2] != picks[1]


def test_languages_on_held_out_documents(spark, sf):
    sf = sf.replace("0.001", "0.01")
    truth = by_id(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"))
    rows = Q.op4_language_id(spark, sf).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]]["lang"] for r in held]) > 0.97


def test_gradients_of_the_network():
    tagger = ByteTagger.fresh(["a", "b", "c"], 4, np.random.default_rng(1))
    for side in (tagger.onward, tagger.reverse):
        side.rows, side.gates, side.candidate = (w.astype(float) for w in (side.rows, side.gates, side.candidate))
    tagger.out, tagger.bias = tagger.out.astype(float), tagger.bias.astype(float)
    x, truth = np.frombuffer(b"hello worl", np.uint8).reshape(2, 5).T, np.array([0, 2])
    _, grads = tagger.gradients(x, truth)
    for w, g in zip(tagger.weights(), grads):
        at = np.unravel_index(np.abs(g).argmax(), w.shape)
        old = w[at]
        w[at] = old + 1e-3
        up = tagger.gradients(x, truth)[0]
        w[at] = old - 1e-3
        down = tagger.gradients(x, truth)[0]
        w[at] = old
        assert (up - down) / 2e-3 == pytest.approx(g[at], rel=0.02)


def test_neighbours_recall(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    got = {}
    for r in Q.op5_nearest_neighbours(spark, sf).collect():
        got.setdefault(r["query_id"], {})[r["vec_id"]] = r["score"]
    hits = []
    for i in np.flatnonzero(ids % 20 == 0):
        scores = x @ x[i]
        scores[i] = -np.inf
        best = np.lexsort((ids, -scores))[:20]
        hits.append(len(set(ids[best]) & set(got[ids[i]])) / len(best))
        assert all(abs(s - x[np.flatnonzero(ids == v)[0]] @ x[i]) < 1e-12 for v, s in got[ids[i]].items())
    assert np.mean(hits) > 0.93


def test_tree_holds_every_point_in_its_box():
    low = np.random.default_rng(3).normal(size=(1000, 6))
    low[:300] = low[0]
    tree = Tree(low)
    assert sorted(tree.order.tolist()) == list(range(1000))
    for s, e, a, b in zip(tree.starts, tree.ends, tree.low, tree.high):
        assert (low[tree.order[s:e]] >= a).all() and (low[tree.order[s:e]] <= b).all()
    draws = np.random.default_rng(0).chisquare(10, 400_000)
    assert chi_square_quantile(10, 0.95) == pytest.approx(np.quantile(draws, 0.95), rel=0.01)


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_query_equals_sql(spark, sf, name):
    import duckdb

    from tools.check import TABLES, compare

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    assert compare(Q.QUERIES[name](spark, sf).toPandas(), con.execute(Q.SQL[name]).fetchdf()) == ""


def test_mix_comes_near_its_targets(spark, sf):
    rows = Q.op1_source_mixing(spark, sf.replace("0.001", "0.01")).toPandas()
    assert (rows.taken <= 2 * rows["size"]).all()
    for _, mine in rows.groupby("source_size"):
        assert mine.taken.sum() == pytest.approx(mine.target.iloc[0], rel=0.05)


def test_language_positions_follow_the_recurrence_byte_by_byte(monkeypatch):
    """Words of one to 700 bytes, with and without characters of several bytes, against a scalar recurrence over
    whole words; segments of 16 bytes change nothing."""
    from panelith.llm import language_id as L

    tagger = ByteTagger.fresh(["a", "b", "c"], 3, np.random.default_rng(5))
    tagger.bias += np.array([0.1, -0.05, 0.0], np.float32)

    def states(side, word):
        h, out = [0.0] * 3, []
        for byte in word:
            row = side.rows[byte]
            z = [1 / (1 + np.exp(-(row[i] + sum(h[j] * side.gates[j, i] for j in range(3))))) for i in range(3)]
            r = [1 / (1 + np.exp(-(row[3 + i] + sum(h[j] * side.gates[j, 3 + i] for j in range(3))))) for i in range(3)]
            new = [np.tanh(row[6 + i] + r[i] * sum(h[j] * side.candidate[j, i] for j in range(3))) for i in range(3)]
            h = [new[i] + z[i] * (h[i] - new[i]) for i in range(3)]
            out.append(h)
        return out

    texts = ["a bc", "\u4e2d" * 90 + "x, y" + "\u00e9" * 17, "z" * 700 + " 12 q" + "w" * 14, "", "7 8", "k" * 33 + " bc a"]
    texts = [t.encode() for t in texts]
    want, labels = np.zeros((len(texts), 3)), np.zeros((len(texts), 3), int)
    for d, text in enumerate(texts):
        for word in text.split():
            framed = b" " + word + b" "
            ahead, behind = states(tagger.onward, framed), states(tagger.reverse, framed[::-1])[::-1]
            for byte, f, g in zip(framed, ahead, behind):
                if 97 <= byte <= 122 or byte >= 128:
                    odds = np.exp(np.array(f + g) @ tagger.out + tagger.bias)
                    want[d] += odds / odds.sum()
                    labels[d, odds.argmax()] += 1
    want /= np.maximum(want.sum(axis=1, keepdims=True), 1e-12)
    for segment in (16, 256):
        monkeypatch.setattr(L, "SEGMENT", segment)
        got, counts = tagger.pooled(texts)
        assert np.allclose(got, want, atol=1e-5)
        assert (counts == labels).all()


def test_training_spans_end_between_characters():
    from panelith.llm import language_id as L

    text = ("\u4e2d" * 50 + " abc " + "\U0001f600" * 20 + "x" * 40 + " 5").encode()
    (_, starts, ends, raw), _ = L.word_rows([text])
    a, b = L.spans(starts, ends, raw)
    assert max(b - a) <= L.SPAN
    assert b"".join(raw[s:e].tobytes() for s, e in zip(a, b)).decode() == text.decode().replace(" 5", "").replace(" ", "")
    assert all(raw[s:e].tobytes().decode() for s, e in zip(a, b))
