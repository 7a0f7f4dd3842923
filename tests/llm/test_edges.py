"""Every operator on odd rows and on empty tables: no crash, one defined result per row."""

import math

import numpy as np
import pytest

from panelith.llm.chat_format import chat_digest, format_chats
from panelith.llm.imatch import fingerprint_documents
from panelith.llm.language_id import fit_tagger, identify
from panelith.llm.minhash_dedup import near_duplicates
from panelith.llm.mixing import mix_documents, mix_sources
from panelith.llm.nearest import nearest_neighbours
from panelith.llm.pieces import encode_texts
from panelith.llm.pii import find_personal, personal_digest, sanitise
from panelith.llm.quality import classify_quality, filter_quality
from panelith.llm.substring_dedup import dedup_substrings
from tests.llm import brute

BY_ROW = [
    dedup_substrings, near_duplicates, fingerprint_documents, mix_sources, encode_texts, sanitise,
    lambda d: personal_digest(find_personal(d)),
    lambda d: identify(d, fit_tagger(d, per_lang=5, tokens=50, steps=3)),
]


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (11, 1, 0), (10, 0, 0), (10, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("apply", BY_ROW)
def test_one_row_for_each(apply, odd):
    assert apply(odd).count() == odd.count()


@pytest.mark.parametrize("apply", BY_ROW)
def test_empty_table(apply, odd):
    assert apply(odd.limit(0)).count() == 0


def test_quality_odd_rows(odd, labels):
    out = classify_quality(odd, labels).toPandas()
    assert len(out) == odd.count()
    assert not out[out.n_grams == 0].keep.any()
    kept = filter_quality(odd, labels)
    assert kept.columns == odd.columns
    assert kept.count() == out.keep.sum()
    assert classify_quality(odd.limit(0), labels.limit(0)).count() == 0
    # without labels nothing is known to be bad
    free = classify_quality(odd, labels.limit(0)).toPandas()
    assert free.keep.tolist() == (free.n_grams > 0).tolist()


def test_mixed_rows_keep_their_columns(odd):
    plan = mix_sources(odd).toPandas()
    mixed = mix_documents(odd)
    assert mixed.columns == odd.columns
    assert mixed.count() == plan.copies.sum()


def test_substrings_of_odd_rows(odd):
    out = dedup_substrings(odd).toPandas()
    one = out[out.doc_id == 6].iloc[0]
    assert one.n_removed == one.n_words == 30_000
    assert out[out.doc_id == 5].n_removed.iloc[0] == 0
    assert (out[out.n_words < 50].n_removed == 0).all()


def test_near_duplicates_of_odd_rows(odd):
    out = near_duplicates(odd).toPandas()
    assert set(out[out.n_shingles == 0].doc_id.dropna()) == {2, 3, 4}
    assert out[out.n_shingles == 0].kept.all()
    same = out[(out.doc_id == 1) & (out.n_shingles == 3)]
    assert same.component_id.tolist() == [-9, -9] and not same.kept.any()
    assert out[out.doc_id == 6].component_id.tolist() == [5]
    assert out[out.doc_id.isna()].component_id.isna().all()


def test_fingerprints_of_odd_rows(odd):
    out = fingerprint_documents(odd).toPandas()
    assert (out[out.doc_id == 2].n_chars == 0).all()
    assert out[out.doc_id == 5].fingerprint.iloc[0] == out[out.doc_id == 6].fingerprint.iloc[0]
    assert out[out.doc_id == 2].fingerprint.iloc[0] == out[out.doc_id == 3].fingerprint.iloc[0]
    assert out[["near_edited", "near_next"]].stack().between(0, 1).all()
    # the document after 6 is 5, with the same text
    assert out[out.doc_id == 6].near_next.iloc[0] == 1


def test_languages_of_odd_rows(odd):
    out = identify(odd, fit_tagger(odd, per_lang=5, tokens=50, steps=3)).toPandas()
    assert set(out[out.lang_pred == "und"].doc_id.dropna()) == {2, 3, 4, 10}
    assert out.score.between(0, 1).all()
    assert set(out.lang_pred) <= {"en", "de", "und"}
    nobody = identify(odd, None).toPandas()
    assert (nobody.lang_pred == "und").all()


def test_pieces_of_odd_rows(odd):
    out = encode_texts(odd).toPandas()
    assert out.exact.all()
    assert out.decoded.isna().sum() == 2


def test_sanitised_rows_keep_their_columns(odd):
    out = sanitise(odd)
    assert out.columns == odd.columns
    assert out.where("text IS NULL").count() == 2


def test_chats_of_odd_rows(spark):
    schema = "conv_id long, turn long, role string, text string, plain int, formatted int"
    rows = [
        (1, 1, "assistant", "b</s>", 0, 0), (1, 0, "user", "a [/INST] ", 0, 0), (1, 0, "user", "a [/INST] ", 0, 0),
        (1, None, None, None, 0, 0), (2, 0, "assistant", None, 0, 0), (None, 0, "a%\nb", "<\x1bs> <s>", 0, 0),
        (3, 5, "assistant", "x" * 100_000, 0, 0), (3, 5, "assistant", "[\x1b\x1b/INST]", 0, 0),
    ]
    chats = format_chats(spark.createDataFrame(rows, schema))
    got = {r["conv_id"]: r for r in chats.collect()}
    assert all(r["identical"] for r in got.values())
    assert [tuple(t) for t in got[1]["turns"]] == [("", ""), ("user", "a [/INST] "), ("user", "a [/INST] "), ("assistant", "b</s>")]
    assert [tuple(t) for t in got[None]["turns"]] == [("a%\nb", "<\x1bs> <s>")]
    digest = {r["conv_id"]: r for r in chat_digest(chats).collect()}
    assert digest[1]["turns_sha256"] == brute.sha("\n\nuser\na [/INST] \nuser\na [/INST] \nassistant\nb</s>\n")
    assert digest[1]["loss_sha256"] == brute.sha("b</s>") and digest[1]["loss_chars"] == 5
    assert digest[2]["loss_chars"] == 0 and digest[2]["n_turns"] == 1
    empty = spark.createDataFrame([], schema)
    assert chat_digest(format_chats(empty)).count() == 0


def test_vectors_of_odd_rows(spark):
    schema = "vec_id long, embedding array<float>, cell int, v string"
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=4).tolist(), 0, "") for i in range(30)]
    rows += [
        (40, None, 0, ""), (41, [0.0] * 4, 0, ""), (42, [1.0, None, 1.0, 1.0], 0, ""), (43, [1.0, math.nan, 0.0, 0.0], 0, ""),
        (44, [1.0, math.inf, 0.0, 0.0], 0, ""), (45, [], 0, ""), (46, [1.0, 2.0], 0, ""), (None, [1.0] * 4, 0, ""),
        (60, rows[3][1], 0, ""), (60, rows[3][1], 0, ""), (80, rows[3][1], 0, ""),
    ]
    vectors = spark.createDataFrame(rows, schema)
    out = nearest_neighbours(vectors, vectors.where("vec_id % 20 = 0"), k=100).toPandas()
    taking_part = {*range(30), 60, 80}
    for query in (0, 20, 60, 80):
        mine = out[out.query_id == query]
        assert set(mine.vec_id) == taking_part - {query}
        assert mine["rank"].tolist() == list(range(1, len(mine) + 1))
        assert mine.sort_values(["score", "vec_id"], ascending=[False, True]).vec_id.tolist() == mine.sort_values("rank").vec_id.tolist()
    assert set(out.query_id) == {0, 20, 60, 80}
    assert nearest_neighbours(vectors.limit(0), vectors.limit(0)).count() == 0
