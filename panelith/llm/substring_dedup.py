"""Substring deduplication by Rabin-Karp hashes of every fixed-length token window.

1. One pass hashes every window of ``window`` words and, per window, the smallest hash of its
   ``gram``-word pieces (its anchor). Equal windows have equal anchors, so a window whose anchor
   occurs in one text only can't be repeated, and stays out of every shuffle.
2. Spark counts anchors over one representative per word sequence; texts that hold an anchor seen in
   two documents give the hashes of the windows with that anchor.
3. Spark counts these windows (smallest and largest owner). A window whose smallest owner precedes its
   own document is repeated; the repeated windows of a document merge into maximal intervals, which go.

Exact copies of a whole word sequence need no windows: all but the smallest owner lose every word.
Windows carry 96 hash bits. Every count combines on the map side before it shuffles; joins on hashes
are plain equi-joins whose hot keys adaptive execution splits.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelith.llm.staging import Stage
from panelith.llm.wordbatch import WordBatch, chunks, mix, sliding_min, spans_hash

WINDOW, GRAM = 50, 8
#: orders documents without an id after all others
NO_ID = 2**63 - 1
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def owner(col: str = "doc_id") -> Column:
    return F.coalesce(F.col(col).cast("long"), F.lit(NO_ID))


def _slot(row: str = "row") -> Column:
    """31 bits of the row's text hash: tells rows apart that share a doc_id."""
    return F.col(row).bitwiseAND(F.lit(2**31 - 1))


def _windows(batch: WordBatch, window: int, gram: int):
    """For every window of the batch: its first word, its anchor and the word hashes."""
    h = batch.hashes()
    n = len(h)
    if n < window:
        none = np.zeros(0, np.int64)
        return none, none.view(np.uint64), h
    at = np.arange(n - gram + 1)
    grams = spans_hash(h, at, at + gram, 1)
    anchors = sliding_min(grams, window - gram + 1)
    first = np.flatnonzero(batch.doc[: n - window + 1] == batch.doc[window - 1 :])
    return first, anchors[first], h


def _survey(window: int, gram: int):
    """Per row: its words, the hash of its word sequence, the distinct anchors of its windows."""

    def run(batches):
        for rows in batches:
            texts = rows.column("body").to_pylist()
            for a, b, part in chunks(texts):
                words = WordBatch(part)
                first, anchors, _ = _windows(words, window, gram)
                owners = words.doc[first]
                bounds = np.searchsorted(owners, np.arange(b - a + 1))
                sets = [np.unique(anchors[s:e]).view(np.int64) for s, e in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays([
                    rows.column("key").slice(a, b - a), rows.column("row").slice(a, b - a),
                    pa.array(words.last - words.first, pa.int64()),
                    pa.array([hashlib.sha256(b" ".join(t.split())).hexdigest() for t in part]),
                    pa.array(sets, pa.list_(pa.int64())),
                ], names=["key", "row", "n_words", "sha", "anchors"])

    return run


def _emit(window: int, gram: int):
    """The windows whose anchor is among the row's shared ones: two hashes, owner, slot and first word."""

    def run(batches):
        for rows in batches:
            key, slot = np.asarray(rows.column("key")), np.asarray(rows.column("slot"))
            texts, shared = rows.column("body").to_pylist(), rows.column("shared")
            for a, b, part in chunks(texts):
                words = WordBatch(part)
                first, anchors, h = _windows(words, window, gram)
                owners = words.doc[first]
                bounds = np.searchsorted(owners, np.arange(b - a + 1))
                keep = np.zeros(len(first), bool)
                for i in range(b - a):
                    s, e = bounds[i], bounds[i + 1]
                    keep[s:e] = np.isin(anchors[s:e].view(np.int64), shared[a + i].values.to_numpy())
                first, owners = first[keep], owners[keep]
                yield pa.RecordBatch.from_arrays([
                    pa.array(spans_hash(h, first, first + window, 2).view(np.int64)),
                    pa.array((spans_hash(mix(h, 3), first, first + window, 4) >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                    pa.array(key[a + owners]),
                    pa.array((slot[a + owners] << 32) + first - words.first[owners]),
                ], names=["h", "check", "key", "at"])

    return run


def _cut(window: int):
    """Applies the removal intervals to the row's words."""

    def run(batches):
        for rows in batches:
            texts, hits = rows.column("body").to_pylist(), rows.column("hits")
            sizes, hashes, cuts = [], [], []
            for i, text in enumerate(texts):
                words = text.split()
                edge = np.zeros(len(words) + 1, np.int32)
                at = np.unique(hits[i].values.to_numpy())
                np.add.at(edge, at, 1)
                np.add.at(edge, at + window, -1)
                gone = np.cumsum(edge[:-1]) > 0
                turn = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                cuts.append([{"first": int(s), "end": int(e)} for s, e in zip(turn[::2], turn[1::2])])
                kept = b" ".join([words[k] for k in np.flatnonzero(~gone)])
                sizes.append(int(gone.sum()))
                hashes.append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays([
                rows.column("key"), rows.column("row"), pa.array(sizes, pa.int64()), pa.array(hashes, pa.string()),
                pa.array(cuts, pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))),
            ], names=["key", "row", "removed", "kept", "cuts"])

    return run


def dedup_substrings(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, intervals): the words that repeated windows cover.

    A window is ``window`` consecutive words of one text. A word goes if some window over it has a
    word sequence that also starts in a document with a smaller doc_id; windows are judged on the
    input. ``intervals`` are the maximal removed word ranges [first, end).

    One row per input row. Null and empty texts and texts shorter than the window lose nothing. Rows
    with equal doc_id are one document's (nothing is removed between them); a null doc_id counts as
    larger than every other. Other columns are ignored. An empty table gives no rows.
    """
    stage = Stage(docs.sparkSession, "substring")
    body = docs.select(
        owner().alias("key"), F.xxhash64("text").alias("row"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("body"),
    )
    survey = stage.write(
        body.mapInArrow(_survey(window, gram), "key long, row long, n_words long, sha string, anchors array<long>")
    )

    # one representative of every long enough word sequence: its smallest owner
    first = survey.where(F.col("n_words") >= window).groupBy("sha").agg(
        F.min("key").alias("key"), F.min_by("row", "key").alias("row")
    )
    first = stage.write(first)
    reps = survey.join(first, ["sha", "key", "row"], "left_semi").dropDuplicates(["key", "row"])
    anchors = stage.write(reps.select("key", "row", F.explode("anchors").alias("anchor")))
    # written, as below, so that the join can split an anchor or window that very many texts share
    common = stage.write(
        anchors.groupBy("anchor").agg(F.min("key").alias("low"), F.max("key").alias("high"))
        .where("low < high").select("anchor")
    )
    shared = anchors.join(common, "anchor").groupBy("key", "row").agg(F.collect_list("anchor").alias("shared"))

    # texts with a shared anchor, written once: windows are taken from them, then words are cut
    texts = stage.write(
        body.join(shared, ["key", "row"]).dropDuplicates(["key", "row"]).withColumn("slot", _slot())
    )
    stage.drop(anchors)
    windows = stage.write(
        texts.select("key", "slot", "body", "shared").mapInArrow(
            _emit(window, gram), "h long, check int, key long, at long"
        )
    )
    repeated = stage.write(
        windows.groupBy("h", "check").agg(F.min("key").alias("low"), F.max("key").alias("high"))
        .where("low < high").drop("high")
    )
    hits = (
        windows.join(repeated, ["h", "check"]).where("key > low")
        .groupBy("key", F.shiftright("at", 32).alias("slot"))
        .agg(F.collect_list(F.col("at").bitwiseAND(F.lit(2**32 - 1)).cast("int")).alias("hits"))
    )
    cut = stage.write(
        texts.select("key", "row", "slot", "body").join(hits, ["key", "slot"]).mapInArrow(
            _cut(window),
            "key long, row long, removed long, kept string, cuts array<struct<first int, end int>>",
        )
    )
    stage.drop(windows, texts)

    first = first.select("sha", F.col("key").alias("first_key"))
    whole = F.col("key") > F.col("first_key")
    rows = survey.drop("anchors").join(first, "sha", "left").join(cut, ["key", "row"], "left")
    everything = F.array(F.struct(F.lit(0).alias("first"), F.col("n_words").cast("int").alias("end")))
    none = F.array().cast("array<struct<first int, end int>>")
    return rows.select(
        F.when(F.col("key") != NO_ID, F.col("key")).alias("doc_id"),
        "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, F.lit(EMPTY_SHA)).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"),
        F.when(whole, everything).otherwise(F.coalesce("cuts", none)).alias("intervals"),
    )
