"""Document fingerprints by I-Match with randomised lexicons.

The lexicon keeps the terms whose document frequency lies in a band (the same as a band of inverse
document frequency). Beside the whole of it there are randomised lexicons: one each of the ``DENSE``
densities, and ``replicas`` of each of the ``SPARSE`` ones, as powers of 1/2. Each drops the other terms for good. A document's mark for a lexicon is one hash of the
sorted list of its distinct terms that remain in it, so every one of its terms reaches the dense lexicons'
marks, and the sparse ones survive edits elsewhere in the text. The fingerprint lists the marks, none where
no term remains; the likeness of two is the share of equal marks among those that either has.

A term in at least ``low`` * N of N documents occurs in so many that there are at most (mean distinct
terms of a document) / ``low`` such terms, whatever N is. That bounds the lexicon, so it is broadcast
(beyond ``BROADCAST_TERMS`` it is joined by a shuffle).

Only built-in functions run here. The text shuffles once, to meet the opening of the next document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelith.llm.staging import Stage

LOW, HIGH, REPLICAS, DENSE, SPARSE = 0.001, 0.1, 6, (0, 1, 2, 4), (6, 7, 8, 9, 10, 11, 12, 13)
NO_MARK = "-" * 16
BROADCAST_TERMS = 2_000_000
GAP = r"[\x20\x09-\x0D]+"
#: orders documents without an id behind all others in descending order
NO_ID = -(2**63)


def words(text: Column) -> Column:
    """Distinct words of a text, maybe with an empty one at its edges."""
    return F.array_distinct(F.split(text, GAP))


def lexicon(docs: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """(term): hashes of the terms that a share between ``low`` and ``high`` of the rows holds."""
    counts = (
        docs.select(F.explode(words(F.coalesce("text", F.lit("")))).alias("word")).where("word <> ''")
        .groupBy(F.xxhash64("word").alias("term")).count()
    )
    n = docs.count()
    return counts.where(F.col("count").between(low * n, high * n)).select("term")


def lexicons(replicas: int = REPLICAS) -> list[tuple[int, int]]:
    """(replica, level): a lexicon keeps a share of 1 / 2**level of the terms."""
    return [(0, level) for level in DENSE] + [(r, level) for r in range(1, replicas + 1) for level in SPARSE]


def set_hashes(rows: DataFrame, keys: list[str], replicas: int = REPLICAS) -> DataFrame:
    """Per ``keys`` the array ``marks``: for each lexicon a hash of the sorted terms that remain, null for none.

    rows: (keys, term), terms distinct within the keys, a null term for none. A replica's lexicons are
    nested: a term stays as long as the leading bits of its hash for the replica are zero, so each is
    filtered from the one before. The terms of a text are one list, bounded by the text.
    """
    sets = rows.groupBy(*keys).agg(F.sort_array(F.collect_list("term")).alias("_all"))

    def stays(r: int, level: int):
        return lambda term: F.shiftrightunsigned(F.xxhash64(term, F.lit(r)), 64 - level) == 0

    chains: dict[int, list[str]] = {}
    depth: dict[int, dict[str, Column]] = {}
    for r, level in lexicons(replicas):
        if level:
            chain = chains.setdefault(r, ["_all"])
            depth.setdefault(len(chain), {})[f"_x{r}_{level}"] = F.filter(chain[-1], stays(r, level))
            chain.append(f"_x{r}_{level}")
    for columns in depth.values():
        sets = sets.withColumns(columns)
    names = [f"_x{r}_{level}" if level else "_all" for r, level in lexicons(replicas)]
    marks = [F.when(F.size(n) > 0, F.xxhash64(n)) for n in names]
    return sets.select(*keys, F.array(*marks).alias("marks"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal marks among those that either fingerprint has; 0 for fingerprints of unequal length."""
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same))
    either = F.size(F.filter(F.zip_with(a, b, lambda x, y: F.coalesce(x, y)), lambda x: x.isNotNull()))
    return F.when((F.size(a) == F.size(b)) & (either > 0), equal / either).otherwise(F.lit(0.0))


def _next_rows(stage: Stage, ids: DataFrame) -> DataFrame:
    """(key, row) with next_key, next_row in descending order, the first after the last.

    Rows are ranged over partitions; each partition's last row meets the first one of the next
    non-empty partition, out of a table with one row per partition.
    """
    order = [F.desc("key"), F.asc("row")]
    n = int(stage.spark.conf.get("spark.sql.shuffle.partitions"))
    placed = stage.write(ids.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id()))
    inside = Window.partitionBy("part").orderBy(*order)
    ahead = F.lead(F.struct("key", "row")).over(inside)
    placed2 = stage.write(placed.withColumn("ahead", ahead))
    heads = placed.groupBy("part").agg(F.min_by(F.struct("key", "row"), F.struct(-(F.col("key") + 1), "row")).alias("head"))
    by_part = Window.orderBy("part")
    whole = by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    wrapped = F.coalesce(F.lead("head").over(by_part), F.first("head").over(whole))
    heads = F.broadcast(heads.withColumn("wrapped", wrapped).select("part", "wrapped"))  # one row per partition
    after = F.coalesce("ahead", "wrapped")
    linked = placed2.join(heads, "part").select(
        "key", "row", "n", "copies", after["key"].alias("next_key"), after["row"].alias("next_row")
    )
    out = stage.write(linked)
    stage.drop(placed, placed2)
    return out


def fingerprint_documents(
    docs: DataFrame, low: float = LOW, high: float = HIGH, replicas: int = REPLICAS
) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The edited text is the text with its last floor(n_chars / 3) code points replaced by the first as
    many (or all) of the next document: by descending doc_id, rows without an id last, equal ids by a
    hash of their text, and the first after the last. A null text counts as empty. A text without a
    lexicon term has one hash of its whole text as its fingerprint. Equal texts have equal fingerprints.
    One row per input row; rows equal in doc_id and text count once in that order. Other columns are
    ignored. An empty table gives no rows.
    """
    spark = docs.sparkSession
    stage = Stage(spark, "imatch")
    known = stage.write(lexicon(docs, low, high))
    if known.count() <= BROADCAST_TERMS:
        known = F.broadcast(known)

    texts = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("key"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("row", F.xxhash64("text"))
    ids = texts.groupBy("key", "row").agg(F.first(F.char_length("text")).alias("n"), F.count("*").alias("copies"))
    links = _next_rows(stage, ids)
    repeated = not links.where("copies > 1").isEmpty()
    if repeated:
        texts = texts.dropDuplicates(["key", "row"])

    # each row asks the next document for its opening
    need = F.floor(F.col("n") / 3).cast("int")
    asks = links.select(
        F.col("next_key").alias("key"), F.col("next_row").alias("row"), F.col("key").alias("for_key"),
        F.col("row").alias("for_row"), need.alias("need"), "n",
    )
    opening = F.substring("text", F.lit(1), F.col("need")).alias("opening")
    openings = asks.join(texts, ["key", "row"]).select(
        F.col("for_key").alias("key"), F.col("for_row").alias("row"), "n", "need", opening
    )
    edited = F.concat(F.substring("text", F.lit(1), F.col("n") - F.col("need")), F.col("opening"))
    both = texts.join(openings, ["key", "row"]).select("key", "row", "n", "text", edited.alias("edited"))

    # every side has an empty word of its own, so that sides without any term are there too
    both = both.select(
        "key", "row", "n", F.sha2("edited", 256).alias("edited_sha256"), F.xxhash64("edited").alias("edited_row"),
        F.posexplode(F.array(words(F.col("text")), words(F.col("edited")))).alias("side", "words"),
    )
    keys = ["key", "row", "n", "edited_sha256", "edited_row", "side"]
    spread = both.select(*keys, F.explode(F.array_union("words", F.array(F.lit("")))).alias("word"))
    spread = spread.select(*keys, F.when(F.col("word") != "", F.xxhash64("word")).alias("term"))
    kept = spread.join(known.withColumn("known", F.lit(True)), "term", "left").where("known OR term IS NULL")
    sides = set_hashes(kept, keys, replicas)

    def side(number: int, whole: str) -> Column:
        mine = F.first(F.when(F.col("side") == number, F.col("marks")), ignorenulls=True)
        return F.when(mine[0].isNull(), F.array(F.col(whole))).otherwise(mine)

    marked = stage.write(
        sides.groupBy(*keys[:-1]).agg(side(0, "row").alias("marks"), side(1, "edited_row").alias("edited_marks"))
        .drop("edited_row")
    )
    following = marked.select(F.col("key").alias("next_key"), F.col("row").alias("next_row"), F.col("marks").alias("next_marks"))
    rows = marked.join(links.drop("n"), ["key", "row"]).join(following, ["next_key", "next_row"])
    if repeated:
        rows = rows.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("copies"))))

    def text_of(marks: str) -> Column:
        return F.array_join(F.transform(marks, lambda h: F.coalesce(F.lpad(F.lower(F.hex(h)), 16, "0"), F.lit(NO_MARK))), "")

    return rows.select(
        F.when(F.col("key") != NO_ID, F.col("key")).alias("doc_id"), F.col("n").cast("long").alias("n_chars"), "edited_sha256",
        text_of("marks").alias("fingerprint"), text_of("edited_marks").alias("edited_fingerprint"),
        likeness(F.col("marks"), F.col("edited_marks")).alias("near_edited"),
        likeness(F.col("marks"), F.col("next_marks")).alias("near_next"),
    )
