"""Personal data: pattern spans, and terms that disclose them.

Base spans are e-mail addresses, IP addresses, card numbers and telephone numbers. Each distinct base
value is a protected entity e; the words of the texts that hold it are its candidates. Two estimates tell
what a word t reveals of it, and neither takes a single meeting for evidence:

* Entities of ``MEETINGS`` texts or more, by the pair itself. PMI(t; e) = log p(t, e) / (p(t) p(e)), p over distinct texts,
  is at most IC(e) = -log p(e); their ratio is the disclosure. The pair counts if chance would not bring any
  of the candidate words that often to the entity's texts (hypergeometric probability times the number of
  candidates at most ``chance``), in at least ``MEETINGS`` different surroundings and mostly different ones:
  near copies of one text are one meeting. From ``generalise`` on, the word becomes a placeholder of its category; from ``remove`` on (it hardly
  occurs without the entity) it goes.
* All entities, by pooling. A word that stands within ``NEAR`` words of a value belongs to the pool of its
  kind, side and distance. Pools whose words are exclusive (not more frequent than the entity) far more
  often than the words elsewhere in the same texts hold disclosing terms: by the confidence bounds of
  both shares, at least ``precision`` of the exclusive words there are not explained by chance. They are
  generalised. Rare words elsewhere, or beside values without such a pattern, stay.

Every occurrence of a flagged word in the texts that hold the entity is masked. All counts are of distinct
texts, so copies of a text change nothing, and no bound depends on the size of the corpus.

Only built-in functions run here. Patterns are written so that they scan in linear time: a run of
letters or digits is entered at its start only, or where the last match ended. Texts without personal
data are shuffled only if more than ``BROADCAST_TERMS`` texts have copies.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelith.llm.staging import Stage, free_names

KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
IP_PART = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{0,2})(?<=[0-9])"
CATEGORIES = ("name", "number", "word")
PLACEHOLDER = {**{k: f"[{k.upper()}]" for k in (*KINDS, *CATEGORIES)}, "gone": ""}
GENERALISE, REMOVE, CHANCE, PRECISION = 0.6, 0.95, 0.01, 0.8
#: words beside a value that pools look at; deviations of the confidence bounds
NEAR, DEVIATIONS = 3, 3.0
MEETINGS = 3
#: more flagged terms or copied texts than this are joined by a shuffle
BROADCAST_TERMS = 500_000
SPAN = "array<struct<kind string, start int, end int, value string>>"


def text_key(text: Column) -> Column:
    """128 bits that stand for a text."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digit string passes the Luhn check."""

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.char_length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.char_length(digits) - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(rf"^{IP_PART}(?:\.{IP_PART}){{3}}$")
    if kind == "card":
        return _let(_digits(match), lambda d: F.when(F.char_length(d).between(16, 19), luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.char_length(_digits(match)).between(8, 15)
    return F.lit(True)


def spans_of(kind: str, text: Column) -> Column:
    """Valid matches of a kind: leftmost, not overlapping, failing ones dropped without a retry."""
    pattern, none = PATTERNS[kind], F.array().cast(SPAN)
    marker = {"email": text.contains("@"), "phone": text.contains("+")}.get(kind, text.rlike("[0-9]"))

    def placed(found: Column) -> Column:
        between = F.split(text, pattern, -1)
        # gap, match, gap, match, ...: the walk keeps the matches
        pieces = F.flatten(F.zip_with(
            between, found, lambda gap, match: F.array(
                F.struct(gap.alias("text"), F.lit(False).alias("hit")),
                F.struct(F.coalesce(match, F.lit("")).alias("text"), match.isNotNull().alias("hit")),
            )
        ))

        def step(have: Column, p: Column) -> Column:
            end = have["at"] + F.char_length(p["text"])
            entry = F.struct(F.lit(kind).alias("kind"), have["at"].alias("start"), end.alias("end"), p["text"].alias("value"))
            out = F.when(p["hit"] & _valid(kind, p["text"]), F.concat(have["out"], F.array(entry))).otherwise(have["out"])
            return F.struct(end.alias("at"), out.alias("out"))

        start = F.struct(F.lit(0).alias("at"), none.alias("out"))
        return F.aggregate(pieces, start, step, lambda have: have["out"])

    return F.when(marker, _let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.when(F.size(m) > 0, placed(m)).otherwise(none)
    )).otherwise(none)


def base_spans(text: Column) -> Column:
    """All base spans, by kind in the order of ``KINDS``, then by start."""
    return F.concat(*[spans_of(k, text) for k in KINDS])


def entity(span: Column) -> Column:
    """The protected value, whatever its punctuation and case."""
    value = F.when(span["kind"].isin("card", "phone"), _digits(span["value"])).otherwise(F.lower(span["value"]))
    return F.concat(span["kind"], F.lit(":"), value)


def _words(one: DataFrame) -> DataFrame:
    """(row, word, start, end, around, near) of the words that touch no base span, from one line per text.

    ``around`` is a hash of the two words on each side; ``near`` the nearest value: kind, entity, side, distance in
    words. Windows hold the words of one text.
    """
    pieces = F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]++|[^\x20\x09-\x0D]++"), F.lit(0))
    text = Window.partitionBy("row").orderBy("pos")
    placed = (
        one.select("row", F.posexplode(pieces).alias("pos", "word")).withColumn("size", F.char_length("word"))
        .withColumn("end", F.sum("size").over(text.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("int"))
        .where(F.col("word").rlike(r"^[^\x20\x09-\x0D]"))
        .select("row", "pos", "word", (F.col("end") - F.col("size")).alias("start"), "end")
        .join(one.select("row", "base"), "row")
    )
    touched = F.filter("base", lambda s: (s["start"] < F.col("end")) & (F.col("start") < s["end"]))
    hit = F.get(touched, F.lit(0))
    placed = placed.withColumn("at", F.row_number().over(text)).withColumn(
        "value", F.when(hit.isNotNull(), F.struct("at", hit["kind"].alias("kind"), entity(hit).alias("entity")))
    ).drop("base")
    back = Window.partitionBy("row").orderBy(F.desc("pos"))
    upto = (Window.unboundedPreceding, Window.currentRow)
    placed = placed.withColumns({
        "left": F.last("value", ignorenulls=True).over(text.rowsBetween(*upto)),
        "around": F.xxhash64(*[F.lag("word", k).over(text) for k in (2, 1, -1, -2)]),
    }).withColumn("right", F.last("value", ignorenulls=True).over(back.rowsBetween(*upto)))

    def side(value: str, name: str, gap: Column) -> Column:
        found = F.struct(gap.alias("distance"), F.lit(name).alias("side"), F.col(f"{value}.kind").alias("kind"), F.col(f"{value}.entity").alias("entity"))
        return F.when(F.col(value).isNotNull(), found)

    # a word after a value has it on its left
    near = F.least(
        side("left", "after", F.col("at") - F.col("left.at")), side("right", "before", F.col("right.at") - F.col("at"))
    )
    return placed.where("value IS NULL").select("row", "word", "start", "end", "around", near.alias("near"))


def _log_factorial(n: Column) -> Column:
    """Stirling's series; exact to some 1e-3 from n = 1 on."""
    n = n.cast("double")
    return F.when(n < 1, 0.0).otherwise(n * F.log(n) - n + 0.5 * F.log(2 * F.pi() * n) + 1 / (12 * n))


def _log_chance(both: Column, n_t: Column, n_e: Column, total: float) -> Column:
    """Log probability that a word of n_t texts meets an entity of n_e texts in exactly ``both`` of them."""

    def choose(n: Column, k: Column) -> Column:
        return _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k)

    return choose(n_e, both) + choose(F.lit(total) - n_e, n_t - both) - choose(F.lit(total), n_t)


def bound(share: float, n: int, deviations: float) -> float:
    """Wilson's confidence bound of a share among n: the upper one for positive deviations, the lower else."""
    if not n:
        return 1.0 if deviations > 0 else 0.0
    z2 = deviations * deviations
    half = deviations * math.sqrt(share * (1 - share) / n + z2 / (4 * n * n))
    return (share + z2 / (2 * n) + half) / (1 + z2 / n)


def disclosing_pools(counts: list, precision: float) -> list[tuple[str, str, int]]:
    """(kind, side, distance) of the pools whose exclusive words chance does not explain. counts: rows of kind,
    side, distance (NULL: elsewhere), words, exclusive."""
    n0, x0 = (sum(r[c] for r in counts if r["distance"] is None) for c in ("words", "exclusive"))
    by_chance = bound(x0 / max(n0, 1), n0, DEVIATIONS)
    found = []
    for r in counts:
        if r["distance"] is not None:
            low = bound(r["exclusive"] / r["words"], r["words"], -DEVIATIONS)
            if low > 0 and 1 - by_chance / low >= precision:
                found.append((r["kind"], r["side"], r["distance"]))
    return found


def category(word: Column) -> Column:
    """What a term is generalised to."""
    return F.when(word.rlike("[0-9]"), "number").when(word.rlike(r"^\P{L}*\p{Lu}"), "name").otherwise("word")


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_TERMS else df


def find_personal(
    docs: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE, chance: float = CHANCE, precision: float = PRECISION
) -> DataFrame:
    """(doc_id, row, base, terms): base spans, and the disclosing terms that the corpus adds.

    ``row`` is a hash of the text (null: empty); equal rows have equal results. ``base`` holds kind, start,
    end (code points, end exclusive) and value; ``terms`` the same, the kind being the category that a term is
    generalised to, or gone (removed). One row per input row; other columns are ignored. An empty table
    gives no rows.
    """
    spark = docs.sparkSession
    stage = Stage(spark, "pii")
    plain = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    text = F.col("text")
    held = stage.write(
        plain.withColumn("base", base_spans(text)).select(
            "doc_id", text_key(text).alias("row"), "base", F.when(F.size("base") > 0, text).alias("text")
        )
    )
    one = stage.write(held.where("text IS NOT NULL").select("row", "base", "text").dropDuplicates(["row"]))
    places = stage.write(_words(one))
    owners = one.select("row", F.explode(F.array_distinct(F.transform("base", entity))).alias("entity"))
    entities = stage.write(owners.groupBy("entity").agg(F.count("*").alias("n_e")))
    # a text counts once: each of its copies has its share of one
    copies = stage.write(held.groupBy("row").agg(F.count("*").alias("copies")).where("copies > 1"))
    words = F.array_distinct(F.split(text, r"[\x20\x09-\x0D]+"))
    each = F.coalesce(1 / F.col("copies"), F.lit(1.0))
    counts = stage.write(
        plain.withColumn("row", text_key(text)).join(_small(copies), "row", "left")
        .select(F.explode(words).alias("word"), each.alias("each"))
        .groupBy("word").agg(F.round(F.sum("each")).cast("long").alias("n_t"))
        .join(places.select("word").distinct(), "word", "left_semi")
    )
    total = float(max(held.select("row").distinct().count(), 1))
    candidates = float(max(counts.count(), 1))

    # entities of several texts
    information = F.log(F.lit(total) / F.col("n_e"))
    share = F.when(information > 0, F.log(F.lit(total) * F.col("n_et") / (F.col("n_t") * F.col("n_e"))) / information).otherwise(0.0)
    pairs = stage.write(
        places.groupBy("row", "word").agg(F.min("around").alias("around"))
        .join(owners.join(entities.where(F.col("n_e") >= MEETINGS), "entity"), "row").join(counts.where(F.col("n_t") >= MEETINGS), "word")
        .groupBy("entity", "word", "n_e", "n_t").agg(F.count("*").alias("n_et"), F.countDistinct("around").alias("surroundings"))
        .withColumn("share", share).where((F.col("share") >= generalise) & (F.col("surroundings") >= MEETINGS) & (2 * F.col("surroundings") > F.col("n_et")))
        .where(_log_chance(F.col("n_et"), F.col("n_t"), F.col("n_e"), total) + math.log(candidates) <= math.log(chance))
    )
    kind = F.when(F.col("share") >= remove, F.lit("gone")).otherwise(category(F.col("word")))
    direct = owners.join(_small(pairs.select("entity", "word", kind.alias("kind"))), "entity").select("row", "word", "kind")

    # what stands beside values
    beside = F.when(F.col("near.distance") <= NEAR, F.col("near"))
    rare = (
        places.where("near IS NOT NULL").join(counts, "word").join(entities, F.col("near.entity") == entities["entity"])
        .select("row", "word", "near.entity", beside["kind"].alias("kind"), beside["side"].alias("side"),
                beside["distance"].alias("distance"), (F.col("n_t") <= F.col("n_e")).alias("exclusive"))
    )
    rare = stage.write(rare)
    seen = rare.groupBy("entity", "word", "kind", "side", "distance").agg(F.max("exclusive").alias("exclusive"))
    # at most kinds x sides x distances rows, and one for elsewhere
    pools = disclosing_pools(
        seen.groupBy("kind", "side", "distance").agg(F.count("*").alias("words"), F.sum(F.col("exclusive").cast("int")).alias("exclusive")).collect(),
        precision,
    )
    inside = F.lit(False)
    for k, side, distance in pools:
        inside = inside | ((F.col("kind") == k) & (F.col("side") == side) & (F.col("distance") == distance))
    pooled = rare.where(F.col("exclusive") & inside).select("row", "word", category(F.col("word")).alias("kind"))

    # a word that any estimate removes goes
    gone = (F.col("kind") == "gone").cast("int")
    kinds = direct.unionByName(pooled).groupBy("row", "word").agg(F.max_by("kind", gone).alias("kind"))
    terms = stage.write(
        places.join(kinds, ["row", "word"])
        .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end", "word", "kind"))).alias("found"))
        .select("row", F.transform("found", lambda w: F.struct(
            w["kind"].alias("kind"), w["start"].alias("start"), w["end"].alias("end"), w["word"].alias("value")
        )).alias("terms"))
    )
    bare = held.where("text IS NULL").select("doc_id", "row", "base", F.array().cast(SPAN).alias("terms"))
    rich = held.where("text IS NOT NULL").drop("text").join(terms, "row", "left").select(
        "doc_id", "row", "base", F.coalesce("terms", F.array().cast(SPAN)).alias("terms")
    )
    return bare.unionByName(rich)


def _joined(spans: Column, kind: Callable[[Column], Column] = lambda s: s["kind"]) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kind(s), s["start"], s["end"])), ",")


def personal_digest(found: DataFrame) -> DataFrame:
    """Counts per kind and the spans as text; added spans are all of kind term."""

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in KINDS]
    term = F.lit("term")
    return found.select(
        "doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        F.concat_ws(
            ",", F.when(F.size("base") > 0, _joined(F.col("base"))),
            F.when(F.size("terms") > 0, _joined(F.col("terms"), lambda s: term)),
        ).alias("spans"),
    )


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its placeholder; overlapping spans become one, the first's."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")
    )))
    labels = F.create_map(*[F.lit(x) for kv in PLACEHOLDER.items() for x in kv])
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(have: Column, s: Column) -> Column:
        gap = F.substring(text, have["at"] + 1, s["start"] - have["at"])
        fresh = s["start"] >= have["at"]
        out = F.when(fresh, F.concat(have["out"], F.array(gap, labels[s["kind"]]))).otherwise(have["out"])
        return F.struct(F.greatest(have["at"], s["end"]).alias("at"), out.alias("out"))

    return F.aggregate(ordered, start, step, lambda have: F.concat(
        F.array_join(have["out"], ""), F.substring(text, have["at"] + 1, F.char_length(text))
    ))


def sanitise(docs: DataFrame, **thresholds) -> DataFrame:
    """``docs`` with personal data masked in ``text`` (and n_chars, if there is such a column, brought up to date).

    Rows without personal data pass unchanged; a null text stays null. Every row and column is kept.
    """
    key, spans, has = free_names(docs, "__row", "__spans", "__hit")
    found = find_personal(docs, **thresholds).where("size(base) > 0").dropDuplicates(["row"]).select(
        F.col("row").alias(key), F.concat("base", "terms").alias(spans)
    )
    own = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.withColumn(has, F.coalesce(F.size(base_spans(F.col("text"))) > 0, F.lit(False)))
    hit = rows.where(F.col(has)).withColumn(key, text_key(F.col("text"))).join(found, key, "left")
    hit = hit.withColumn("text", masked(F.col("text"), F.col(spans)))
    if "n_chars" in docs.columns:
        hit = hit.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return rows.where(~F.col(has)).select(*own).unionByName(hit.select(*own))
