"""Chat formatting by a grammar round trip.

    conversation := turn*
    turn         := "<s>[INST] " role "\\n" text " [/INST]"     any role but assistant
                  | "<s>[ANS] " text "</s>"                    the assistant

Each turn is rendered as it is and read back by a deterministic parser (the first closing mark ends a
turn). A turn that does not come back identical holds conflicting content, and so does one whose text holds
any control string, whether this parser trips over it or not; it is escaped and read back again. Escaping puts one more ESC character behind the first character of every control string, with
any number of ESC characters already there; the parser takes one away. That maps texts one to one onto
texts without control strings, so one round always suffices, and the final parse of the whole
conversation is compared with the source once more (``identical``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ANSWERS = "assistant"
ASK, ASK_END, ANSWER, ANSWER_END = "<s>[INST] ", " [/INST]", "<s>[ANS] ", "</s>"
TURN = r"(?s)<s>(?:\[INST\] .*?\n.*? \[/INST\]|\[ANS\] .*?</s>)"
TAILS = r"(/?s>|/?INST\]|ANS\])"
CONTROL, ESCAPED = rf"([<\[])(\x1B*){TAILS}", rf"([<\[])\x1B(\x1B*){TAILS}"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, "$1\x1b$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def _role_out(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def _role_in(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def render(role: Column, text: Column) -> Column:
    return F.when(role == ANSWERS, F.concat(F.lit(ANSWER), text, F.lit(ANSWER_END))).otherwise(
        F.concat(F.lit(ASK), _role_out(role), F.lit("\n"), text, F.lit(ASK_END))
    )


def _inside(turn: Column, lead: Column, end: str) -> Column:
    return F.substring(turn, lead + 1, F.char_length(turn) - lead - len(end))


def parse(formatted: Column) -> Column:
    """array<struct<role, text>> of the turns; text outside the grammar gives a turn with null role."""

    def turn(t: Column) -> Column:
        role = F.substring_index(F.substring(t, len(ASK) + 1, F.char_length(t)), "\n", 1)
        asked = F.struct(
            _role_in(role).alias("role"),
            unescape(_inside(t, F.char_length(role) + len(ASK) + 1, ASK_END)).alias("text"),
        )
        answered = F.struct(
            F.lit(ANSWERS).alias("role"), unescape(_inside(t, F.lit(len(ANSWER)), ANSWER_END)).alias("text")
        )
        return F.when(t.startswith(ANSWER), answered).otherwise(asked)

    found = F.regexp_extract_all(formatted, F.lit(TURN), F.lit(0))
    stray = F.array(F.struct(F.lit(None).cast("string").alias("role"), formatted.alias("text")))
    return F.when(F.array_join(found, "") == formatted, F.transform(found, turn)).otherwise(stray)


def format_chats(conversations: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns, loss_spans, n_escaped, identical): one row per conversation.

    Turns stand in the order of turn, then role, then text (nulls first; repeated rows stay). Null role
    and null text count as empty. Rows with a null conv_id form one conversation. ``turns`` is parsed
    from ``formatted``; ``loss_spans`` are the assistant's texts there, as code points [start, end).
    Other columns are ignored. An empty table gives no rows. A conversation is one output row, so its
    turns must fit a task.
    """
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    source = F.struct("role", "text")
    rows = rows.withColumn("plain", render(F.col("role"), F.col("text")))
    fits = (parse(F.col("plain")) == F.array(source)) & ~F.col("text").rlike(CONTROL)
    rows = rows.withColumn("fits", fits).select(
        "conv_id", "turn", "role", "text", "fits",
        F.when(F.col("fits"), F.col("plain")).otherwise(render(F.col("role"), escape(F.col("text")))).alias("rendered"),
    )
    chats = rows.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text", "fits", "rendered"))).alias("source")
    )
    formatted = F.array_join(F.transform("source", lambda t: t["rendered"]), "")
    chats = chats.withColumn("formatted", formatted)
    span = F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"))
    start = F.struct(F.lit(0).alias("at"), F.array(span).cast("array<struct<start int, end int>>").alias("spans"))

    def step(have: Column, t: Column) -> Column:
        end = have["at"] + F.char_length(t["rendered"])
        mine = F.struct((have["at"] + len(ANSWER)).alias("start"), (end - len(ANSWER_END)).alias("end"))
        spans = F.when(t["role"] == ANSWERS, F.concat(have["spans"], F.array(mine))).otherwise(have["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    spans = F.aggregate("source", start, step, lambda have: F.slice(have["spans"], 2, F.size(have["spans"])))
    turns = parse(F.col("formatted"))
    return chats.select(
        "conv_id", "formatted", turns.alias("turns"), spans.alias("loss_spans"),
        F.size(F.filter("source", lambda t: ~t["fits"])).alias("n_escaped"),
        (turns == F.transform("source", lambda t: F.struct(t["role"], t["text"]))).alias("identical"),
    )


def chat_digest(chats: DataFrame) -> DataFrame:
    """Counts and digests read back from formatted conversations."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(
        F.transform(
            "loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"]))
        ), "",
    )
    return chats.withColumn("loss", loss).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


#: conversation -7 of the query, the same for DuckDB
CONFLICT = "</s>[INST] ok [/INST]"
_TAILS = TAILS.replace("\\]", "\\]")
CHAT_SQL = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '{CONFLICT}'), (-7, 1, '{ANSWERS}', '{CONFLICT}')),
e AS (SELECT *, len(regexp_extract_all(text, '[<\\[]\\x1B*{_TAILS}')) AS escapes FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = '{ANSWERS}' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = '{ANSWERS}'), '')) AS loss_sha256,
  CAST(sum(length(text) + escapes + CASE WHEN role = '{ANSWERS}' THEN {len(ANSWER) + len(ANSWER_END)}
    ELSE {len(ASK) + 1 + len(ASK_END)} + length(replace(replace(role, '%', '%25'), chr(10), '%0A')) END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""
