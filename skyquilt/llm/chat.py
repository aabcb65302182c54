"""Chat formatting over typed content parts, in DataFrame functions only.

A turn's content is a list of parts (type, text, ref, n_tokens). A visitor over the list flattens it: text
parts are escaped and joined, image, audio and document parts become placeholders in order, and each
attachment's reference and expanded token count is recorded. The k-th placeholder of a conversation stands
for its k-th attachment.

A conversation is one output record, so its turns meet in one row; the grouping key is the conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Markers of the template: (role, before its text, after its text). Any other role goes into OTHER.
TEMPLATE = (("system", "<<SYS>>", "<</SYS>>"), ("user", "[INST]", "[/INST]"), ("assistant", "<s>", "</s>"))
OTHER = ("<|role:", "|>", "<|end|>")
ATTACHMENTS = ("image", "audio", "document")
LOSS_ROLE = "assistant"
PART = "type string, text string, ref string, n_tokens long"

#: The first character of each control string, where the rest of it follows.
_CONTROL = r"<(?=s>|/s>|<SYS>>|</SYS>>|\|)|\[(?=INST\]|/INST\])|\|(?=>)"
_TURN = r"(?s)(<<SYS>>|\[INST\]|<s>|<\|role:.*?\|>)(.*?)(<</SYS>>|\[/INST\]|</s>|<\|end\|>)"


def escape(text: Column) -> Column:
    """Doubles each backslash, then puts one behind the first character of each control string."""
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), _CONTROL, r"$0\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def _marks(role: Column) -> tuple[Column, Column]:
    before, after = F.concat(F.lit(OTHER[0]), escape(role), F.lit(OTHER[1])), F.lit(OTHER[2])
    for name, left, right in TEMPLATE:
        before, after = F.when(role == name, F.lit(left)).otherwise(before), F.when(role == name, F.lit(right)).otherwise(after)
    return before, after


def _visit(part: Column) -> Column:
    """A part's share of the formatted text."""
    shown = escape(F.coalesce(part["text"], F.lit("")))
    for kind in ATTACHMENTS:
        shown = F.when(part["type"] == kind, F.lit(f"<|{kind}|>")).otherwise(shown)
    return shown


def text_parts(turns: DataFrame, text: str = "text") -> DataFrame:
    """Turns whose content is the one text part in column ``text``."""
    kind = f"array<struct<{PART.replace(' string', ':string').replace(' long', ':long')}>>"
    part = F.struct(F.lit("text").alias("type"), F.col(text).alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("long").alias("n_tokens"))
    return turns.select("conv_id", "turn", "role", F.array(part).cast(kind).alias("content"))


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans, attachments, n_attachment_tokens.

    ``turns`` has conv_id, turn, role and content (array of PART); other columns are ignored. Turns go by
    ``turn``, ties by role and then text; repeated rows stay. A null role is the empty role, null content or
    null text is empty, a null conv_id is a conversation of its own, and a null part is left out. A part that
    isn't an attachment is text. An attachment without a count stands for one token. ``loss_spans`` are
    (start, length) in code points of ``formatted`` under the loss. No turns give no rows.
    """
    whole = F.filter(F.coalesce("content", F.array().cast(turns.schema["content"].dataType)), lambda p: p.isNotNull())
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), whole.alias("parts"))
    held = F.transform(
        F.filter("parts", lambda p: p["type"].isin(*ATTACHMENTS)),
        lambda p: F.struct(p["type"].alias("type"), p["ref"].alias("ref"), F.coalesce(p["n_tokens"], F.lit(1)).alias("n_tokens")),
    )
    before, after = _marks(F.col("role"))
    rows = rows.select("conv_id", "turn", "role", before.alias("before"), F.array_join(F.transform("parts", _visit), "").alias("body"), after.alias("after"), held.alias("held"))
    size = F.length("before") + F.length("body") + F.length("after")
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "body").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("at", F.coalesce(F.sum(size.cast("long")).over(order), F.lit(0)))
    one = F.struct("at", "role", "before", "body", "after", "held")
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("t"))
    spans = F.transform(
        F.filter("t", lambda x: x["role"] == LOSS_ROLE),
        lambda x: F.struct((x["at"] + F.length(x["before"])).alias("start"), F.length(x["body"]).cast("long").alias("length")),
    )
    joined = F.array_join(F.transform("t", lambda x: F.concat(x["before"], x["body"], x["after"])), "")
    chats = chats.select("conv_id", joined.alias("formatted"), spans.alias("loss_spans"), F.flatten(F.transform("t", lambda x: x["held"])).alias("attachments"))
    tokens = F.aggregate("attachments", F.lit(0).cast("long"), lambda s, x: s + x["n_tokens"])
    return chats.withColumn("n_attachment_tokens", tokens)


def read_chats(chats: DataFrame) -> DataFrame:
    """Reads ``formatted`` back: adds turns (array of role, text) and loss_text, the unescaped text under the mask."""
    marks, texts = (F.regexp_extract_all("formatted", F.lit(_TURN), F.lit(k)) for k in (1, 2))

    def role_of(mark: Column) -> Column:
        inner = F.expr(f"length('{OTHER[0]}{OTHER[1]}')")
        role = unescape(F.substring(mark, F.lit(len(OTHER[0]) + 1), F.length(mark) - inner))
        for name, left, _ in TEMPLATE:
            role = F.when(mark == left, F.lit(name)).otherwise(role)
        return role

    turns = F.zip_with(marks, texts, lambda m, t: F.struct(role_of(m).alias("role"), unescape(t).alias("text")))
    under = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return chats.withColumns({"turns": turns, "loss_text": F.array_join(under, "")})


def chat_digest(conversations: DataFrame) -> DataFrame:
    """The digest of ``op10_chat_format``, read back from the formatted text."""
    spark = conversations.sparkSession
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(1).select(F.explode(F.array(*(F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(k).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(said).alias("text")) for k, r in enumerate(("user", "assistant"))))).alias("x")).select("x.*")
    back = read_chats(format_chats(text_parts(conversations.select("conv_id", "turn", "role", "text").unionByName(extra))))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def _count(what: str) -> str:
    return f"(length(t) - length(replace(t, '{what}', ''))) // {len(what)}"


#: An escaped text is longer by one for each backslash and each control string.
ORACLE = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
m AS (SELECT *, length(t) + {' + '.join(map(_count, (chr(92), '<s>', '</s>', '[INST]', '[/INST]', '<<SYS>>', '<</SYS>>', '<|', '|>')))}
        + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 ELSE 16 + length(role) END AS n FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn, role, t)) AS turns_sha256,
       coalesce(sum(length(t)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(t, '' ORDER BY turn, role, t) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(n)::BIGINT AS formatted_chars
FROM m GROUP BY conv_id
"""
