"""Chat formatting with a grammar round trip, in DataFrame functions only.

    conversation := turn*
    turn         := "### " role ":\\n" text "\\n</turn>\\n"

``### `` and ``</turn>`` are control strings. A text is first rendered as it is
and the result reparsed; a turn whose recovered content differs from the
source, or that the grammar refuses (a bare control string inside), is escaped: one
more backslash before every run of backslashes that stands before a control string,
and reparsed once more. The parser takes one such backslash away, so every text comes back.
A real marker always follows a newline, never a backslash of the text.

Defined cases: null text and null role are empty; line breaks and backslashes
in roles are escaped as ``\\n`` and ``\\\\``; turns of equal number are ordered by
role, then text, and kept; null turn numbers come first; a null ``conv_id`` is
one conversation; an empty table gives an empty result. A conversation is one
output text, so it is the unit of memory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, TAIL = "### ", "</turn>"
LOSS_ROLE = "assistant"
_CONTROL = r"(\\*(?:### |</turn>))"           # with the backslashes before it
_ESCAPED = r"\\(\\*(?:### |</turn>))"
_BARE = r"(?<!\\)(?:### |</turn>)"


def _escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"\\$1")


def _unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1")


def _role_out(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))


def _role_in(role: Column) -> Column:
    pieces = F.split(role, r"\\\\", -1)            # on the pair of backslashes
    return F.array_join(F.transform(pieces, lambda x: F.replace(x, F.lit("\\n"), F.lit("\n"))), "\\")


def _render_turn(role: Column, body: Column) -> Column:
    return F.concat(F.lit(HEAD), _role_out(role), F.lit(":\n"), body, F.lit("\n" + TAIL + "\n"))


def parse(formatted: Column) -> Column:
    """Turns of a formatted conversation: role, text, and start and length (code
    points, from 0) of the escaped text. A text that breaks the grammar is null."""
    pieces = F.split(formatted, r"(?<!\\)</turn>\n", -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    starts = F.aggregate(
        pieces, F.array(F.lit(0)),
        lambda acc, p: F.concat(acc, F.array(F.element_at(acc, -1) + F.length(p) + F.lit(len(TAIL) + 1))),
        lambda acc: F.slice(acc, 1, F.size(acc) - 1))

    def turn(piece: Column, start: Column) -> Column:
        line = F.substring_index(piece, "\n", 1)
        role = F.substring(line, F.lit(len(HEAD) + 1), F.length(line) - F.lit(len(HEAD) + 1))
        body = F.substring(piece, F.length(line) + 2, F.length(piece) - F.length(line) - 2)
        good = line.startswith(HEAD) & line.endswith(":") & ~F.rlike(body, F.lit(_BARE))
        return F.struct(_role_in(role).alias("role"), F.when(good, _unescape(body)).alias("text"),
                        (start + F.length(line) + 1).alias("start"), F.length(body).alias("length"))

    # Both arrays are evaluated once; a lambda that refers to them would do so for every turn.
    return F.zip_with(pieces, starts, turn)


def format_conversations(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) to one row per conversation:
    conv_id, formatted, and turns (see ``parse``) read back from it."""
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("source"))

    def bare(t: Column) -> Column:
        return _render_turn(t["role"], t["text"])

    def content(turns: str) -> Column:
        return F.transform(turns, lambda t: F.struct(t["role"], t["text"]))

    def safe(t: Column) -> Column:
        back = parse(bare(t))
        same = back == F.array(F.struct(t["role"].alias("role"), t["text"].alias("text"),
                                        (F.length(_role_out(t["role"])) + F.lit(len(HEAD) + 2)).alias("start"), F.length(t["text"]).alias("length")))
        return F.when(F.coalesce(same, F.lit(False)), bare(t)).otherwise(_render_turn(t["role"], _escape(t["text"])))

    done = (whole.withColumn("first", F.array_join(F.transform("source", bare), ""))
            .withColumn("back", parse(F.col("first")))
            .withColumn("same", F.coalesce(content("back") == content("source"), F.lit(False)))
            .withColumn("formatted", F.when(F.col("same"), F.col("first")).otherwise(F.array_join(F.transform("source", safe), "")))
            .withColumn("turns", F.when(F.col("same"), F.col("back")).otherwise(parse(F.col("formatted")))))
    checked = (F.when(F.col("same") | F.coalesce(content("turns") == content("source"), F.lit(False)), F.col("formatted"))
               .otherwise(F.raise_error(F.lit("a conversation does not survive its round trip"))))
    return done.select("conv_id", checked.alias("formatted"), "turns")


def loss_text(turns: Column, role: str = LOSS_ROLE) -> Column:
    """Text under the loss mask: the parsed spans of ``role``'s turns, unescaped, in order."""
    return F.array_join(F.transform(F.filter(turns, lambda t: t["role"] == F.lit(role)), lambda t: t["text"]), "")


def digests(formatted: DataFrame) -> DataFrame:
    """What the query returns, read back from the formatted texts."""
    line = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = loss_text(F.col("turns"))
    return formatted.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(line, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
