"""Chat formatting with Spark expressions only.

The template, for a conversation of merged blocks::

    <turn user>
    first text<next/>second text of the same role</turn>
    <turn assistant>
    answer</turn>

``<turn ``, ``</turn>`` and ``<next/>`` are control strings. Inside texts a backslash is doubled and a control string gets
a backslash after its first character, so no text can hold a control string and every text can be read back.

Cases: rows by turn (NULL turns first), ties by role, then text; equal rows all stay. A NULL text or role is empty. A NULL
conversation id is one conversation of its own. An empty table gives an empty result. Other columns are ignored, whatever they are called.
One conversation becomes one string, so a conversation has to fit into a task, as its output row does. The time it takes grows about with its
length: places are summed and looked up in chunks of TOGETHER turns and CHARS characters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE, NEXT = "<turn ", "</turn>", "<next/>"
CLOSE_LINE = CLOSE + "\n"
TOGETHER, CHARS = 256, 2048
SPANS = "array<struct<start:int,end:int>>"


def _with(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _spans(pieces: Column) -> Column:
    """Where the pieces to be trained on lie in the joined text."""
    measured = F.transform(pieces, lambda p: F.struct(F.char_length(p["text"]).alias("n"), p["loss"].alias("loss")))
    nothing = F.array().cast(SPANS)

    def of_chunk(chunk: Column) -> Column:
        def add(acc: Column, piece: Column) -> Column:
            end = acc["at"] + piece["n"]
            span = F.struct(acc["at"].alias("start"), end.alias("end"))
            return F.struct(end.alias("at"), F.when(piece["loss"], F.array_append(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

        return F.aggregate(chunk, F.struct(F.lit(0).alias("at"), nothing.alias("spans")), add)

    def joined(acc: Column, chunk: Column) -> Column:
        moved = F.transform(
            chunk["spans"], lambda s: F.struct((s["start"] + acc["at"]).alias("start"), (s["end"] + acc["at"]).alias("end"))
        )
        return F.struct((acc["at"] + chunk["at"]).alias("at"), F.concat(acc["spans"], moved).alias("spans"))

    def in_chunks(all_pieces: Column) -> Column:
        last = F.call_function("div", F.size(all_pieces) - 1, F.lit(TOGETHER)).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda k: of_chunk(F.slice(all_pieces, k * TOGETHER + 1, F.lit(TOGETHER))))

    start = F.struct(F.lit(0).alias("at"), nothing.alias("spans"))
    return F.aggregate(_with(measured, in_chunks), start, joined, lambda acc: acc["spans"])


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in (OPEN, CLOSE, NEXT):
        out = F.replace(out, F.lit(control), F.lit("<\\" + control[1:]))
    return out


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(">"), F.lit("\\>"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_conversations(rows: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """conv_id, turns, formatted and loss_spans (start, end in code points, end exclusive: what is trained on)."""
    turn = F.struct(
        F.col("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    n = F.size("turns")
    role_at = lambda i: F.get("turns", i)["role"]
    # Blocks of one role: where they start, and one past the end of each.
    starts = turns.withColumn(
        "_starts",
        F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (role_at(i) != role_at(i - 1))),
    )
    blocks = starts.withColumn(
        "_blocks",
        F.transform(
            "_starts",
            lambda start, k: F.slice("turns", start + 1, F.coalesce(F.get("_starts", k + 1), n) - start),
        ),
    )
    # Pieces in order: control text, turn text, control text ...; only texts of the loss role are trained on.
    piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    control = lambda text: piece(text, F.lit(False))

    def block_pieces(block: Column) -> Column:
        role = F.get(block, F.lit(0))["role"]
        texts = F.flatten(
            F.transform(
                block,
                lambda t, i: F.array(
                    control(F.when(i > 0, F.lit(NEXT)).otherwise(F.lit(""))),
                    piece(escape(t["text"]), role == loss_role),
                ),
            )
        )
        head = F.array(control(F.concat(F.lit(OPEN), escape_role(role), F.lit(">\n"))))
        return F.concat(head, texts, F.array(control(F.lit(CLOSE_LINE))))

    pieces = blocks.withColumn("_pieces", F.flatten(F.transform("_blocks", block_pieces)))
    return pieces.select(
        "conv_id",
        "turns",
        F.array_join(F.transform("_pieces", lambda p: p["text"]), "").alias("formatted"),
        _spans(F.col("_pieces")).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) a formatted string was made from."""
    blocks = F.filter(F.split(formatted, CLOSE_LINE), lambda b: b != "")
    header = r"(?s)^<turn ((?:[^\\>]++|\\.)*+)>\n"

    def turns_of(block: Column) -> Column:
        role = unescape(F.regexp_extract(block, header, 1))
        body = F.regexp_replace(block, header, "")
        return F.transform(F.split(body, NEXT), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns_of))


def read_loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""

    def read(chunks: Column) -> Column:
        def text(span: Column) -> Column:
            first = F.call_function("div", span["start"], F.lit(CHARS)).cast("int")
            number = F.call_function("div", span["end"], F.lit(CHARS)).cast("int") - first + 1
            near = F.array_join(F.slice(chunks, first + 1, number), "")
            return unescape(F.substring(near, span["start"] - first * CHARS + 1, span["end"] - span["start"]))

        return F.array_join(F.transform(spans, text), "")

    return _with(F.regexp_extract_all(formatted, F.lit("(?s).{1,%d}" % CHARS), F.lit(0)), read)
