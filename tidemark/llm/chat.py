"""Chat formatting by event-sourced reconstruction.

A log holds what happened to messages: they are opened, streamed in deltas, edited, generated anew. It is dealt by
conversation and message and sorted by sequence; a task folds each message's events as they come, so only one message is
held at a time and a conversation may span tasks. Final messages are rendered to records of at most RECORD_TURNS turns
with the spans that a loss is taken on, and can be read back from them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runs import ranked, with_carried
from .shared import staged

#: Message numbers that one record of the output holds: shorter conversations are one record.
RECORD_TURNS = 1024
#: Characters of a delta when a log is made of finished turns.
DELTA = 160
#: Bits of a sequence number that count the events of one turn.
EVENT_BITS = 28

# fixed values: marks of the template, before and after a text of each role; other roles stand between marks of their own
MARKS = {"user": ("[INST] ", " [/INST]"), "system": ("<<SYS>>", "<</SYS>>"), "assistant": ("<s>", "</s>")}
ROLE = ("[ROLE]", "[/ROLE]", "[END]")
CONTROL = r"(\[|<)((?:/?(?:INST|ROLE)\])|END\]|/?s>|<SYS>>|</SYS>>)"
TURN = r"(?s)\[INST\] .*? \[/INST\]|<<SYS>>.*?<</SYS>>|<s>.*?</s>|\[ROLE\].*?\[END\]"


def escape(text: Column) -> Column:
    r"""Control strings get a backslash behind their first character, backslashes are doubled."""
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), CONTROL, r"$1\\$2")


def unescape(text: Column) -> Column:
    """The text that ``escape`` made it of."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def numbered(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """key, n, role and text of finished turns, numbered from 0 in each conversation: null turns first, ties by role, then
    text. Null roles and texts become empty; rows without a key are one conversation."""
    plain = turns.select(F.col(key), F.col(turn).alias("_turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    return ranked(plain, key, [F.col("_turn").asc_nulls_first(), F.col("role"), F.col("text")]).select(key, F.col("place").alias("n"), "role", "text")


def events_of(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """The log that a chat service would have left of numbered turns: key, message, seq, kind, role and text.

    Every turn is opened and streamed in deltas. Even-numbered turns begin with a draft, which an edit replaces by the
    first part of the text; odd ones are first answered by their text backwards, met by a message 2n + 1, and then
    generated anew, which withdraws that message.
    """
    event = lambda kind, text, message=0: F.struct(F.lit(kind).alias("kind"), text.alias("text"), (2 * F.col("n") + message).alias("message"))
    pieces = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{DELTA}}}"), F.lit(0))
    deltas = lambda p: F.transform(p, lambda x: event("delta", x))
    opened = F.array(event("open", F.lit("")))
    first = F.coalesce(F.try_element_at(pieces, F.lit(1)), F.lit(""))
    drafted = F.concat(opened, F.array(event("delta", F.reverse(first)), event("edit", first)), deltas(F.slice(pieces, 2, F.greatest(F.size(pieces), F.lit(1)))))
    retried = F.concat(
        opened, F.array(event("delta", F.reverse(first)), event("open", F.lit(""), 1), event("delta", first, 1), event("regenerate", F.lit(""))), deltas(pieces)
    )
    log = turns.select(key, "n", "role", F.posexplode(F.when(F.col("n") % 2 == 0, drafted).otherwise(retried)).alias("i", "e"))
    return log.select(key, "e.message", (F.shiftleft("n", EVENT_BITS) + F.col("i")).alias("seq"), "e.kind", "role", "e.text")


def fold(log: DataFrame, key: str = "conv_id") -> DataFrame:
    """key, message, role and text of the messages that a log leaves standing.

    Events of a message count in the order of seq (null first, ties by kind, then text). ``delta`` adds its text,
    ``edit`` replaces the whole text, ``regenerate`` empties it and withdraws the later messages of the conversation whose
    first event came before; ``open`` and unknown kinds change nothing, as a message begins with its first event. Its role
    is the first that is not null, else empty. Null texts are empty. Repeated rows are events of their own. Messages are
    ordered by number, null first; rows without a key are one conversation. Other columns are left out.
    """
    names = ["key", "message", "role", "text", "opened", "upto", "before_here", "part", "row"]
    kind = dict(log.dtypes)[key]
    schema = f"key {kind}, message bigint, role string, text string, opened bigint, upto bigint, before_here bigint, part int, row bigint"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row = TaskContext.get().partitionId(), 0
        now, role, text, opened, again, most, last = None, None, [], None, None, None, object()
        done: list[tuple] = []
        types = None

        def close() -> None:
            nonlocal most, last, row
            if now[0] != last:
                most, last = None, now[0]
            upto = most if again is None else again if most is None else max(most, again)
            done.append((*now, role or "", "".join(text), opened, upto, most, part, row))
            most, row = upto, row + 1

        def out() -> pa.RecordBatch:
            columns = zip(*done)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        size = 0
        for batch in batches:
            types = [batch.schema.field(0).type, *[pa.int64()], pa.string(), pa.string(), *[pa.int64()] * 3, pa.int32(), pa.int64()]
            for k, m, seq, what, who, said in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or (k, m) != now:
                    if now is not None:
                        close()
                        size += sum(map(len, text))
                        if len(done) >= 4096 or size > 1 << 20:
                            yield out()
                            done, size = [], 0
                    now, role, text, opened, again = (k, m), None, [], seq, None
                role = who if role is None else role
                if what == "delta":
                    text.append(said or "")
                elif what == "edit":
                    text = [said or ""]
                elif what == "regenerate":
                    text, again = [], seq
        if now is not None:
            close()
        if done:
            yield out()

    plain = log.select(F.col(key).alias("key"), F.col("message").cast("bigint").alias("message"), F.col("seq").cast("bigint").alias("seq"), "kind", "role", "text")
    dealt = plain.repartitionByRange("key", "message").sortWithinPartitions("key", "message", "seq", "kind", "text")
    runs = staged(dealt.mapInArrow(read, schema), "messages")
    found = with_carried(runs, "key", "upto", lambda a, b: a if b is None else b if a is None else max(a, b))
    since = F.greatest("before", "before_here")  # greatest leaves nulls out
    return found.where(F.coalesce(since <= F.coalesce("opened", since), F.lit(True))).select(F.col("key").alias(key), "message", "role", "text")


def render(messages: DataFrame, key: str = "conv_id", turns: int = RECORD_TURNS) -> DataFrame:
    """key, record, text and loss: the formatted conversation and the spans (start, end in code points) of assistant texts.

    A record holds at most ``turns`` message numbers of a conversation; its texts in the order of record are the whole.
    """
    role, said = F.col("role"), escape(F.col("text"))
    text = F.concat(F.lit(ROLE[0]), escape(role), F.lit(ROLE[1]), said, F.lit(ROLE[2]))
    for name, (begin, end) in MARKS.items():
        text = F.when(role == name, F.concat(F.lit(begin), said, F.lit(end))).otherwise(text)
    begin, end = MARKS["assistant"]
    n = F.char_length("piece")
    pieces = messages.select(key, F.floor(F.coalesce("message", F.lit(-1)) / turns).cast("bigint").alias("record"), "message", (role == "assistant").alias("taught"), text.alias("piece"))
    pieces = pieces.withColumn("n", n).groupBy(key, "record").agg(F.array_sort(F.collect_list(F.struct("message", "taught", "n", "piece"))).alias("all"))
    start = F.aggregate(
        "all",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")),
        lambda s, x: F.struct(
            (s["at"] + x["n"]).alias("at"),
            F.when(x["taught"], F.concat(s["spans"], F.array(F.struct((s["at"] + len(begin)).alias("start"), (s["at"] + x["n"] - len(end)).alias("end"))))).otherwise(s["spans"]).alias("spans"),
        ),
    )
    return pieces.select(key, "record", F.array_join(F.transform("all", lambda x: x["piece"]), "").alias("text"), start["spans"].alias("loss"))


def read_back(records: DataFrame) -> DataFrame:
    """The records with turns (role and text of each, unescaped) and taught (the text under the loss spans, unescaped)."""

    def turn(piece: Column) -> Column:
        n = F.char_length(piece)
        inner = lambda begin, end: unescape(F.substring(piece, F.lit(len(begin) + 1), n - len(begin) - len(end)))
        cut = F.instr(piece, ROLE[1])
        role = F.substring(piece, F.lit(len(ROLE[0]) + 1), cut - len(ROLE[0]) - 1)
        text = F.substring(piece, cut + len(ROLE[1]), n - cut - len(ROLE[1]) + 1 - len(ROLE[2]))
        out = F.struct(unescape(role).alias("role"), unescape(text).alias("text"))
        for name, (begin, end) in MARKS.items():
            out = F.when(F.startswith(piece, F.lit(begin)), F.struct(F.lit(name).alias("role"), inner(begin, end).alias("text"))).otherwise(out)
        return out

    turns = F.transform(F.regexp_extract_all("text", F.lit(TURN), F.lit(0)), turn)
    taught = F.transform("loss", lambda s: unescape(F.substring(F.col("text"), s["start"] + 1, s["end"] - s["start"])))
    return records.withColumns({"turns": turns, "taught": F.array_join(taught, "")})
