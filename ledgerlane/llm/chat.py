"""Chat formatting by a finite-state machine over roles, and reading the format back.

A declarative ``Template`` says which roles may follow which, what marks a turn, and whose texts are
learnt. The machine walks a conversation's turns in order and emits text segments, each with a loss
flag. Control strings and the escape character inside texts are escaped, so the segments, joined,
can be read back exactly.

A conversation may hold any number of turns: rows are sorted by conversation and turn and streamed,
and only the machine's state, running digests and one batch of rows are held. Turns that break the
order, or whose role the template does not know, are formatted all the same (unknown roles by name)
and make ``valid`` false. Null texts and null roles count as empty. Rows that repeat a turn number
are ordered by role and text. Rows with a null conv_id form one conversation. An empty table gives
no conversations. Further columns are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ESCAPE = "\\"


@dataclass(frozen=True)
class Template:
    """``begin`` opens a conversation; a turn is its role's head, the escaped text and the role's tail.

    ``other`` has the head, the mark after the role's name, and the tail for roles without marks.
    ``follows`` gives the roles that may come after a state: "" is the start, and a role's name the
    state after its turn. ``final`` are the states a whole conversation may end in.
    """

    begin: str
    turns: dict[str, tuple[str, str]]
    other: tuple[str, str, str]
    follows: dict[str, tuple[str, ...]]
    final: tuple[str, ...]
    learnt: tuple[str, ...]
    controls: tuple[str, ...] = field(init=False)

    def __post_init__(self) -> None:
        marks = {self.begin, *self.other, *(m for pair in self.turns.values() for m in pair)} - {""}
        object.__setattr__(self, "controls", tuple(sorted(marks, key=lambda m: (-len(m), m))))
        openers = {m[0] for m in marks}
        if ESCAPE in "".join(marks) or any(c in openers for m in marks for c in m[1:]):
            raise ValueError("a control string must not hold the escape, nor another's first character after its own")
        heads = [head for head, _ in self.turns.values()] + [self.other[0]]
        if len(set(heads)) < len(heads) or "" in marks or not all(heads) or not all(t for _, t in self.turns.values()):
            raise ValueError("every role needs a head of its own and a tail")

    def escaped(self, text: str) -> str:
        return re.sub("|".join(map(re.escape, (ESCAPE, *self.controls))), lambda m: ESCAPE + m[0], text)


#: Marks in the manner of published instruction formats.
DEFAULT_TEMPLATE = Template(
    begin="<s>",
    turns={"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("[ANS]", "</s>")},
    other=("[ROLE]", "[/ROLE]", "[/TURN]"),
    follows={"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
    final=("assistant",),
    learnt=("assistant",),
)

SEGMENT_SCHEMA = "conv_id long, turn long, segment string, loss boolean, closes boolean, valid boolean"
SEGMENT_NAMES = [part.split()[0] for part in SEGMENT_SCHEMA.split(", ")]

Segment = tuple[int | None, int | None, str, bool, bool, bool]


def _segments(turns: Iterator[tuple[int | None, int | None, str, str]], template: Template) -> Iterator[Segment]:
    """The machine. ``valid`` holds up to the segment; ``closes`` marks the last one of a conversation,
    which is empty and whose ``valid`` is that of the whole."""
    current: tuple[int | None] | None = None
    state, valid = "", True
    for conv_id, turn, role, text in turns:
        if current != (conv_id,):
            if current:
                yield current[0], None, "", False, True, valid and state in template.final
            current, state, valid = (conv_id,), "", True
            yield conv_id, None, template.begin, False, False, True
        valid = valid and role in template.follows.get(state, ())
        state = role
        if role in template.turns:
            head, tail = template.turns[role]
        else:
            head, tail = template.other[0] + template.escaped(role) + template.other[1], template.other[2]
        yield conv_id, turn, head, False, False, valid
        yield conv_id, turn, template.escaped(text), role in template.learnt, False, valid
        yield conv_id, turn, tail, False, False, valid
    if current:
        yield current[0], None, "", False, True, valid and state in template.final


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def format_conversations(turns: DataFrame, template: Template = DEFAULT_TEMPLATE) -> DataFrame:
    """Segments of all conversations of ``turns`` (conv_id, turn, role, text), in order within each partition;
    a conversation lies in one partition."""
    own = turns.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    ordered = own.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = pa.schema(list(zip(SEGMENT_NAMES, [pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_(), pa.bool_()])))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(_segments(_rows(batches), template), schema)

    return ordered.mapInArrow(emit, SEGMENT_SCHEMA)


class Reader:
    """Reads the format, chunk by chunk, back into turns. Feed it segments; their borders do not matter to it
    beyond the loss mask, which comes with them."""

    def __init__(self, template: Template):
        self.template = template
        self.tokens = re.compile("|".join([re.escape(ESCAPE) + "(?:.)", *map(re.escape, template.controls), "."]), re.DOTALL)
        self.plain = re.compile(r"[^" + re.escape("".join({ESCAPE, *(m[0] for m in template.controls)})) + "]+")
        self.roles = {head: role for role, (head, _) in template.turns.items()}
        self.tails = {tail for _, tail in template.turns.values()} | {template.other[2]}

        self.turn_digest, self.loss_digest = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0
        self.role: str | None = None
        self.naming = False

    def _take(self, plain: str, loss: bool) -> None:
        """Unescaped text of a turn, or of a role's name."""
        if self.naming:
            self.name += plain
        else:
            self.turn_digest.update(plain.encode("utf-8", "surrogatepass"))
            if loss:
                self.loss_digest.update(plain.encode("utf-8", "surrogatepass"))
                self.loss_chars += len(plain)

    def feed(self, segment: str, loss: bool) -> None:
        self.formatted_chars += len(segment)
        at = 0
        while at < len(segment):
            run = self.plain.match(segment, at)
            if run:
                self._take(run[0], loss)
                at = run.end()
                continue
            token = self.tokens.match(segment, at)
            at = token.end()
            if token[0] == self.template.begin:
                continue
            if token[0] in self.roles:
                self._open(self.roles[token[0]])
            elif token[0] == self.template.other[0]:
                self.naming, self.name = True, ""
            elif token[0] == self.template.other[1]:
                self.naming = False
                self._open(self.name)
            elif token[0] in self.tails:
                self.turn_digest.update(b"\n")
                self.n_turns += 1
            elif token[0][0] == ESCAPE:
                # The escape covers a whole control string, or the escape itself.
                rest = next((c for c in (ESCAPE, *self.template.controls) if segment.startswith(c, at - 1)), token[0][1:])
                self._take(rest, loss)
                at += len(rest) - 1
            else:
                self._take(token[0], loss)

    def _open(self, role: str) -> None:
        self.turn_digest.update(role.encode("utf-8", "surrogatepass") + b"\n")


DIGEST_SCHEMA = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean"
)
DIGEST_NAMES = [part.split()[0] for part in DIGEST_SCHEMA.split(", ")]


def _digests(segments: Iterator[Segment], template: Template) -> Iterator[tuple]:
    reader = Reader(template)
    for conv_id, _, text, loss, closes, valid in segments:
        reader.feed(text, loss)
        if closes:
            yield (
                conv_id, reader.n_turns, reader.turn_digest.hexdigest(), reader.loss_chars,
                reader.loss_digest.hexdigest(), reader.formatted_chars, valid,
            )
            reader = Reader(template)


def read_back(segments: DataFrame, template: Template = DEFAULT_TEMPLATE) -> DataFrame:
    """Per conversation: number of turns, digests of its turns and of the text under the loss mask as read from
    the formatted text, its length, and whether the machine accepted it. Takes the result of
    ``format_conversations`` as it is."""
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
    schema = pa.schema(list(zip(DIGEST_NAMES, kinds)))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(_digests(_rows(batches), template), schema)

    return segments.mapInArrow(digest, DIGEST_SCHEMA)


PROBE_TEXT = "</s>[INST] ok [/INST]"


def with_probe(turns: DataFrame) -> DataFrame:
    """The turns and conversation -1, whose texts are full of control strings."""
    spark: SparkSession = turns.sparkSession
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE_TEXT).alias("text"),
    )
    return turns.select("conv_id", "turn", "role", "text").union(probe)


#: The digests in SQL: lengths of the marks by role, and escapes counted with one pattern.
ORACLE_SQL = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized as (
  select *,
    length(regexp_replace(text, '(\\|<s>|</s>|\[/?(SYS|INST|ROLE)\]|\[ANS\]|\[/TURN\])', '#\1', 'g'))
      + case role when 'system' then 11 when 'user' then 13 when 'assistant' then 9
             else 20 + length(regexp_replace(role, '(\\|<s>|</s>|\[/?(SYS|INST|ROLE)\]|\[ANS\]|\[/TURN\])', '#\1', 'g')) end as chars,
    lag(role, 1, '') over (partition by conv_id order by turn) as before,
    row_number() over (partition by conv_id order by turn desc) = 1 as ends
  from turns
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn) filter (role = 'assistant'), '')) as loss_sha256,
  3 + sum(chars)::bigint as formatted_chars,
  bool_and((before || '>' || role) in ('>system', '>user', 'system>user', 'user>assistant', 'assistant>user')
           and (not ends or role = 'assistant')) as valid
from sized group by conv_id
"""
