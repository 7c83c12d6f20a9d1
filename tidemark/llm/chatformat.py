"""Chat formatting of records in many layouts, selected by schema fingerprints.

A record is a variant (parsed JSON or a converted struct) in one of several layouts: a prompt with its
response, an instruction with input and output, pairs of a history, a list of messages under one of several
names. Its nested field paths, as far as any layout speaks of them, are sorted and hashed: this fingerprint
selects the layout, and the layout says declaratively which paths become which turns. Fields that no layout
knows (ids, sources, scores) do not change a fingerprint.

Turns become one text. A turn is ``### role: text</turn>`` and a line break. Backslashes, ``##`` and ``</turn>``
inside roles and texts, and a colon before a space in a role, are escaped with a backslash, so control
strings stand only where the template puts them and every text can be read back exactly. The loss mask is a
list of byte spans that cover the escaped texts of the answering role and nothing else.

Only built-in functions are used, and a record is worked on where it lies.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from itertools import chain, combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import unused

OPEN, SEPARATOR, CLOSE = "### ", ": ", "</turn>\n"
_TURNS = "array<struct<role string, text string>>"


# --- layouts ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Field:
    """One turn of a fixed role out of the text at a path; ``more`` is a second path, added after a blank line."""

    role: str
    path: str
    more: str | None = None

    def paths(self) -> set[str]:
        return {self.path}

    def optional(self) -> set[str]:
        return {self.more} if self.more else set()

    def turns(self, record: Column) -> Column:
        text = _text(record, self.path)
        if self.more:
            more = _text(record, self.more)
            text = F.when(F.coalesce(more, F.lit("")) == "", text).otherwise(F.concat_ws("\n\n", text, more))
        return F.array(F.struct(F.lit(self.role).alias("role"), F.coalesce(text, F.lit("")).alias("text"))).cast(_TURNS)


@dataclass(frozen=True)
class Maybe(Field):
    """Such a turn, left out where the path is missing or holds no text."""

    def paths(self) -> set[str]:
        return set()

    def optional(self) -> set[str]:
        return {self.path}

    def turns(self, record: Column) -> Column:
        given = F.coalesce(_text(record, self.path), F.lit("")) != ""
        return F.when(given, super().turns(record)).otherwise(F.array().cast(_TURNS))


@dataclass(frozen=True)
class Each:
    """A turn for each element of a list of objects; ``names`` maps their roles to canonical ones."""

    path: str
    role: str
    text: str
    names: tuple[tuple[str, str], ...] = ()

    def paths(self) -> set[str]:
        return {self.path, f"{self.path}[].{self.role}", f"{self.path}[].{self.text}"}

    def optional(self) -> set[str]:
        return set()

    def turns(self, record: Column) -> Column:
        def turn(element: Column) -> Column:
            role = F.coalesce(F.try_variant_get(element, f"$.{self.role}", "string"), F.lit(""))
            named = role
            for given, canonical in self.names:
                named = F.when(role == given, F.lit(canonical)).otherwise(named)
            text = F.coalesce(F.try_variant_get(element, f"$.{self.text}", "string"), F.lit(""))
            return F.struct(named.alias("role"), text.alias("text"))

        elements = F.try_variant_get(record, f"$.{self.path}", "array<variant>")
        return F.coalesce(F.transform(elements, turn), F.array().cast(_TURNS)).cast(_TURNS)


@dataclass(frozen=True)
class Pairs:
    """Two turns, of the user and the assistant, for each pair in a list of lists."""

    path: str

    def paths(self) -> set[str]:
        return {self.path}

    def optional(self) -> set[str]:
        return set()

    def turns(self, record: Column) -> Column:
        def both(pair: Column) -> Column:
            sides = (F.struct(F.lit(r).alias("role"), F.coalesce(F.get(pair, F.lit(i)), F.lit("")).alias("text")) for i, r in enumerate(("user", "assistant")))
            return F.array(*sides).cast(_TURNS)

        pairs = F.try_variant_get(record, f"$.{self.path}", "array<array<string>>")
        return F.coalesce(F.flatten(F.transform(pairs, both)), F.array().cast(_TURNS))


Part = Field | Maybe | Each | Pairs


@dataclass(frozen=True)
class Layout:
    """A named layout: the turns of its parts, in order."""

    name: str
    parts: tuple[Part, ...]

    def fingerprints(self) -> Iterable[frozenset[str]]:
        """The sets of known field paths it stands for: each choice of optional ones, and empty lists."""
        required = set().union(*(p.paths() for p in self.parts))
        optional = sorted(set().union(*(p.optional() for p in self.parts)))
        choices = chain.from_iterable(combinations(optional, n) for n in range(len(optional) + 1))
        sets = {frozenset(required | set(chosen)) for chosen in choices}
        return sets | {frozenset(p for p in s if "[]" not in p) for s in sets}


_SHARED = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"))

LAYOUTS = (
    Layout("messages", (Maybe("system", "system"), Each("messages", "role", "content"))),
    Layout("conversations", (Maybe("system", "system"), Each("conversations", "from", "value", _SHARED))),
    Layout("turns", (Each("turns", "speaker", "text"),)),
    Layout("prompt_response", (Maybe("system", "system"), Field("user", "prompt"), Field("assistant", "response"))),
    Layout("prompt_completion", (Maybe("system", "system"), Field("user", "prompt"), Field("assistant", "completion"))),
    Layout("prompt_messages", (Field("user", "prompt"), Each("messages", "role", "content"))),
    Layout("question_answer", (Maybe("system", "system"), Field("user", "question", "context"), Field("assistant", "answer"))),
    Layout("instruction_output", (Maybe("system", "system"), Field("user", "instruction", "input"), Field("assistant", "output"))),
    Layout(
        "instruction_history",
        (Maybe("system", "system"), Pairs("history"), Field("user", "instruction", "input"), Field("assistant", "output")),
    ),
)


def _text(record: Column, path: str) -> Column:
    return F.try_variant_get(record, f"$.{path}", "string")


# --- fingerprints -------------------------------------------------------------------------------


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often ``use`` speaks of it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def field_paths(record: Column) -> Column:
    """Sorted distinct paths of a record's fields: ``a``, ``a.b`` in an object, ``a[].b`` in objects of a list."""

    def keys(value: Column) -> Column:
        none = F.array().cast("array<string>")
        return F.coalesce(F.map_keys(F.try_variant_get(value, "$", "map<string,variant>")), none)

    def below(entry: Column) -> Column:
        inner = F.transform(keys(entry["value"]), lambda k: F.concat(entry["key"], F.lit("."), k))
        elements = F.try_variant_get(entry["value"], "$", "array<variant>")
        listed = F.transform(F.flatten(F.transform(elements, keys)), lambda k: F.concat(entry["key"], F.lit("[]."), k))
        none = F.array().cast("array<string>")
        return F.concat(F.array(entry["key"]), inner, F.array_distinct(F.coalesce(listed, none)))

    top = F.map_entries(F.try_variant_get(record, "$", "map<string,variant>"))
    return F.array_sort(F.array_distinct(F.flatten(F.transform(top, below))))


def _hash(paths: Column) -> Column:
    return F.xxhash64(F.array_join(paths, "\n"))


def fingerprint(record: Column, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """The hash of a record's field paths that some layout speaks of; NULL if it is not an object."""
    known = sorted(set().union(*chain.from_iterable(x.fingerprints() for x in layouts)))
    spoken = F.array(*[F.lit(p) for p in known])
    return bound(field_paths(record), lambda paths: F.when(paths.isNotNull(), _hash(F.array_intersect(paths, spoken))))


def _by_fingerprint(print_: Column, layouts: tuple[Layout, ...], value: Callable[[Layout], Column]) -> Column:
    """``value`` of the layout that has this fingerprint, NULL if none has."""
    found, taken = None, set()
    for layout in layouts:
        own = [s for s in layout.fingerprints() if s and s not in taken]
        taken.update(own)
        hashes = [_hash(F.array(*[F.lit(p) for p in sorted(s)])) for s in sorted(own, key=sorted)]
        same = print_.isin(*hashes)
        found = F.when(same, value(layout)) if found is None else found.when(same, value(layout))
    return found


# --- template -----------------------------------------------------------------------------------


def escaped(text: Column) -> Column:
    """The text without control strings; ``unescaped`` is its inverse."""
    for control, safe in (("\\", "\\\\"), ("##", "#\\#"), ("</turn>", "<\\/turn>")):
        text = F.replace(text, F.lit(control), F.lit(safe))
    return text


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit(SEPARATOR), F.lit(":\\ "))


def _written(turns: Column, answering: str) -> Column:
    """The struct (formatted, loss_spans) of turns."""
    pieces = F.transform(
        turns,
        lambda t: F.struct(
            F.concat(F.lit(OPEN), _escaped_role(t["role"]), F.lit(SEPARATOR)).alias("head"),
            escaped(t["text"]).alias("body"),
            (t["role"] == answering).alias("answer"),
        ),
    )

    def spans(whole: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<first_byte long, bytes long>>").alias("spans"))

        def step(state: Column, piece: Column) -> Column:
            first = state["at"] + F.octet_length(piece["head"])
            size = F.octet_length(piece["body"]).cast("long")
            span = F.array(F.struct(first.alias("first_byte"), size.alias("bytes")))
            return F.struct(
                (first + size + len(CLOSE)).alias("at"),
                F.when(piece["answer"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"),
            )

        return F.aggregate(whole, start, step, lambda state: state["spans"])

    def both(whole: Column) -> Column:
        text = F.array_join(F.transform(whole, lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), "")
        return F.struct(text.alias("formatted"), spans(whole).alias("loss_spans"))

    return bound(pieces, both)


_MADE = ("layout", "formatted", "loss_spans")


def formatted(
    records: DataFrame, record_col: str, layouts: tuple[Layout, ...] = LAYOUTS, answering: str = "assistant"
) -> DataFrame:
    """The rows with ``layout``, ``formatted`` and ``loss_spans(first_byte, bytes)`` in place of the record.

    ``record_col`` is a variant, a struct, or a string of JSON. A record that is NULL, not an object, too large
    for a variant, or in no known layout keeps its row with NULL in the three columns, so that it can be counted and looked into. A list
    without elements gives an empty text. Missing or NULL roles and texts are empty; text that is not a
    string is its JSON. Repeated rows give equal results; an empty frame gives an empty one. Columns of the
    results' names are replaced, all others stay.
    """
    kind = records.schema[record_col].dataType.typeName()
    record = F.col(record_col)
    record = F.try_parse_json(record) if kind == "string" else F.to_variant_object(record) if kind == "struct" else record
    kept = [c for c in records.columns if c.lower() not in _MADE and c.lower() != record_col.lower()]
    parsed, marked, told = (unused(records, c) for c in ("parsed", "marked", "told"))
    rows = records.select(*kept, record.alias(parsed))

    def turns(layout: Layout) -> Column:
        return F.concat(*[p.turns(F.col(parsed)) for p in layout.parts])

    def select(print_: Column) -> Column:
        name = _by_fingerprint(print_, layouts, lambda x: F.lit(x.name))
        return F.struct(name.alias("layout"), _by_fingerprint(print_, layouts, turns).alias("turns"))

    mapped = rows.select(*kept, bound(fingerprint(F.col(parsed), layouts), select).alias(marked))
    text = bound(F.col(marked), lambda m: F.struct(m["layout"].alias("layout"), _written(m["turns"], answering).alias("text")))
    named = mapped.select(*kept, text.alias(told))
    return named.select(
        *kept,
        F.col(told)["layout"].alias("layout"),
        F.col(told)["text"]["formatted"].alias("formatted"),
        F.col(told)["text"]["loss_spans"].alias("loss_spans"),
    )


# --- reading back -------------------------------------------------------------------------------


def turns_of(text: Column) -> Column:
    """The turns (role, text) of a formatted text."""
    pieces = F.split(text, CLOSE)

    def turn(piece: Column) -> Column:
        at = F.locate(SEPARATOR, piece)
        size = F.length(piece)
        role = F.substring(piece, F.lit(len(OPEN) + 1), at - len(OPEN) - 1)
        body = F.substring(piece, at + len(SEPARATOR), size)
        return F.struct(unescaped(role).alias("role"), unescaped(body).alias("text"))

    return bound(pieces, lambda p: F.transform(F.slice(p, F.lit(1), F.size(p) - 1), turn))


def masked_text(text: Column, spans: Column) -> Column:
    """All text under the loss mask, without escapes."""

    def read(both: Column) -> Column:
        parts = F.transform(
            both["spans"],
            lambda s: unescaped(F.substring(both["bytes"], (s["first_byte"] + 1).cast("int"), s["bytes"].cast("int")).cast("string")),
        )
        return F.array_join(parts, "")

    return bound(F.struct(text.cast("binary").alias("bytes"), spans.alias("spans")), read)


def gathered(rows: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """``(id, turns)`` of a table of single turns ``(id, turn, role, text)``.

    Turns come in the order of ``turn``, then role, then text, NULL first; NULL roles and texts are empty.
    Repeated rows are turns of their own. Rows without an id belong together with nothing: each is a
    conversation of one turn.
    """
    given = F.struct(
        F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    named = rows.filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.sort_array(F.collect_list(given)).alias("turns"))
    single = rows.filter(F.col(id_col).isNull()).select(id_col, F.array(given).alias("turns"))
    plain = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return named.unionByName(single).select(id_col, plain.cast(_TURNS).alias("turns"))
