"""Chat records of differing layouts to canonical turns and one marked text, in DataFrame functions only."""

from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lawloom.functions.arrays import bind, running_sum

TURNS = "array<struct<role:string,text:string>>"
#: Marks of the template. Texts are escaped so that they hold no `#` and no `<`: neither mark can occur in them.
HEAD, MIDDLE, END = "### ", ": ", "</turn>\n"
_ESCAPES = [("\\", "\\e"), ("#", "\\h"), ("<", "\\l")]
_ROLE_ESCAPES = [*_ESCAPES, (":", "\\c")]


@dataclass(frozen=True)
class Layout:
    """A declarative mapping: records that have all `required` paths, any of `optional` and no others.

    turns: a list field, and in its elements the fields for role and text; or, with `roles`, plain fields and the role each speaks.
    """

    name: str
    required: tuple[str, ...] = ()
    optional: tuple[str, ...] = ()
    turns: tuple[str, str, str] | None = None
    roles: tuple[tuple[str, str], ...] = ()
    renamed_roles: tuple[tuple[str, str], ...] = ()

    def path_sets(self) -> list[tuple[str, ...]]:
        picks = [c for n in range(len(self.optional) + 1) for c in combinations(self.optional, n)]
        return [tuple(sorted({*self.required, *pick})) for pick in picks]


#: Public layouts of instruction data, as field names fixed by those data.
LAYOUTS = (
    Layout("messages", ("messages",), ("messages[].role", "messages[].content"), turns=("messages", "role", "content")),
    Layout(
        "conversations", ("conversations",), ("conversations[].from", "conversations[].value"), turns=("conversations", "from", "value"),
        renamed_roles=(("human", "user"), ("gpt", "assistant")),
    ),
    Layout("prompt", ("prompt",), ("completion",), roles=(("prompt", "user"), ("completion", "assistant"))),
    Layout(
        "instruction", ("instruction", "output"), ("system", "input"),
        roles=(("system", "system"), ("instruction", "user"), ("input", "user"), ("output", "assistant")),
    ),
)


def _filled(steps: list[str]):
    def there(element: Column) -> Column:
        for step in steps:
            element = element.getField(step)
        return element.isNotNull()

    return there


def _paths(kind: T.DataType, value: Column, path: str) -> list[tuple[str, Column]]:
    """(path, is it there) of a field and all fields in it; a list's element fields count if any element has them."""
    out = [(path, value.isNotNull())] if path else []
    if isinstance(kind, T.StructType):
        for f in kind.fields:
            out += _paths(f.dataType, value.getField(f.name), f"{path}.{f.name}" if path else f.name)
    elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        for f in kind.elementType.fields:
            for inner, _ in _paths(f.dataType, F.lit(None), f"{path}[].{f.name}"):
                steps = inner.removeprefix(f"{path}[].").split(".")

                out.append((inner, F.coalesce(F.exists(value, _filled(steps)), F.lit(False))))
    return out


def fingerprint(record: Column, schema: T.StructType) -> Column:
    """Hash of the sorted nested paths that a record fills; files of several layouts read together have one schema with NULLs."""
    found = [F.when(there, F.lit(path)) for path, there in sorted(_paths(schema, record, ""), key=lambda p: p[0])]
    return F.sha2(F.concat_ws("\n", *found), 256)


def _has(schema: T.StructType, layout: Layout) -> bool:
    names = set(schema.fieldNames())
    if layout.turns:
        return layout.turns[0] in names
    return any(f in names for f, _ in layout.roles)


def canonical_turns(record: Column, schema: T.StructType, layout: Layout) -> Column:
    names = set(schema.fieldNames())
    if layout.turns:
        field, role, text = layout.turns
        inner = set(schema[field].dataType.elementType.fieldNames())
        take = lambda e, name: e.getField(name).cast("string") if name in inner else F.lit(None).cast("string")

        def turn(e):
            said = F.coalesce(take(e, role), F.lit(""))
            for old, new in layout.renamed_roles:
                said = F.when(said == old, new).otherwise(said)
            return F.struct(said.alias("role"), F.coalesce(take(e, text), F.lit("")).alias("text"))

        return F.transform(record.getField(field), turn).cast(TURNS)
    turns = [
        F.when(record.getField(f).isNotNull(), F.struct(F.lit(role).alias("role"), record.getField(f).cast("string").alias("text")))
        for f, role in layout.roles if f in names
    ]
    return F.array_compact(F.array(*turns)).cast(TURNS)


def escape(text: Column, escapes: list[tuple[str, str]] = _ESCAPES) -> Column:
    for plain, code in escapes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(_ROLE_ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def format_chats(records: DataFrame, id_column: str, record_column: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """(id_column, fingerprint, layout, formatted, loss_spans): one row per record.

    The fingerprint of a record's filled paths selects its layout; records of no known layout keep their fingerprint and
    have NULL in the rest, so they can be counted and mapped later. A turn is written as `### role: text</turn>` and a newline; texts and
    roles are escaped reversibly. loss_spans are (start, length) in code points of the assistant texts in `formatted`.
    NULL texts and roles are empty, an empty list of turns gives an empty text, an empty table no rows. Other columns
    are not read. A record stays in its row: nothing is shuffled, and the masks' offsets are sums over its turns.
    """
    schema = records.schema[record_column].dataType
    usable = [layout for layout in layouts if _has(schema, layout)]
    rows = records.select(F.col(id_column), F.col(record_column).alias("__record"))
    rows = rows.withColumn("fingerprint", fingerprint(F.col("__record"), schema))
    name = turns = None
    for layout in usable:
        known = F.col("fingerprint").isin([F.sha2(F.lit("\n".join(paths)), 256) for paths in layout.path_sets()])
        value = canonical_turns(F.col("__record"), schema, layout)
        name = F.when(known, layout.name) if name is None else name.when(known, layout.name)
        turns = F.when(known, value) if turns is None else turns.when(known, value)
    rows = rows.withColumn("layout", F.lit(None).cast("string") if name is None else name)
    rows = rows.withColumn("__turns", F.lit(None).cast(TURNS) if turns is None else turns)
    heads = F.transform("__turns", lambda t: F.concat(F.lit(HEAD), escape(t["role"], _ROLE_ESCAPES), F.lit(MIDDLE)))
    bodies = F.transform("__turns", lambda t: escape(t["text"]))
    rows = rows.withColumn("__heads", heads).withColumn("__bodies", bodies)
    pieces = F.zip_with("__heads", "__bodies", lambda h, b: F.concat(h, b, F.lit(END)))
    ends = running_sum(F.transform(pieces, lambda p: F.length(p)))
    spans = bind(
        F.arrays_zip(F.transform("__turns", lambda t: t["role"]).alias("role"), F.transform("__bodies", lambda b: F.length(b)).alias("n"), ends.alias("end")),
        lambda parts: F.transform(
            F.filter(parts, lambda p: p["role"] == "assistant"),
            lambda p: F.struct((p["end"] - len(END) - p["n"]).alias("start"), p["n"].alias("length")),
        ),
    )
    return rows.select(id_column, "fingerprint", "layout", F.array_join(pieces, "").alias("formatted"), spans.alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text: the inverse of format_chats."""
    parts = F.filter(F.split(formatted, END), lambda p: p != "")

    def turn(part):
        return bind(
            F.split(F.substring(part, len(HEAD) + 1, 2**31 - 1), MIDDLE, 2),
            lambda ab: F.struct(unescape(F.get(ab, 0)).alias("role"), unescape(F.get(ab, 1)).alias("text")),
        )

    return F.transform(parts, turn)


def masked_text(formatted: Column, loss_spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(loss_spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))), "")
