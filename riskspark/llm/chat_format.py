"""Chat formatting with schema fingerprints, in DataFrame functions only.

``fingerprint`` hashes the sorted nested field paths of a layout. ``MAPPINGS``
holds, per fingerprint, a declarative mapping to canonical turns
(conv_id, turn, role, text): which column or array gives the turns, which field
the role and which the text. ``canonical_turns`` fingerprints the schema of a
whole table; ``canonical_json`` fingerprints every row of a column of JSON
texts (the paths of its variant value), so that rows of several layouts mix in one table.
A layout without mapping is not guessed: the table raises, a JSON row gets
``layout`` null and no turns.

``render`` writes a conversation as one text. A turn is
``<|turn:ROLE|>TEXT<|end|>``. Control strings inside roles and texts are escaped
reversibly: ``&`` becomes ``&amp;``, then the first character of each control
string of ``CONTROL`` becomes a character reference. ``read_back`` splits the
text at its marks and undoes that. ``loss_spans`` are the (start, length) in
code points of the assistant texts in the formatted text.

Defined cases: a null text is the empty text; a null role is the empty role; a
null turn comes first; rows with one turn number follow by role, then text; a
repeated row is a turn of its own; rows without conv_id form one conversation;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.common import table

# Control strings of common chat templates, with what stands for them.
CONTROL = (
    ("<|", "&lt;|"), ("|>", "&#124;>"), ("<s>", "&lt;s>"), ("</s>", "&lt;/s>"), ("[INST]", "&#91;INST]"),
    ("[/INST]", "&#91;/INST]"), ("<<SYS>>", "&lt;&lt;SYS>>"), ("<</SYS>>", "&lt;&lt;/SYS>>"),
    ("<start_of_turn>", "&lt;start_of_turn>"), ("<end_of_turn>", "&lt;end_of_turn>"),
)
REFERENCES = (("&lt;", "<"), ("&#124;", "|"), ("&#91;", "["), ("&amp;", "&"))
OPEN, CLOSE, END = "<|turn:", "|>", "<|end|>"
SPECIAL = "</s>[INST] ok [/INST]"


def field_paths(kind: T.DataType, top: str = "") -> list[str]:
    """Nested field paths of a type, arrays as ``[]``: ``messages[].role``."""
    if isinstance(kind, T.StructType):
        return [p for f in kind for p in field_paths(f.dataType, f"{top}.{f.name}" if top else f.name)]
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, f"{top}[]")
    return [top]


def fingerprint(paths: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


@dataclass(frozen=True)
class Mapping:
    """``turns``: the array of turns with the fields ``role`` and ``text``; or
    ``fields``: (role, columns) in order, blank ones left out, joined by a blank line;
    or ``rows``: a row is a turn already."""
    name: str
    paths: tuple[str, ...]
    turns: str = ""
    role: str = ""
    text: str = ""
    fields: tuple[tuple[str, tuple[str, ...]], ...] = ()
    rows: bool = False


LAYOUTS = (
    Mapping("rows", ("conv_id", "turn", "role", "text"), rows=True),
    Mapping("messages", ("conv_id", "messages[].role", "messages[].content"), "messages", "role", "content"),
    Mapping("from_value", ("conv_id", "conversations[].from", "conversations[].value"), "conversations", "from", "value"),
    Mapping("prompt_response", ("conv_id", "prompt", "response"),
            fields=(("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping("prompt_completion", ("conv_id", "prompt", "completion"),
            fields=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Mapping("question_answer", ("conv_id", "system", "question", "answer"),
            fields=(("system", ("system",)), ("user", ("question",)), ("assistant", ("answer",)))),
    Mapping("instruction", ("conv_id", "instruction", "output"),
            fields=(("user", ("instruction",)), ("assistant", ("output",)))),
    Mapping("instruction_input", ("conv_id", "instruction", "input", "output"),
            fields=(("user", ("instruction", "input")), ("assistant", ("output",)))),
)
MAPPINGS = {fingerprint(list(m.paths)): m for m in LAYOUTS}
#: Lists of turns with the paths that layouts read from them, and all paths that a JSON row's fingerprint is made of.
LISTS = {m.turns: [p for x in LAYOUTS if x.turns == m.turns for p in x.paths if p != "conv_id"] for m in LAYOUTS if m.turns}
VOCABULARY = sorted({p for m in LAYOUTS if not m.rows for p in m.paths} - {"conv_id"} | {f"{name}[]" for name in LISTS})
#: Roles of other layouts under their canonical names.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def _role(role: Column) -> Column:
    named = F.create_map(*[F.lit(x) for kv in ROLES.items() for x in kv])
    role = F.coalesce(role, F.lit(""))
    return F.coalesce(F.try_element_at(named, role), role)


def _turns(m: Mapping, get) -> Column:
    """Array of (turn, role, text); ``get`` gives a field of the row."""
    if m.turns:
        return F.transform(get(m.turns), lambda x, i: F.struct(
            i.cast("long").alias("turn"), _role(x[m.role]).alias("role"), F.coalesce(x[m.text], F.lit("")).alias("text")))
    parts = [(role, F.array_join(F.filter(F.array(*[get(c) for c in cols]), lambda x: F.coalesce(x, F.lit("")) != ""),
                                 "\n\n")) for role, cols in m.fields]
    made = [F.struct(F.lit(i).cast("long").alias("turn"), F.lit(role).alias("role"), text.alias("text"))
            for i, (role, text) in enumerate(parts)]
    # a blank system turn is no turn; a blank question or answer is one
    return F.filter(F.array(*made), lambda x: (x["role"] != "system") | (x["text"] != ""))


def canonical_turns(df: DataFrame, drop_unknown: bool = False) -> DataFrame:
    """Rows (conv_id, turn, role, text) of a table in one of the known layouts.
    ``drop_unknown``: columns that no layout of the table's other columns has are ignored."""
    paths = field_paths(df.schema)
    m = MAPPINGS.get(fingerprint(paths))
    if m is None and drop_unknown:
        fit = [x for x in LAYOUTS if set(x.paths) <= set(paths)]
        m = max(fit, key=lambda x: len(x.paths), default=None)
    if m is None:
        raise ValueError(f"no mapping for the layout {sorted(paths)}")
    if m.rows:
        return df.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                         F.coalesce("text", F.lit("")).alias("text"))
    return df.select("conv_id", F.inline(_turns(m, F.col)))


def _json_paths(body: Column) -> Column:
    """The field paths of a JSON object that layouts know, sorted. An empty or null list has all fields that
    layouts read from it; an element that is no object gives the path of the list itself."""
    keys = F.coalesce(F.map_keys(F.try_variant_get(body, "$", "map<string,variant>")), F.array().cast("array<string>"))
    paths = F.filter(keys, lambda k: ~k.isin(*LISTS))
    for name, known in LISTS.items():
        inner = F.flatten(F.transform(_elements(body, name), lambda x: F.coalesce(
            F.transform(F.map_keys(F.try_variant_get(x, "$", "map<string,variant>")), lambda k: F.concat(F.lit(f"{name}[]."), k)),
            F.array(F.lit(f"{name}[]")))))
        empty = F.coalesce(F.size(_elements(body, name)), F.lit(0)) <= 0
        found = F.when(empty, F.array(*[F.lit(p) for p in known])).otherwise(inner)
        paths = F.concat(paths, F.when(F.array_contains(keys, name), found).otherwise(F.array().cast("array<string>")))
    return F.array_sort(F.array_intersect(paths, F.array(*[F.lit(p) for p in VOCABULARY])))


def _elements(body: Column, name: str) -> Column:
    return F.try_variant_get(body, f"$.{name}", "array<variant>")


def canonical_json(df: DataFrame, payload: str, id_col: str = "conv_id") -> DataFrame:
    """``id_col``, ``layout`` and ``turns`` of every row; each row's JSON text has a layout of its own.

    The fingerprint is that of the row's paths alone: value types, nulls and keys that no layout has don't
    count. A value that is no string is its JSON text, a null or absent one the empty text; an empty
    or null list gives a layout and no turns. A row with paths of several layouts at once, or
    with an element of a list that is no object, has no layout."""
    body = F.try_parse_json(F.col(payload))
    shape = F.substr(F.sha2(F.array_join(_json_paths(F.col("_body")), "\n"), 256), F.lit(1), F.lit(16))
    with_shape = df.select(F.col(id_col), body.alias("_body")).withColumn("_shape", shape)
    none = F.array().cast("array<struct<turn:long,role:string,text:string>>")
    pick_name, pick_turns = F.lit(None).cast("string"), F.lit(None).cast("array<struct<turn:long,role:string,text:string>>")
    for m in LAYOUTS:
        if m.rows:
            continue

        def get(c, m=m):
            if not m.turns:
                return F.try_variant_get("_body", f"$.{c}", "string")
            return F.transform(_elements(F.col("_body"), c), lambda x: F.struct(
                *[F.try_variant_get(x, f"$.{f}", "string").alias(f) for f in (m.role, m.text)]))
        hit = F.col("_shape") == fingerprint([p for p in m.paths if p != "conv_id"])
        pick_name = F.when(hit, m.name).otherwise(pick_name)
        pick_turns = F.when(hit, F.coalesce(_turns(m, get), none)).otherwise(pick_turns)
    return with_shape.select(id_col, pick_name.alias("layout"), pick_turns.alias("turns"))


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("&"), F.lit("&amp;"))
    for control, reference in CONTROL:
        text = F.replace(text, F.lit(control), F.lit(reference))
    return text


def unescape(text: Column) -> Column:
    for reference, plain in REFERENCES:
        text = F.replace(text, F.lit(reference), F.lit(plain))
    return text


def render(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans of canonical turns."""
    rows = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    packed = turns.groupBy("conv_id").agg(rows.alias("turns"))
    pieces = packed.select("conv_id", F.transform("turns", lambda x: F.struct(
        (x["role"] == "assistant").alias("learn"), F.concat(F.lit(OPEN), escape(x["role"]), F.lit(CLOSE)).alias("head"),
        escape(x["text"]).alias("body"))).alias("pieces"))
    start = F.struct(F.lit(0).cast("long").alias("at"),
                     F.array().cast("array<struct<start:long,length:long>>").alias("spans"))

    def step(state: Column, p: Column) -> Column:
        begin = state["at"] + F.length(p["head"])
        size = F.length(p["body"]).cast("long")
        span = F.array(F.struct(begin.alias("start"), size.alias("length")))
        return F.struct((begin + size + len(END)).alias("at"),
                        F.when(p["learn"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    return pieces.select(
        "conv_id",
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "").alias("formatted"),
        F.aggregate("pieces", start, step, lambda s: s["spans"]).alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (array of role, text) and loss_text, from ``formatted`` and ``loss_spans`` alone."""
    marks = F.filter(F.split("formatted", END.replace("|", "\\|")), lambda x: x != "")
    turns = F.transform(marks, lambda x: F.struct(
        unescape(F.substr(F.substring_index(x, CLOSE, 1), F.lit(len(OPEN) + 1))).alias("role"),
        unescape(F.substr(x, F.length(F.substring_index(x, CLOSE, 1)) + len(CLOSE) + 1)).alias("text")))
    learned = F.array_join(F.transform("loss_spans", lambda s: unescape(
        F.substr("formatted", (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
    return formatted.select("conv_id", "formatted", "loss_spans", turns.alias("turns"), learned.alias("loss_text"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, formatted and read back."""
    own = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(SPECIAL).alias("text"))
    given = canonical_turns(table(spark, sf_dir, "conversations"), drop_unknown=True)
    back = read_back(render(given.unionByName(canonical_turns(own))))
    text = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(text, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def _sql_escape(col: str) -> str:
    out = f"replace({col}, '&', '&amp;')"
    for control, reference in CONTROL:
        out = f"replace({out}, '{control}', '{reference}')"
    return out


OP4_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{SPECIAL}' UNION ALL SELECT -1, 1, 'assistant', '{SPECIAL}')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({len(OPEN) + len(CLOSE) + len(END)} + length({_sql_escape('role')}) + length({_sql_escape('text')})) AS BIGINT)
    AS formatted_chars
FROM t GROUP BY conv_id
"""
