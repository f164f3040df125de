"""Chat formatting of records with different layouts.

A record is a JSON object. Its schema fingerprint is the hash of its sorted nested field paths (array elements are
written []); the fingerprint selects one of the declarative mappings, once per fingerprint and worker, and the
mapping reads canonical turns (role, text) out of the record. A template then marks the turns. Control strings inside
texts are escaped reversibly, so no text can open or close a turn, and the loss mask lists the character spans of
assistant texts. parse() reads turns and masked text back.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, materialize, pick, worker_store

#: Strings that templates give a meaning to; none is left intact inside a text.
CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>", "<|end|>", "<|start_header_id|>", "<|end_header_id|>", "<|eot_id|>", "<start_of_turn>", "<end_of_turn>"]
_OPENS = re.compile("([<\\[])(?=" + "|".join(re.escape(c[1:]) for c in CONTROLS) + ")")
_CLOSES = re.compile(r"\\([\\\-n])")
BEGIN, END = "<|im_start|>", "<|im_end|>\n"


@dataclass(frozen=True)
class Mapping:
    """How a layout is read: `needs` are paths that must exist, `turns` gives role and path of single fields in order,
    `rows` the array, role and text fields of message lists, `roles` other names of roles."""

    name: str
    needs: frozenset[str]
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    rows: tuple[str, str, str] | None = None
    roles: dict[str, str] = field(default_factory=dict, hash=False)


ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
#: Tried in this order; the first whose paths exist is taken.
MAPPINGS = (
    Mapping("messages", frozenset({"messages[].role", "messages[].content"}), rows=("messages", "role", "content")),
    Mapping("conversations", frozenset({"conversations[].from", "conversations[].value"}), rows=("conversations", "from", "value"), roles=ROLES),
    Mapping("dialog", frozenset({"dialog[].speaker", "dialog[].text"}), rows=("dialog", "speaker", "text"), roles=ROLES),
    Mapping("instruction", frozenset({"instruction", "output"}), turns=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
    Mapping("prompt_completion", frozenset({"prompt", "completion"}), turns=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",)))),
    Mapping("prompt_response", frozenset({"prompt", "response"}), turns=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping("question_answer", frozenset({"question", "answer"}), turns=(("system", ("context",)), ("user", ("question",)), ("assistant", ("answer",)))),
    Mapping("nested_prompt", frozenset({"data.prompt", "data.completion"}), turns=(("user", ("data.prompt",)), ("assistant", ("data.completion",)))),
)


def paths(value, prefix: str = "") -> set[str]:
    """Nested field paths of a JSON value: leaves only, empty lists and objects counting as leaves."""
    if isinstance(value, dict) and value:
        return set().union(*(paths(v, f"{prefix}.{k}" if prefix else k) for k, v in value.items()))
    if isinstance(value, list) and value:
        return set().union(*(paths(v, f"{prefix}[]") for v in value))
    return {prefix}


def fingerprint(found: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()[:16]


def mapping_of(found: set[str]) -> Mapping | None:
    return next((m for m in MAPPINGS if m.needs <= found), None)


def _at(record, path: str):
    for k in path.split("."):
        record = record.get(k) if isinstance(record, dict) else None
    return record


def _text(value) -> str:
    return value if isinstance(value, str) else "" if value is None else json.dumps(value, ensure_ascii=False)


def turns_of(record: dict, m: Mapping) -> list[tuple[str, str]]:
    """Canonical turns; single fields that are missing or empty give none, apart from the user's and the assistant's."""
    if m.rows:
        at, role, text = m.rows
        rows = [x for x in record.get(at) or [] if isinstance(x, dict)]
        return [(m.roles.get(r := _text(x.get(role)), r), _text(x.get(text))) for x in rows]
    out = []
    for role, fields in m.turns:
        parts = [_text(_at(record, p)) for p in fields]
        text = "\n\n".join(p for p in parts if p)
        if text or role != "system":
            out.append((role, text))
    return out


def escape(text: str) -> str:
    return _OPENS.sub(r"\1\\-", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _CLOSES.sub(lambda m: {"\\": "\\", "-": "", "n": "\n"}[m[1]], text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[int], list[int]]:
    """Formatted text and the begins and ends of its assistant texts."""
    out, begins, ends, at = [], [], [], 0
    for role, text in turns:
        head = f"{BEGIN}{escape(role).replace('\n', '\\n')}\n"
        body = escape(text)
        if role == "assistant":
            begins.append(at + len(head))
            ends.append(at + len(head) + len(body))
        out += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(out), begins, ends


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text."""
    out = []
    for part in formatted.split(END)[:-1]:
        if not part.startswith(BEGIN):
            raise ValueError("a turn doesn't open where the last one closed")
        role, _, text = part[len(BEGIN) :].partition("\n")
        out.append((unescape(role), unescape(text)))
    return out


def format_records(records: DataFrame) -> DataFrame:
    """Formatted text and loss mask of records (id, record: JSON), one row per row.

    Records that are null, broken or of no known layout keep their row with a null mapping and no text. Null texts
    and roles are empty. Extra columns are ignored; in JSON, extra fields change the fingerprint, not the mapping.
    """
    arrow = pa.schema([("id", pa.int64()), ("fingerprint", pa.string()), ("mapping", pa.string()), ("formatted", pa.string()), ("loss_begin", pa.list_(pa.int32())), ("loss_end", pa.list_(pa.int32()))])

    def one(i, raw) -> dict:
        try:
            record = json.loads(raw) if raw else None
        except ValueError:
            record = None
        if not isinstance(record, dict):
            return {"id": i, "fingerprint": None, "mapping": None, "formatted": None, "loss_begin": [], "loss_end": []}
        found = paths(record)
        key = fingerprint(found)
        known = worker_store("layouts")
        if len(known) > 10_000:
            known.clear()
        if key not in known:
            m = mapping_of(found)
            known[key] = MAPPINGS.index(m) if m else -1
        if known[key] < 0:
            return {"id": i, "fingerprint": key, "mapping": None, "formatted": None, "loss_begin": [], "loss_end": []}
        m = MAPPINGS[known[key]]
        text, begins, ends = render(turns_of(record, m))
        return {"id": i, "fingerprint": key, "mapping": m.name, "formatted": text, "loss_begin": begins, "loss_end": ends}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (one(*r) for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        for held in chunks(rows, lambda r: len(r["formatted"] or "") + 100, 4 << 20):
            yield pa.RecordBatch.from_pylist(held, schema=arrow)

    return pick(records, id="id bigint", record="record string").mapInArrow(run, "id bigint, fingerprint string, mapping string, formatted string, loss_begin array<int>, loss_end array<int>")


def conversation_records(rows: DataFrame) -> DataFrame:
    """(id, record) in the messages layout from rows (conv_id, turn, role, text), by turn, then role, then text."""
    r = pick(rows, conv_id="conv_id bigint", turn="turn bigint", role="role string", text="text string")
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("content"))
    messages = F.transform(F.array_sort(F.collect_list(turn)), lambda x: F.struct(x.role.alias("role"), x.content.alias("content")))
    return r.groupBy("conv_id").agg(messages.alias("messages")).select(F.col("conv_id").alias("id"), F.to_json(F.struct("messages")).alias("record"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of turns and of the text under the loss mask, from format_records' output alone."""
    arrow = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, text, begins, ends in zip(*(c.to_pylist() for c in b.columns), strict=True):
                turns = parse(text)
                loss = "".join(unescape(text[a:e]) for a, e in zip(begins, ends, strict=True))
                every = "".join(f"{r}\n{t}\n" for r, t in turns)
                rows.append({"conv_id": i, "n_turns": len(turns), "turns_sha256": hashlib.sha256(every.encode()).hexdigest(), "loss_chars": len(loss), "loss_sha256": hashlib.sha256(loss.encode()).hexdigest(), "formatted_chars": len(text)})
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return formatted.where("formatted is not null").select("id", "formatted", "loss_begin", "loss_end").mapInArrow(run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


SAID = "</s>[INST] ok [/INST]"


def op7_chat_format(spark, sf_dir: str) -> DataFrame:
    from .common import table

    extra = spark.createDataFrame([(-1, 0, "user", SAID), (-1, 1, "assistant", SAID)], "conv_id bigint, turn bigint, role string, text string")
    rows = pick(table(spark, sf_dir, "conversations"), conv_id="conv_id bigint", turn="turn bigint", role="role string", text="text string").unionByName(extra)
    return read_back(materialize(format_records(conversation_records(rows)), "chat"))


_ESCAPED = r"replace(T, '\', '\\')"
for _c in CONTROLS:
    _ESCAPED = f"replace({_ESCAPED}, '{_c}', '{_c[0]}\\-{_c[1:]}')"
SQL = rf"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '{SAID}'), (-1, 1, 'assistant', '{SAID}'))
),
e AS (SELECT *, length({_ESCAPED.replace('T', 'text', 1)}) + length(replace({_ESCAPED.replace('T', 'role', 1)}, chr(10), '\n')) + {len(BEGIN) + 1 + len(END)} AS shown FROM c)
SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(count(*) AS BIGINT) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
    CAST(sum(shown) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
