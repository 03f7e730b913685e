"""Chat records of any known layout to canonical turns, and turns to a training template that can be read back.

*Layouts.* A record is JSON. The paths of its fields (array steps as ``[]``), sorted, are hashed to a fingerprint that selects a
declarative mapping: where the turns are, which field is the role and which the text, or which top-level fields become which role. New
layouts are rows in ``MAPPINGS``, not code; a record with an unknown fingerprint is returned with it and no turns.

*Template.* ``<s>`` and then the turns: ``[INST]text[/INST]`` for a user, ``<<SYS>>text<</SYS>>`` for a system turn, ``text</s>`` after ``[OUT]`` for
an assistant, ``<<ROLE>>role<</ROLE>>text</s>`` for any other role. Control strings inside a text get a backslash after their first
character (one more where there are some already), so nothing in a text is ever taken for control, and reading takes exactly one off.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import ship

ship(__name__)

# The layouts known. ``turns`` names the array of turns, ``order`` a field to sort them by; ``fields`` gives roles to
# top-level fields in order, joined where two share a role; with ``names`` other names of roles are put into the usual ones.
MAPPINGS = [
    {"paths": ["turns[].role", "turns[].text", "turns[].turn"], "turns": "turns", "role": "role", "text": "text", "order": "turn"},
    {"paths": ["messages[].content", "messages[].role"], "turns": "messages", "role": "role", "text": "content", "names": True},
    {"paths": ["conversations[].from", "conversations[].value"], "turns": "conversations", "role": "from", "text": "value", "names": True},
    {"paths": ["prompt", "response"], "fields": [("user", "prompt"), ("assistant", "response")]},
    {"paths": ["completion", "prompt"], "fields": [("user", "prompt"), ("assistant", "completion")]},
    {"paths": ["instruction", "output"], "fields": [("user", "instruction"), ("assistant", "output")]},
    {"paths": ["input", "instruction", "output"], "fields": [("user", "instruction"), ("user", "input"), ("assistant", "output")]},
    {"paths": ["prompt", "response", "system"], "fields": [("system", "system"), ("user", "prompt"), ("assistant", "response")]},
]
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}

CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "[OUT]", "<<SYS>>", "<</SYS>>", "<<ROLE>>", "<</ROLE>>")
RAW = re.compile("|".join(re.escape(c[0]) + r"\\*" + re.escape(c[1:]) for c in CONTROL))
TOKEN = re.compile("|".join(sorted(map(re.escape, CONTROL), key=len, reverse=True)))


def paths_of(value: object, at: str = "") -> set[str]:
    """Paths of all fields. A name that holds a sign of the paths is quoted, so it is not taken for one."""
    if isinstance(value, dict):
        named = ((k if not re.search(r'[.\[\]"]', k) else json.dumps(k), v) for k, v in value.items())
        return {p for k, v in named for p in paths_of(v, f"{at}.{k}" if at else k)}
    if isinstance(value, list):
        return {p for v in value for p in paths_of(v, f"{at}[]")} or {f"{at}[]"}
    return {at}


def fingerprint_of(paths: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


BY_FINGERPRINT = {fingerprint_of(set(m["paths"])): m for m in MAPPINGS}


def plain(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def place_of(value: object) -> tuple:
    """Sorts turns: nulls first, numbers by value, anything else after them by its text."""
    if value is None:
        return 0, 0, ""
    return (1, value, "") if isinstance(value, int | float) else (2, 0, plain(value))


def turns_of(record: object) -> tuple[str, list[tuple[str, str]] | None]:
    """Fingerprint of a record and its turns (role, text); None where no mapping fits. Null roles and texts are empty.

    A fingerprint is that of all turns together; a record whose turns do not each have all fields fits no mapping.
    """
    mark = fingerprint_of(paths_of(record))
    mapping = BY_FINGERPRINT.get(mark)
    if mapping is None:
        return mark, None
    if "fields" in mapping:
        out: list[tuple[str, str]] = []
        for role, name in mapping["fields"]:
            text = plain(record[name])
            if out and out[-1][0] == role:
                text = f"{out.pop()[1]}\n{text}" if text else out.pop()[1]
            out.append((role, text))
        return mark, out
    rows = record[mapping["turns"]]
    needed = {mapping["role"], mapping["text"], mapping.get("order", mapping["role"])}
    if not all(isinstance(r, dict) and needed <= set(r) for r in rows):
        return mark, None
    if "order" in mapping:
        rows = sorted(rows, key=lambda r: place_of(r[mapping["order"]]))
    names = ROLES if mapping.get("names") else {}
    roles = [plain(r[mapping["role"]]) for r in rows]
    return mark, [(names.get(role, role), plain(r[mapping["text"]])) for role, r in zip(roles, rows, strict=True)]


def escape(text: str) -> str:
    return RAW.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return RAW.sub(lambda m: m[0][0] + m[0][2:] if m[0][1] == "\\" else m[0], text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """Formatted text, and the loss mask: start and end of each assistant text in it."""
    parts, mask, at = ["<s>"], [], 3
    for role, text in turns:
        own = escape(text)
        before, after = {"user": ("[INST]", "[/INST]"), "system": ("<<SYS>>", "<</SYS>>"), "assistant": ("[OUT]", "</s>")}.get(role) or (f"<<ROLE>>{escape(role)}<</ROLE>>", "</s>")
        if role == "assistant":
            mask.append((at + len(before), at + len(before) + len(own)))
        at += len(before) + len(own) + len(after)
        parts += [before, own, after]
    return "".join(parts), mask


def parse(formatted: str) -> list[tuple[str, str]]:
    """Turns of a formatted text."""
    out: list[tuple[str, str]] = []
    ends = {"[INST]": ("[/INST]", "user"), "<<SYS>>": ("<</SYS>>", "system"), "[OUT]": ("</s>", "assistant")}
    marks = list(TOKEN.finditer(formatted))
    i = 1
    while i < len(marks):
        open_, close = marks[i], marks[i + 1]
        role = None
        if open_[0] == "<<ROLE>>":
            role, open_, close = unescape(formatted[open_.end() : close.start()]), close, marks[i + 2]
            i += 1
        else:
            expected, role = ends[open_[0]]
            assert close[0] == expected, "a turn is not closed"
        out.append((role, unescape(formatted[open_.end() : close.start()])))
        i += 2
    return out


def format_records(records: DataFrame) -> DataFrame:
    """record_id, fingerprint, formatted, mask (start, end of assistant texts) of JSON records (record_id, record).

    ``record_id`` keeps its type; other columns are ignored. Records that are null, no JSON or of an unknown layout come back with null
    ``formatted`` and ``mask`` (the fingerprint tells layouts apart; it is null without JSON). JSON nested too deeply to be read counts as
    none, a text with half a surrogate pair as an unknown layout. Turns with equal numbers stay in the order of the record.
    Repeated rows are formatted each for itself.
    """
    kind = records.schema["record_id"].dataType.simpleString()
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks, texts, masks = [], [], []
            for raw in batch.column(1).to_pylist():
                try:
                    mark, turns = turns_of(json.loads(raw)) if raw is not None else (None, None)
                except (ValueError, RecursionError):
                    mark, turns = None, None
                text, mask = render(turns) if turns is not None else (None, None)
                try:
                    (text or "").encode()
                except UnicodeEncodeError:
                    text, mask = None, None
                marks.append(mark)
                texts.append(text)
                masks.append(None if mask is None else [{"start": a, "end": b} for a, b in mask])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks, pa.string()), pa.array(texts, pa.string()), pa.array(masks, spans)], ["record_id", "fingerprint", "formatted", "mask"])

    return records.select("record_id", "record").mapInArrow(run, f"record_id {kind}, fingerprint string, formatted string, mask array<struct<start:bigint,end:bigint>>")


def records_of(rows: DataFrame) -> DataFrame:
    """One record for each conversation of a table of turns (conv_id, turn, role, text): its rows, sorted when they are mapped.

    A conversation is one output row, so its turns meet in one task; conversations themselves are spread by hash. Null conv_ids are
    one conversation; turns with the same number are ordered by role, then text.
    """
    turn = F.struct("turn", "role", "text")
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return grouped.select(F.col("conv_id").alias("record_id"), F.to_json(F.struct("turns"), {"ignoreNullFields": "false"}).alias("record"))


def digests(formatted: DataFrame) -> DataFrame:
    """record_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back from ``format_records``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for text, mask in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                turns = parse(text)
                loss = "".join(unescape(text[m["start"] : m["end"]]) for m in mask)
                said = "".join(f"{role}\n{t}\n" for role, t in turns)
                values = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text))
                for c, v in zip(out, values, strict=True):
                    c.append(v)
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            names = ["record_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))], names)

    kind = formatted.schema["record_id"].dataType.simpleString()
    known = formatted.where("formatted IS NOT NULL").select("record_id", "formatted", "mask")
    return known.mapInArrow(run, f"record_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
