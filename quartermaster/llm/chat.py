"""Chat formatting by columnar byte assembly.

A turn becomes `<|role|>` newline, its text, `<|end|>` newline. Control
strings inside texts (`<|`, `<s>`, `</s>`, `[INST]`, `[/INST]`) are broken by
a backslash after their first character; backslashes already there count as
part of the string and get one more, so the escape can be undone exactly.

A batch is assembled at once: the lengths of all headers, texts and ends give
every segment's place by a cumulative sum, and three scatter copies fill one
preallocated buffer that becomes the Arrow column's data.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermaster.llm.common import texts_of

#: The control strings after their first character.
CONTROL = r"(\||/?s>|/?INST\])"
END = b"<|end|>\n"
ROWS_AT_A_TIME = 500


def escape_column(col: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(pc.fill_null(col, ""), r"([<\[])(\\*)" + CONTROL, r"\1\\\2\3")


def unescape(text: str) -> str:
    return re.sub(r"([<\[])\\(\\*)" + CONTROL, r"\1\2\3", text)


def headers_of(roles: pa.Array) -> pa.Array:
    r = pc.fill_null(roles, "")
    for a, b in (("\\", "\\\\"), ("|", "\\p"), ("\n", "\\n")):
        r = pc.replace_substring(r, a, b)
    return pc.binary_join_element_wise("<|", r, "|>\n", "")


def role_of(header: str) -> str:
    return re.sub(r"\\(.)", lambda m: {"p": "|", "n": "\n"}.get(m[1], m[1]), header)


def assemble(first: np.ndarray, roles: pa.Array, texts: pa.Array):
    """first: the turn at which each conversation begins (n + 1 values).
    Returns the formatted column and, for each turn, the code points at which
    its text begins and ends within its conversation."""
    parts = [texts_of(headers_of(roles)), texts_of(escape_column(texts))]
    sizes = np.stack([np.diff(parts[0][1]), np.diff(parts[1][1]), np.full(len(roles), len(END))], axis=1)
    place = np.concatenate(([0], np.cumsum(sizes.ravel())))
    out = np.empty(int(place[-1]), np.uint8)
    at = place[:-1].reshape(-1, 3)
    for k, (data, offs) in enumerate(parts):
        out[np.arange(len(data)) + np.repeat(at[:, k] - offs[:-1], np.diff(offs))] = data
    out[(at[:, 2, None] + np.arange(len(END))).ravel()] = np.tile(np.frombuffer(END, np.uint8), len(at))
    bounds = np.append(at[:, 0], place[-1])[first]
    formatted = pa.Array.from_buffers(pa.large_string(), len(first) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(out)])
    points = np.concatenate(([0], np.cumsum((out & 0xC0) != 0x80)))
    begin = np.repeat(points[bounds[:-1]], np.diff(first))
    return formatted, points[at[:, 1]] - begin, points[at[:, 2]] - begin


def format_conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", learn: str = "assistant") -> DataFrame:
    """One row for each conversation: `id_col`, formatted, loss (array of
    start, end in code points: the texts of the role `learn`, in order).

    Rows are taken by turn (null first), ties by role and text; null roles
    and texts are empty; repeated rows are repeated turns; a null id is a
    conversation of its own; an empty table gives an empty result; other
    columns are not read, whatever their names.
    """
    rows = turns.groupBy(F.col(id_col).alias("id")).agg(F.sort_array(F.collect_list(F.struct(
        F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text")))).alias("turns"))
    kind = rows.schema["id"].dataType.simpleString()
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def run(batches):
        for whole in batches:
            for i in range(0, whole.num_rows, ROWS_AT_A_TIME):
                b = whole.slice(i, ROWS_AT_A_TIME)
                col = b.column("turns")
                first = np.concatenate(([0], np.cumsum(pc.list_value_length(col).to_numpy(zero_copy_only=False))))
                flat = col.flatten()
                roles, texts = flat.field("role"), flat.field("text")
                formatted, start, end = assemble(first, roles, texts)
                mine = pc.fill_null(pc.equal(roles, learn), False).to_numpy(zero_copy_only=False)
                offs = np.concatenate(([0], np.cumsum(mine)))[first].astype(np.int32)
                loss = pa.ListArray.from_arrays(pa.array(offs), pa.StructArray.from_arrays(
                    [pa.array(start[mine]), pa.array(end[mine])], fields=list(span)))
                yield pa.RecordBatch.from_arrays([b.column("id"), formatted.cast(pa.string()), loss], [id_col, "formatted", "loss"])

    return rows.mapInArrow(run, f"`{id_col}` {kind}, formatted string, loss array<struct<start: bigint, end: bigint>>")


def turns_of(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns that were formatted."""
    out, at = [], 0
    while at < len(formatted):
        head = formatted.index("|>\n", at)
        end = formatted.index("<|", head)
        out.append((role_of(formatted[at + 2:head]), unescape(formatted[head + 3:end])))
        at = end + len(END)
    return out


def read_back(formatted: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Digests of what the formatted texts and their loss spans say."""
    kind = formatted.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            n, turns, chars, loss, size = [], [], [], [], []
            spans = b.column("loss")
            for i, text in enumerate(b.column("formatted").to_pylist()):
                all_ = turns_of(text)
                learnt = "".join(unescape(text[x["start"]:x["end"]]) for x in spans[i].as_py())
                n.append(len(all_)), chars.append(len(learnt)), size.append(len(text))
                turns.append(hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in all_).encode()).hexdigest())
                loss.append(hashlib.sha256(learnt.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(id_col), pa.array(n, pa.int64()), pa.array(turns, pa.string()), pa.array(chars, pa.int64()),
                 pa.array(loss, pa.string()), pa.array(size, pa.int64())],
                [id_col, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.select(id_col, "formatted", "loss").mapInArrow(
        run, f"`{id_col}` {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
