"""Token counts per field or section, from one encoding of the whole document.

The fields of a document are joined and encoded once. Token byte lengths give
every token's character span; the spans are joined to the section intervals by
binary search. A token that lies in several sections is given to one of them by
an explicit rule:

- ``start``: the section of its first character;
- ``end``: the section of its last character;
- ``majority``: the section that holds most of its characters, the earlier one
  if several do.

Section counts so add up to the document's token count.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shoreline.llm.bytebpe import Splitter

RULES = ("start", "end", "majority")


def load_encoding(path: str, pattern: str):
    """A tiktoken encoding from a rank file, and each token's bytes' length."""
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), lengths


_SPLITTERS: dict[str, Splitter] = {}


def _encode_pieces(text: str, encoding) -> np.ndarray:
    pattern = encoding._pat_str
    cut = _SPLITTERS.get(pattern) or _SPLITTERS.setdefault(pattern, Splitter(pattern))
    known: dict[str, list[int]] = {}
    out = []
    for piece in cut.split(text):
        if piece not in known:
            known[piece] = encoding._encode_single_piece(piece)
        out.append(np.array(known[piece], dtype=np.int64))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)


def token_spans(text: str, encoding, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Character spans [start, end) of the tokens of ``text``; a token that
    holds a part of a character spans that character."""
    raw = text.encode("utf-8", "surrogatepass")
    try:
        ids = encoding.encode_to_numpy(text, allowed_special=set(), disallowed_special=()).astype(np.int64)
    except ValueError:  # a run of blanks too long for the library's matcher: cut elsewhere, each piece encoded by the library
        ids = _encode_pieces(text, encoding)
    ends = np.cumsum(lengths[ids])
    if not len(ends):
        return ends, ends
    char = np.cumsum((np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80) - 1
    return char[np.concatenate([[0], ends[:-1]])], char[ends - 1] + 1


def allocate(start: np.ndarray, end: np.ndarray, begins: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(section of each token, whether it lies in several) for sections that
    begin at the ascending positions ``begins`` (the first at 0)."""
    first = np.searchsorted(begins, start, "right") - 1
    last = np.searchsorted(begins, end - 1, "right") - 1
    several = first != last
    if rule == "start" or not several.any():
        return first, several
    if rule == "end":
        return last, several
    out = first.copy()
    for i in np.flatnonzero(several):
        k = np.arange(first[i], last[i] + 1)
        upper = np.append(begins[k[1:]], end[i])
        held = np.minimum(upper, end[i]) - np.maximum(begins[k], start[i])
        out[i] = k[int(held.argmax())]
    return out, several


def sections_of(fields: list[tuple[str, str | None]], sep: str, lines: bool) -> tuple[str, list[tuple[str, int, int]]]:
    """(whole text, [(field, number in the field, begin)]). A section ends where
    the next begins, so separators and line ends belong to what precedes them.
    Null fields are left out; empty sections keep their place."""
    parts, out, at = [], [], 0
    present = [(n, v) for n, v in fields if v is not None]
    for k, (name, value) in enumerate(present):
        value += sep if k < len(present) - 1 else ""
        if lines:
            begin = at
            rows = value.split("\n")
            if k < len(present) - 1 and sep.endswith("\n"):
                rows.pop()  # the separator ends the last line
            for number, row in enumerate(rows):
                out.append((name, number, begin))
                begin += len(row) + 1
        else:
            out.append((name, 0, at))
        parts.append(value)
        at += len(value)
    return "".join(parts), out


_ENCODINGS: dict[tuple[str, str], tuple] = {}
#: Section rows sent on together.
ROWS = 200_000


def _count(path: str, pattern: str, fields: list[str], sep: str, lines: bool, rule: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (path, pattern)
        encoding, lengths = _ENCODINGS.get(key) or _ENCODINGS.setdefault(key, load_encoding(*key))
        for batch in batches:
            names = ["field", "section", "start", "end", "n_tokens", "n_crossing"]
            ids, rows = [], {n: [] for n in names}

            def flush():
                kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
                return pa.RecordBatch.from_arrays([pa.array(ids, batch.column("_id").type),
                                                   *(pa.array(rows[n], k) for n, k in zip(names, kinds))], ["_id", *names])
            columns = [batch.column(f"_f{k}") for k in range(len(fields))]
            for i, doc in enumerate(batch.column("_id")):
                text, parts = sections_of([(n, c[i].as_py()) for n, c in zip(fields, columns)], sep, lines)
                if not parts:
                    continue
                begins = np.array([p[2] for p in parts], dtype=np.int64)
                owner, several = allocate(*token_spans(text, encoding, lengths), begins, rule)
                ids += [doc.as_py()] * len(parts)
                rows["field"] += [p[0] for p in parts]
                rows["section"] += [p[1] for p in parts]
                rows["start"] += begins.tolist()
                rows["end"] += [*begins[1:].tolist(), len(text)]
                rows["n_tokens"] += np.bincount(owner, minlength=len(parts)).tolist()
                rows["n_crossing"] += np.bincount(owner[several], minlength=len(parts)).tolist()
                if len(ids) > ROWS:
                    yield flush()
                    ids, rows = [], {n: [] for n in names}
            yield flush()
    return run


def token_counts(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", fields: tuple[str, ...] = ("text",),
                 sep: str = "\n", lines: bool = False, rule: str = "majority") -> DataFrame:
    """(``id_col``, field, section, start, end, n_tokens, n_crossing): one row
    per field of each document, or with ``lines`` per line of each field.

    The fields are joined by ``sep`` and encoded as one text with the tiktoken
    ranks at ``path``; ``n_crossing`` counts a section's tokens that also lie in
    another one. Null fields give no row, a document of null fields none at
    all; an empty text is one empty section without tokens. Runs of blanks,
    line ends or letters may have any length. Ids may be null or
    repeated; an empty table gives no rows; other columns are not read.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    narrow = docs.select(F.col(f"`{id_col}`").alias("_id"),
                         *[F.col(f"`{f}`").cast("string").alias(f"_f{k}") for k, f in enumerate(fields)])
    kind = dict(narrow.dtypes)["_id"]
    return (narrow.mapInArrow(_count(path, pattern, list(fields), sep, lines, rule),
                              f"_id {kind}, field string, section int, start long, end long, n_tokens long, n_crossing long")
            .withColumnRenamed("_id", id_col))
