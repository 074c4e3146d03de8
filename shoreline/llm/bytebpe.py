"""Byte-level BPE by longest matches and backtracking.

A rank file lists byte strings; two neighbours merge whenever their joined
bytes are listed, lowest rank first, of equal ranks the leftmost. Merges of a
piece are never run here. Its bytes are read as Latin-1 characters by an
Aho-Corasick automaton, which gives the longest token beginning at each
position. Tokens are then laid from left to right, longest first; a token may
follow another only if merging the bytes of both would end with just these two
(remembered per pair). Where nothing fits, the position is marked as a dead end
and the token before it is shortened. The segmentation whose neighbours all
fit is the one that merging yields, a prefix has only one, so every position
is a dead end at most once: the time grows with the piece's length.

Texts are never shuffled: one narrow stage, in which each worker remembers a
bounded number of pieces and pairs.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

#: Pieces and pairs a worker remembers before it forgets, and the longest piece (characters) it keeps.
REMEMBERED, PAIRS, LONGEST = 600_000, 4_000_000, 256
#: Texts encoded together, by characters: bounds what a task holds beside its batch.
GROUP_CHARS = 2_000_000

_L = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
_N = "0-9\xb2\xb3\xb9\xbc-\xbe"
_S = "\t-\r \x85\xa0"
#: What the public pattern means on texts of Latin-1 characters only, with its classes written out.
LATIN = {public_tokenizers.PATTERN: re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")}


class Splitter:
    """Cuts texts into the pieces that tiktoken's matches of ``pattern`` are.

    tiktoken and the regex module may follow different Unicode versions. A
    character that they class differently is shown to the pattern as one that
    both class as tiktoken does."""

    #: (class, a member on which all versions agree and which no contraction uses)
    STANDINS = ((r"\p{L}", "ā"), (r"\p{N}", "٣"), (r"\s", " "))
    OTHER = ""

    def __init__(self, pattern: str):
        self.pattern = pattern
        self.latin = LATIN.get(pattern)
        self.general = regex.compile(pattern)
        self._swaps: dict[int, str] | None = None

    @property
    def swaps(self) -> dict[int, str]:
        """Code point -> stand-in, for the characters classed differently."""
        if self._swaps is None:
            import tiktoken
            every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
            single = {bytes([i]): i for i in range(256)}
            theirs, ours = {}, {}
            for name, standin in self.STANDINS:
                asked = tiktoken.Encoding("class", pat_str=name, mergeable_ranks=single, special_tokens={})
                theirs.update(dict.fromkeys(bytes(asked.encode_ordinary(every)).decode(), standin))
                ours.update(dict.fromkeys(regex.findall(name, every), standin))
            self._swaps = {ord(c): theirs.get(c, self.OTHER) for c in theirs.keys() | ours.keys()
                           if theirs.get(c) != ours.get(c)}
        return self._swaps

    def split(self, text: str) -> list[str]:
        if self.latin is not None:
            try:
                text.encode("latin-1")
                return self.latin.findall(text)
            except UnicodeEncodeError:
                pass
        shown = text.translate(self.swaps)
        if shown == text:
            return [m.group() for m in self.general.finditer(text)]
        return [text[m.start():m.end()] for m in self.general.finditer(shown)]


class BacktrackEncoder:
    """Encoder of byte strings for a rank file."""

    def __init__(self, ranks: dict[bytes, int]):
        missing = [i for i in range(256) if bytes([i]) not in ranks]
        if missing:
            raise ValueError(f"ranks lack {len(missing)} single bytes")
        self.ranks = ranks
        self.bytes = {t: b for b, t in ranks.items()}
        self.parts: dict[int, tuple[int, int]] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        usable: dict[bytes, int] = {}
        for token in sorted(self.bytes):
            raw = self.bytes[token]
            if len(raw) > 1:
                halves = self._merged(raw, token)
                if len(halves) != 2:
                    continue  # no merge makes it: it stands only for a piece that equals it
                self.parts[token] = (ranks[halves[0]], ranks[halves[1]])
            usable[raw] = token
        self.length = {t: len(b) for b, t in usable.items()}
        #: the longest shorter token that begins a token
        self.shorter = {t: next((usable[b[:n]] for n in range(len(b) - 1, 0, -1) if b[:n] in usable), None)
                        for b, t in usable.items()}
        self.automaton = ahocorasick.Automaton()
        for raw, token in usable.items():
            self.automaton.add_word(raw.decode("latin-1"), (token, len(raw)))
        self.automaton.make_automaton()

    def _merged(self, raw: bytes, below: int) -> list[bytes]:
        """The parts of a token's bytes after the merges of lower rank."""
        rank = self.ranks.get
        parts = [raw[i:i + 1] for i in range(len(raw))]
        while len(parts) > 2:
            found = [rank(a + b, below) for a, b in zip(parts, parts[1:])]
            least = min(found)
            if least >= below:
                break
            i = found.index(least)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _fits(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens ends with these two. Goes
        back in time along the border: a part lives until the merge that takes
        it up, and its neighbours must not merge while both live."""
        ranks, raw, parts = self.ranks, self.bytes, self.parts
        left_until = right_until = float("inf")
        while True:
            rank = ranks.get(raw[left] + raw[right])
            # of equal merges the leftmost goes first: one inside `left` before ours, one inside `right` after it
            if rank is not None and rank < left_until and rank <= right_until:
                return False
            made_left = left if left in parts else -1
            made_right = right if right in parts else -1
            if made_left == made_right == -1:
                return True
            if made_left > made_right:
                left_until, left = left, parts[left][1]
            else:
                right_until, right = right, parts[right][0]

    def encode(self, raw: bytes) -> list[int]:
        """Token ids of one piece."""
        whole = self.ranks.get(raw)
        if whole is not None or not raw:
            return [whole] if raw else []
        n = len(raw)
        longest: list[int] = [0] * n
        for end, (token, size) in self.automaton.iter(raw.decode("latin-1")):
            longest[end + 1 - size] = token  # ends ascend, so the longest stays
        length, shorter, pairs = self.length, self.shorter, self.pairs
        dead = bytearray(n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while at < n:
            while token is not None:
                end = at + length[token]
                if not dead[end]:
                    if not out:
                        break
                    pair = (out[-1], token)
                    fits = pairs.get(pair)
                    if fits is None:
                        if len(pairs) > PAIRS:
                            pairs.clear()
                        fits = pairs[pair] = self._fits(*pair)
                    if fits:
                        break
                token = shorter[token]
            if token is None:
                dead[at] = 1
                token = out.pop()
                at -= length[token]
            else:
                out.append(token)
                at = end
                token = longest[at] if at < n else None
        return out


class Pieces(dict):
    """Ids by piece; unknown pieces are encoded when they are asked for, and
    kept unless they are long."""

    def __init__(self, encoder: BacktrackEncoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, piece: str) -> list[int]:
        ids = self.encoder.encode(piece.encode("utf-8"))
        if len(piece) <= LONGEST:
            self[piece] = ids
        return ids


class Codec:
    """Encodes and decodes whole texts with a bounded memory of pieces."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoder, self.splitter = BacktrackEncoder(self.ranks), Splitter(pattern)
        self.names = {t: str(t) for t in self.encoder.bytes}
        self.known = Pieces(self.encoder)

    def encode(self, text: str) -> list[int]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        return list(chain.from_iterable(map(self.known.__getitem__, self.splitter.split(text))))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.encoder.bytes.__getitem__, ids))

    def id_text(self, ids: list[int]) -> str:
        return " ".join(map(self.names.__getitem__, ids))


_CODECS: dict[tuple[str, str], Codec] = {}


def _encode(path: str, pattern: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _CODECS.get((path, pattern)) or _CODECS.setdefault((path, pattern), Codec(path, pattern))

        def flush(rows: list, texts: list[str]) -> pa.RecordBatch:
            coded = [codec.encode(t) for t in texts]
            decoded = [codec.decode(ids) for ids in coded]
            columns = {"id": pa.array(rows, kind), "n_tokens": pa.array(map(len, coded), pa.int64(), size=len(coded)),
                       "ids_sha256": [hashlib.sha256(codec.id_text(ids).encode()).hexdigest() for ids in coded],
                       "decoded_sha256": [hashlib.sha256(d).hexdigest() for d in decoded]}
            if with_ids:
                columns["ids"] = pa.array(coded, pa.list_(pa.int32()))
                columns["decoded"] = pa.array(decoded, pa.binary())
            return pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            kind, rows, texts, held = batch.column("id").type, [], [], 0
            for i, text in zip(batch.column("id"), batch.column("text")):
                rows.append(i.as_py())
                texts.append(text.as_py() or "")
                held += len(texts[-1])
                if held > GROUP_CHARS:
                    yield flush(rows, texts)
                    rows, texts, held = [], [], 0
            if rows:
                yield flush(rows, texts)
    return run


def encode_documents(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, id_col: str = "doc_id",
                     text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Per row: ``id_col``, ``n_tokens``, ``ids_sha256`` (decimal ids joined by
    one blank) and ``decoded_sha256`` (of the decoded bytes); ``with_ids`` adds
    ``ids`` and ``decoded`` (binary).

    ``path`` names a rank file of the tiktoken library that every executor can
    read. Every match of ``pattern`` is encoded by itself, there are no special
    tokens; characters that the pattern does not match have no tokens. Null and
    empty texts have no tokens. Runs of blanks, line ends or letters may have
    any length. Ids are passed through (null, repeated or not), repeated rows
    stay; an empty table gives no rows, other columns are not read.
    """
    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = dict(narrow.dtypes)["id"]
    more = ", ids array<int>, decoded binary" if with_ids else ""
    return (narrow.mapInArrow(_encode(path, pattern, with_ids),
                              f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{more}")
            .withColumnRenamed("id", id_col))
