"""BPE encoding by a trie of distinct words.

A word's symbols go into a trie; every node stores the last token of the
encoding of its prefix, so a prefix shared by many words is encoded once. The
last token at a node is the one suffix of the path that is a token and whose
left neighbour (the last token of the node where the suffix begins) does not
merge into it: BPE encodings are built from left to right by such pairwise
compatible tokens, which makes the choice unique. Encodings are read back from
the leaves. A word's final symbol carries the end-of-word suffix and is a
symbol of its own, so leaves never serve as prefixes.

Normalising and splitting into words follow the file: for Latin-1 texts by an
equal pattern over the whole text, for others by the tokenizers library, once
per distinct blank-separated chunk. Each Python worker keeps the words it has
encoded in a table of bounded size; texts are never shuffled.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Words (and chunks) a worker remembers before it forgets those not in use, and the longest chunk it keeps.
REMEMBERED, LONGEST = 600_000, 256
#: A longer word shares no prefix worth a trie node per symbol; it is encoded along its own path.
TRIE_SYMBOLS = 10_000


class TrieEncoder:
    """Encoder of word pieces for a BPE vocabulary file of the tokenizers
    library whose symbols are all in the vocabulary (byte-level)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.text = {i: s for s, i in self.vocab.items()}
        self.end = model.get("end_of_word_suffix") or ""
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.born: dict[int, int] = {}
        for r, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ", 1)
            left, right, whole = self.vocab[a], self.vocab[b], self.vocab[a + b]
            self.rank.setdefault((left, right), r)
            if whole not in self.parts:
                self.parts[whole], self.born[whole] = (left, right), r
        self.apart: dict[tuple[int, int], bool] = {}
        self.spines: dict[tuple[int, int], list[tuple[int, float]]] = {}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self.text.update({i: s for s, i in self.special.items()})
        # A vocabulary entry is a usable token if its own merge keeps its halves' boundary until then.
        self.usable = {t for t in self.vocab.values()
                       if t not in self.parts or self._compatible(*self.parts[t], before=self.born[t])}
        plain = {self.text[t]: t for t in self.usable}
        self.inner = {s: t for s, t in plain.items() if not self.end or not s.endswith(self.end)}
        self.final = {s[:-len(self.end)]: t for s, t in plain.items() if s.endswith(self.end)} if self.end else plain
        self.longest = max(map(len, plain), default=1)

    def _spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """Tokens along one edge of ``token``, from its outermost symbol to
        itself, each with the rank of the merge that consumes it."""
        if (token, side) not in self.spines:
            out, rank = [], float("inf")
            while True:
                out.append((token, rank))
                if token not in self.parts:
                    break
                rank, token = self.born[token], self.parts[token][side]
            self.spines[(out[0][0], side)] = out[::-1]
            return out[::-1]
        return self.spines[(token, side)]

    def _compatible(self, left: int, right: int, before: float = float("inf")) -> bool:
        """Whether BPE on the symbols of ``left`` then ``right`` ends with these
        two tokens (or keeps them apart up to the merge of rank ``before``)."""
        a, b = self._spine(left, 1), self._spine(right, 0)
        i = j = 0
        while True:
            (x, x_end), (y, y_end) = a[i], b[j]
            r = self.rank.get((x, y))
            # Of equal merges the leftmost goes first: one inside `left` comes before ours, one inside `right` after.
            if r is not None and r < before and r < x_end and r <= y_end:
                return False
            if x_end == y_end == float("inf"):
                return True
            if x_end <= y_end:
                i += 1
            else:
                j += 1

    def compatible(self, left: int, right: int) -> bool:
        known = self.apart.get((left, right))
        if known is None:
            known = self.apart[(left, right)] = self._compatible(left, right)
        return known

    def encode_words(self, words) -> dict[str, list[int]]:
        """Token ids of each distinct word of symbols (no special tokens)."""
        trie: dict = {}
        long = [w for w in words if len(w) > TRIE_SYMBOLS]
        for word in words:
            if len(word) > TRIE_SYMBOLS:
                continue
            node = trie
            for symbol in word[:-1]:
                below = node.get(symbol)
                if below is None:
                    below = node[symbol] = {}
                node = below
            node["\n" + word[-1]] = word  # a final symbol is one of its own; no symbol is a line end
        out: dict[str, list[int]] = {w: self._along(w) for w in long}
        # Depth-first; last[d] and length[d] are the state of the path's prefix of d + 1 symbols,
        # overwritten when another branch comes to that depth.
        deepest = min(max(map(len, words), default=0), TRIE_SYMBOLS)
        last, length = [0] * deepest, [0] * deepest
        inner, final, longest, apart = self.inner, self.final, self.longest, self.apart
        stack: list[tuple[int, str, dict | str]] = [(0, s, n) for s, n in trie.items()]
        while stack:
            depth, prefix, below = stack.pop()
            known = inner
            if type(below) is str:
                prefix, known = prefix[:-2] + prefix[-1], final
            for size in range(1, min(depth + 1, longest) + 1):
                token = known.get(prefix[-size:])
                if token is not None:
                    if size > depth:
                        break
                    pair = (last[depth - size], token)
                    fits = apart.get(pair)
                    if fits is None:
                        fits = apart[pair] = self._compatible(*pair)
                    if fits:
                        break
            else:
                raise ValueError(f"no token for {prefix!r}")
            last[depth], length[depth] = token, size
            if type(below) is str:
                out[below] = _read_back(last, length, depth)
            else:
                depth += 1
                if depth > longest:  # what lies further back is never looked up
                    prefix = prefix[-longest:]
                for symbol, node in below.items():
                    stack.append((depth, prefix + symbol, node))
        return out

    def _along(self, word: str) -> list[int]:
        """``encode_words`` for one word too long for the trie: its one path, state by state."""
        n, longest, apart = len(word), self.longest, self.apart
        last, length = [0] * n, [0] * n
        for depth in range(n):
            known = self.final if depth == n - 1 else self.inner
            for size in range(1, min(depth + 1, longest) + 1):
                token = known.get(word[depth + 1 - size:depth + 1])
                if token is not None:
                    if size > depth:
                        break
                    pair = (last[depth - size], token)
                    fits = apart.get(pair)
                    if fits is None:
                        fits = apart[pair] = self._compatible(*pair)
                    if fits:
                        break
            else:
                raise ValueError(f"no token for {word[:depth + 1][-80:]!r}")
            last[depth], length[depth] = token, size
        return _read_back(last, length, n - 1)


def _read_back(last: list[int], length: list[int], at: int) -> list[int]:
    """The tokens that end at symbol ``at``, first to last."""
    ids = []
    while at >= 0:
        ids.append(last[at])
        at -= length[at]
    ids.reverse()
    return ids


#: Texts of Latin-1 characters without other white space or control codes: once in lower case, the pattern
#: below finds the pieces that the library's normaliser and the file's own pattern find.
LATIN = re.compile("[\t\n\r -~\xa1-\xff]*")
PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]"
                    "|[^\t\n\r a-z0-9\xaa\xb2\xb3\xb5\xb9\xba\xbc-\xbe\xdf-\xf6\xf8-\xff]+")
#: The split the file must ask for if that pattern is to stand in for it (fixed value of the vocabulary file).
FILE_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


#: (ids as text, number of ids, tokens as text)
Entry = tuple[str, int, str]


class ChunkCoder:
    """Encodes whole texts with a bounded memory of words. Texts in Latin-1 are
    cut into words here, others by the library, one blank-separated chunk at a
    time; chunks are remembered too."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        whole = Tokenizer.from_file(path)
        self.normal, self.pieces = whole.normalizer, whole.pre_tokenizer
        self.encoder = TrieEncoder(path)
        self.words: dict[str, Entry] = {}  # by the library's spelling of a word's bytes
        self.plain: dict[str, Entry] = {}  # by the word as it stands in a Latin-1 text
        self.known: dict[str, Entry] = {}  # by chunk
        names = sorted(self.encoder.special, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.latin = FILE_SPLIT in json.dumps(json.loads(whole.to_str()), ensure_ascii=False).replace("\\\\", "\\")
        # how the library writes the bytes of each accented letter
        self.spelled = {c: "".join(p for p, _ in self.pieces.pre_tokenize_str(chr(c))) for c in range(0xA1, 0x100)}

    def _learn_words(self, spelled: set[str]) -> None:
        text = self.encoder.text
        for p, ids in self.encoder.encode_words(spelled - self.words.keys()).items():
            self.words[p] = (" ".join(map(str, ids)), len(ids), " ".join([text[i] for i in ids]))

    def learn(self, plain: set[str], chunks: set[str]) -> dict[str, Entry]:
        """Encodes unknown words and chunks; returns the chunks too long to keep."""
        if len(self.words) > REMEMBERED:
            self.words = {}
        cut: dict[str, list[str]] = {}
        for c in chunks:
            normal = self.normal.normalize_str(c) if self.normal else c
            cut[c] = [p for p, _ in self.pieces.pre_tokenize_str(normal) if p]
        spelled = {w: w if w.isascii() else w.translate(self.spelled) for w in plain}
        self._learn_words({*spelled.values(), *(p for ps in cut.values() for p in ps)})
        words, long = self.words, {}
        for w, p in spelled.items():
            self.plain[w] = words[p]
        for c, ps in cut.items():
            parts = [words[p] for p in ps]
            (self.known if len(c) <= LONGEST else long)[c] = joined(parts)
        return long

    def split(self, text: str) -> list[tuple[str, bool]]:
        """(part, is special token) in order."""
        if self.special is None or "<" not in text:
            return [(text, False)]
        parts = self.special.split(text)
        return [(p, bool(k % 2)) for k, p in enumerate(parts) if p]

    def encode_batch(self, texts: list[str]) -> list[Entry]:
        """An entry per text."""
        split, plain, chunks = [], set(), set()
        for text in texts:
            doc = []
            for part, special in self.split(text):
                if special:
                    doc.append((None, part))
                elif self.latin and LATIN.fullmatch(part):
                    found = PIECES.findall(part.lower())
                    doc.append((True, found))
                    plain.update(found)
                else:
                    found = [c for c in part.replace("\n", " ").split(" ") if c]
                    doc.append((False, found))
                    chunks.update(found)
            split.append(doc)
        # forget what these texts don't use
        if len(self.plain) > REMEMBERED:
            self.plain = {w: self.plain[w] for w in plain if w in self.plain}
        if len(self.known) > REMEMBERED:
            self.known = {c: self.known[c] for c in chunks if c in self.known}
        long = self.learn(plain - self.plain.keys(), chunks - self.known.keys())
        out = []
        for doc in split:
            got: list[Entry] = []
            for kind, found in doc:
                if kind is None:
                    got.append((str(self.encoder.special[found]), 1, found))
                elif kind:
                    got += map(self.plain.__getitem__, found)
                else:
                    got += [self.known[c] if c in self.known else long[c] for c in found]
            out.append(joined(got))
        return out


def joined(entries: list[Entry]) -> Entry:
    if len(entries) == 1:
        return entries[0]
    some = [e for e in entries if e[1]]
    return " ".join([e[0] for e in some]), sum([e[1] for e in some]), " ".join([e[2] for e in some])


def decode(encoder: TrieEncoder, ids: list[int]) -> str:
    """The library's decoding without a decoder set: token strings joined by a blank."""
    return " ".join(encoder.text[i] for i in ids)


_CODERS: dict[str, ChunkCoder] = {}
#: Texts encoded together, by characters: bounds what a task holds beside its batch.
GROUP_CHARS = 2_000_000


def _encode(path: str, with_ids: bool):
    def sha(s: str) -> str:
        return hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _CODERS.get(path) or _CODERS.setdefault(path, ChunkCoder(path))

        def flush(rows: list, texts: list[str]) -> pa.RecordBatch:
            coded = coder.encode_batch(texts)
            columns = {"id": pa.array(rows, kind), "n_tokens": pa.array([c[1] for c in coded], pa.int64()),
                       "ids_sha256": [sha(c[0]) for c in coded], "decoded_sha256": [sha(c[2]) for c in coded]}
            if with_ids:
                columns["ids"] = pa.array([[int(i) for i in c[0].split()] for c in coded], pa.list_(pa.int32()))
                columns["decoded"] = pa.array([c[2] for c in coded], pa.string())
            return pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            kind, rows, texts, held = batch.column("id").type, [], [], 0
            for i, text in zip(batch.column("id"), batch.column("_text")):
                rows.append(i.as_py())
                texts.append(text.as_py() or "")
                held += len(texts[-1])
                if held > GROUP_CHARS:
                    yield flush(rows, texts)
                    rows, texts, held = [], [], 0
            if rows:
                yield flush(rows, texts)
    return run


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                     with_ids: bool = False) -> DataFrame:
    """Per row: ``id_col``, ``n_tokens``, ``ids_sha256`` (decimal ids joined by
    one blank) and ``decoded_sha256``; ``with_ids`` adds ``ids`` and ``decoded``.

    ``path`` names a BPE file of the tokenizers library that every executor
    can read. Special tokens in a text become their ids, as in the library.
    Null and empty texts have no tokens; ids are passed through (null, repeated
    or not); an empty table gives no rows, other columns are not read.
    """
    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("_text"))
    kind = dict(narrow.dtypes)["id"]
    more = ", ids array<int>, decoded string" if with_ids else ""
    return (narrow.mapInArrow(_encode(path, with_ids),
                              f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{more}")
            .withColumnRenamed("id", id_col))
