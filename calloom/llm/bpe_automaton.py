"""BPE encoding and decoding with a tokenization automaton whose arcs follow from the merges.

States are the tokens read last, arcs are labelled with tokens. The automaton starts with the alphabet, where every
symbol may follow every other. Each merge (a, b) -> c, in order, is one gadget: it adds the label c and takes away the
arcs that would leave the boundary a|b unmerged. Written out, the arcs of some 49,000 states would be billions, so no
transition table is compiled. A gadget is kept in factored form: a token has the chain of pieces on its right edge and on
its left edge, each with the rank of the merge that absorbs the piece. An arc x -> y exists unless a gadget (a, b) joins a
piece a of x's right edge with a piece b of y's left edge before either piece is absorbed (on the left, at the same rank
also: of equal merges the leftmost comes first). Arcs that a text asks for are worked out once and kept, up to a bound.

A word's encoding is the one path that spells it. It is looked for from left to right, longest label first, and steps
back where no arc leads on. Encodings of prefixes are unique, so a position is come to by one path at most and is left
for good once: the search is linear in the word.
Decoding emits the labels of the arcs, and needs no more than these.

Spark does the rest: documents stream through Arrow batches, one scan, no shuffle. Only the vocabulary (a file of fixed
size) is broadcast; each Python worker builds the automaton once, and keeps tables of arcs and words of bounded size
for as long as a task lasts.

Defined cases: a null or blank text has no ids and decodes to the empty text; special tokens inside a text are split
off first and become their ids; repeated rows give repeated results; input columns named like the result are replaced.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, types as T

from calloom.llm.common import text_batches

END_OF_WORD = "</w>"
NEVER = 1 << 60
#: Words whose encodings a worker keeps, and arcs that it keeps; beyond that the tables start anew.
KEPT_WORDS = 200_000
KEPT_ARCS = 500_000

# The characters of the White_Space property.
WHITE_SPACE = "\t-\r \x85\xa0  -     　"
#: How the vocabulary's file splits text into words.
WORD_PATTERN = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{WHITE_SPACE}\p{{L}}\p{{N}}]+"
)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: printable Latin-1 for itself, others from 256 upwards."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(others)) for b in range(256)]


class MergeAutomaton:
    """The automaton of one vocabulary; see the module's text."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        self.labels: dict[str, int] = {}  # tokens that some word's encoding can hold
        self.gadgets: dict[tuple[int, int], int] = {}
        self.right: dict[int, tuple[tuple[int, int], ...]] = {}
        self.left: dict[int, tuple[tuple[int, int], ...]] = {}
        self.arcs: dict[int, bool] = {}
        made = {a + b for a, b in merges}
        for symbol, token in vocab.items():
            if symbol not in made:
                self.labels[symbol] = token
                self.right[token] = self.left[token] = ((token, NEVER),)
        for rank, (a, b) in enumerate(merges):
            self._add_gadget(rank, vocab[a], vocab[b], a + b, vocab[a + b])
        self.final = {x.removesuffix(END_OF_WORD): t for x, t in self.labels.items() if x.endswith(END_OF_WORD)}
        self.inner = {x: t for x, t in self.labels.items() if not x.endswith(END_OF_WORD)}
        self.reach: dict[str, int] = {}  # the longest inner label that begins with three symbols
        for label in self.inner:
            self.reach[label[:3]] = max(len(label), self.reach.get(label[:3], 2))

    def _add_gadget(self, rank: int, a: int, b: int, label: str, token: int) -> None:
        known = a in self.right and b in self.left
        if known and label not in self.labels and self._joins(a, b):
            self.labels[label] = token
            self.right[token] = ((token, NEVER), (b, rank), *self.right[b][1:])
            self.left[token] = ((token, NEVER), (a, rank), *self.left[a][1:])
        self.gadgets.setdefault((a, b), rank)

    def _joins(self, x: int, y: int) -> bool:
        gadgets = self.gadgets
        for a, absorbed_a in self.right[x]:
            for b, absorbed_b in self.left[y]:
                rank = gadgets.get((a, b))
                if rank is not None and rank < absorbed_a and rank <= absorbed_b:
                    return False
        return True

    def arc(self, x: int, y: int) -> bool:
        """Whether y may follow x."""
        found = self.arcs.get(x << 32 | y)
        if found is None:
            if len(self.arcs) >= KEPT_ARCS:
                self.arcs.clear()
            found = self.arcs[x << 32 | y] = self._joins(x, y)
        return found

    def encode(self, word: str) -> list[int]:
        """Tokens of one pre-split word, given in byte symbols."""
        n, inner, final, reach, arcs = len(word), self.inner.get, self.final.get, self.reach.get, self.arcs
        path: list[int] = []
        starts, dead = [0], set()
        while True:
            start = starts[-1]
            before = path[-1] << 32 if path else -1
            token = final(word[start:])
            if token is not None and (before < 0 or arcs.get(before | token) or self.arc(path[-1], token)):
                path.append(token)
                return path
            end = min(n - 1, start + reach(word[start : start + 3], 2))
            while True:
                while end > start:
                    token = inner(word[start:end])
                    if token is not None and end not in dead:
                        if before < 0 or arcs.get(before | token) or self.arc(path[-1], token):
                            break
                    end -= 1
                if end > start:
                    break
                # no arc leads on from here; as only one path comes here, none will
                dead.add(start)
                end = starts.pop() - 1
                start = starts[-1]
                path.pop()
                before = path[-1] << 32 if path else -1
            path.append(token)
            starts.append(end)


class WordTable(dict):
    """Encodings of pieces of text without white space, as packed 32-bit ids; fills itself.

    Printable ASCII stands for itself among the byte symbols; other ASCII never comes here but in words of symbols.
    """

    def __init__(self, automaton: MergeAutomaton):
        super().__init__()
        self.automaton = automaton
        self.symbols = byte_symbols()
        self.older: dict[str, bytes] = {}  # the table before this one: what is still in use comes back from it

    def __missing__(self, piece: str) -> bytes:
        packed = self.older.get(piece)
        if packed is None:
            words = [piece] if piece.isascii() and piece.isalpha() else WORD_PATTERN.findall(piece)
            if len(words) == 1:
                plain = piece.isascii() and piece.isprintable()
                symbols = piece if plain else "".join([self.symbols[b] for b in piece.encode()])
                packed = array("i", self.automaton.encode(symbols)).tobytes()
            else:  # a word is the same piece with and without what stands beside it
                packed = b"".join([self[word] for word in words])
        if len(self) >= KEPT_WORDS:
            self.older = dict(self)
            self.clear()
        self[piece] = packed
        return packed

    def forget(self) -> None:
        """Give up what was learnt from texts."""
        self.clear()
        self.older.clear()
        self.automaton.arcs.clear()


def labels_by_id(source: str) -> list[str]:
    """The labels of a tokenizer file's JSON text by id; the empty one where there is none."""
    spec = json.loads(source)
    labels = {token: label for label, token in spec["model"]["vocab"].items()}
    labels |= {t["id"]: t["content"] for t in spec["added_tokens"]}
    return [labels.get(token, "") for token in range(max(labels) + 1)]


class Tokenizer:
    """Encodes and decodes whole texts with the vocabulary in a tokenizer file's JSON text."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model = spec["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.table = WordTable(MergeAutomaton(model["vocab"], merges))
        self.special = {t["content"]: np.array([t["id"]], np.int32).tobytes() for t in spec["added_tokens"]}
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        by_id = labels_by_id(source)
        self.labels = {token: label for token, label in enumerate(by_id) if label}
        self.by_id = pa.array(by_id, pa.string())

    def packed(self, text: str) -> bytes:
        """The ids of a text as packed 32-bit numbers."""
        if self.split is None or "<" not in text:
            return self._plain(text)
        parts = self.split.split(text)
        return b"".join(self.special[part] if part in self.special else self._plain(part) for part in parts)

    def _plain(self, text: str) -> bytes:
        if not text.isascii():
            # each character by itself: no rule for a sigma at the end of a word
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        # the four separators are white space to Python alone; they stay in their word
        pieces = regex.split(f"[{WHITE_SPACE}]+", text) if regex.search("[\x1c-\x1f]", text) else text.split()
        return b"".join(map(self.table.__getitem__, pieces))

    def decode(self, ids: list[int]) -> str:
        """The labels of the ids, separated by spaces; the file names no decoder."""
        return " ".join(map(self.labels.__getitem__, ids))


_tokenizers: dict[int, Tokenizer] = {}


def _tokenizer(source: str) -> Tokenizer:
    """One compiled tokenizer per worker process and vocabulary."""
    key = hash(source)
    if key not in _tokenizers:
        _tokenizers.clear()
        _tokenizers[key] = Tokenizer(source)
    return _tokenizers[key]


def _read(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def _encoded(tokenizer: Tokenizer, texts: list[str]) -> pa.ListArray:
    packed = [tokenizer.packed(t) for t in texts]
    offsets = np.zeros(len(packed) + 1, np.int32)
    np.cumsum([len(p) // 4 for p in packed], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), np.int32)))


def _decoded(rows: pa.ListArray, labels: pa.Array) -> pa.Array:
    lists = pa.ListArray.from_arrays(rows.offsets, labels.take(rows.values))
    return pc.if_else(pc.is_valid(rows), pc.binary_join(lists, " "), "")


def encode(docs: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Adds the ids of each whole text as an array of int; ``path`` is the vocabulary's file on the driver."""
    docs = docs.drop(out)
    source = docs.sparkSession.sparkContext.broadcast(_read(path))
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(source.value)
        try:
            for batch, texts in text_batches(batches, text):
                yield pa.RecordBatch.from_arrays([*batch.columns, _encoded(tokenizer, texts)], names=[*batch.schema.names, out])
        finally:
            tokenizer.table.forget()

    return docs.mapInArrow(run, schema)


def decode(frame: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds the text that the ids of each row decode to; null ids as none."""
    frame = frame.drop(out)
    known = frame.sparkSession.sparkContext.broadcast(labels_by_id(_read(path)))
    schema = T.StructType([*frame.schema.fields, T.StructField(out, T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels = pa.array(known.value, pa.string())
        for batch in batches:
            texts = _decoded(batch.column(ids), labels)
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, out])

    return frame.mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """The ids of each whole text, and the text they decode to, in place of the text: ``encode`` and ``decode`` in one stage.

    A task so has one Python worker in place of two, and neither the text nor the ids travel a second time.
    """
    docs = docs.drop(*{ids, decoded} - {text})
    kept = [f for f in docs.schema.fields if f.name != text]
    source = docs.sparkSession.sparkContext.broadcast(_read(path))
    made = [T.StructField(ids, T.ArrayType(T.IntegerType(), False), False), T.StructField(decoded, T.StringType(), False)]
    schema = T.StructType([*kept, *made])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(source.value)
        try:
            for batch, texts in text_batches(batches, text):
                coded = _encoded(tokenizer, texts)
                columns = [*(batch.column(f.name) for f in kept), coded, _decoded(coded, tokenizer.by_id)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
        finally:
            tokenizer.table.forget()

    return docs.mapInArrow(run, schema)
