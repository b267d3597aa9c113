"""Byte-level BPE by a tokenization automaton.

``Automaton`` reads the merges in order and applies one merge gadget per merge
to a deterministic automaton whose arcs are labelled with tokens. It starts as
one state with a loop for every byte. The gadget for (a, b) -> ab

* adds an arc ab beside every arc a, leading where b led after a,
* and takes the arc b out of the state behind a.

All arcs with one label lead to one state, so a state is named by the label
that leads to it. The states are kept copy-on-write: a gadget stores only
which state and arc the new ones were copied from, and which arc went when;
``has_arc`` follows the copies back. Every byte string has exactly one path:
its BPE encoding. To read bytes, the automaton is made deterministic over them:
a byte state is the arc that ends here with all arcs begun and not yet ended,
and ``table`` keeps each (byte state, byte) once it has been worked out.
``encode_word`` is a walk through that table; decoding emits the labels.

Defined cases: a null text is the empty text (no ids, decoded as the empty
string); a repeated row gives a repeated result row; an empty table an empty
result; other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.common import table, text_or_empty

TOKENIZER = "byte_bpe_50k.json"
#: Fixed value: the public pattern that splits text before byte-level merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words of one generation: a worker remembers this and the one before, so frequent words stay.
WORD_MEMORY = 120_000
#: Table entries a worker remembers; the table starts anew beyond them.
TABLE_MEMORY = 450_000
#: Documents of one output batch.
BATCH = 256


def byte_letters() -> list[str]:
    """The letter by which byte-level vocabularies write each byte: printable
    Latin-1 as itself, the others from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


def token_bytes(model: dict, special: dict[str, int] | None = None) -> list[bytes]:
    """The bytes of every token, by its id: all that decoding needs."""
    byte_of = {c: b for b, c in enumerate(byte_letters())}
    vocab: dict[str, int] = model["vocab"]
    labels = [b""] * (max([*vocab.values(), *(special or {}).values()], default=-1) + 1)
    for text, t in vocab.items():
        labels[t] = bytes(byte_of[c] for c in text) if all(c in byte_of for c in text) else text.encode()
    for text, t in (special or {}).items():
        labels[t] = text.encode()
    return labels


def decoded(labels: list[bytes], ids: np.ndarray) -> str:
    return b"".join(map(labels.__getitem__, ids.tolist())).decode("utf-8", "replace")


class Automaton:
    def __init__(self, model: dict, special: dict[str, int] | None = None):
        vocab: dict[str, int] = model["vocab"]
        letters = byte_letters()
        size = max([*vocab.values(), *(special or {}).values()], default=-1) + 1
        self.born = [-1] * size
        self.left = [-1] * size
        self.right = [-1] * size
        self.gone: dict[tuple[int, int], int] = {}
        reached = {vocab[c] for c in letters if c in vocab}
        for step, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self._gadget(step, vocab[a], vocab[b], vocab[a + b], reached)
        self.forever = len(model["merges"])
        self.labels = token_bytes(model, special)
        self.trie: list[dict[int, int]] = [{}]
        self.token_at = [-1]
        for t in vocab.values():
            if t in reached:
                node = 0
                for c in self.labels[t]:
                    if c not in self.trie[node]:
                        self.trie[node][c] = len(self.trie)
                        self.trie.append({})
                        self.token_at.append(-1)
                    node = self.trie[node][c]
                self.token_at[node] = t
        self.sizes = list(map(len, self.labels))
        self._restart()

    def _gadget(self, step: int, a: int, b: int, ab: int, reached: set[int]) -> None:
        if a not in reached or b not in reached or not self.has_arc(a, b, step):
            return  # no path reads b after a: nothing to replace
        self.gone[a, b] = step
        if ab in reached:
            return
        reached.add(ab)
        self.born[ab], self.left[ab], self.right[ab] = step, a, b
        if a == b:  # a run of a is paired from its start, so a single a comes last
            self.gone[a, ab] = step

    def has_arc(self, state: int, label: int, now: int) -> bool:
        """Whether the state behind ``state`` has an arc ``label`` before gadget ``now``."""
        born = self.born
        while True:
            if self.gone.get((state, label), now) < now:
                return False
            s, t = born[state], born[label]
            if s == t == -1:
                return True
            if s >= t:
                now, state, label = s, self.right[state], (self.left[label] if s == t else label)
            else:
                now, label = t, self.left[label]

    def _restart(self) -> None:
        self.table: dict[int, int] = {}
        self.states: dict[tuple, int] = {((-1, 0),): 0}
        self.open: list[tuple] = [((-1, 0),)]
        self.ends: list[int] = [-1]

    def _transition(self, state: int, byte: int) -> int:
        """The byte state after ``byte``. An open arc is (the arc before it, its trie node)."""
        trie, token_at = self.trie, self.token_at
        still, token = [], -1
        for before, node in self.open[state]:
            to = trie[node].get(byte)
            if to is None:
                continue
            if trie[to]:
                still.append((before, to))
            t = token_at[to]
            if token < 0 <= t and (before < 0 or self.has_arc(before, t, self.forever)):
                token = t
        if token < 0:
            raise ValueError("the vocabulary lacks a byte")
        key = (*still, (token, 0))
        to = self.states.get(key)
        if to is None:
            to = self.states[key] = len(self.open)
            self.open.append(key)
            self.ends.append(token)
        self.table[state << 8 | byte] = to
        return to

    def encode_word(self, word: bytes) -> list[int]:
        """Tokens of the bytes of one pre-split word."""
        if len(self.table) > TABLE_MEMORY:
            self._restart()
        look, ends, sizes = self.table.get, self.ends, self.sizes
        state, path = 0, []
        for byte in word:
            to = look(state << 8 | byte)
            if to is None:
                to = self._transition(state, byte)
            path.append(to)
            state = to
        n, out = len(word), []
        while n:
            token = ends[path[n - 1]]
            out.append(token)
            n -= sizes[token]
        return out[::-1]


class Codec:
    """Whole texts to ids and back, with the special strings of the file."""

    def __init__(self, spec: bytes):
        import regex
        conf = json.loads(spec)
        special = {x["content"]: x["id"] for x in conf["added_tokens"]}
        self.automaton = Automaton(conf["model"], special)
        self.special = special
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")")
        self.pre = regex.compile(PATTERN)
        self.memory: dict[str, bytes] = {}  # word -> its ids as int32
        self.older: dict[str, bytes] = {}

    def _words(self, text: str) -> bytes:
        memory = self.memory
        words = self.pre.findall(text)
        found = list(map(memory.get, words))
        if None in found:
            new = {w for w, ids in zip(words, found, strict=True) if ids is None}
            if len(memory) + len(new) > WORD_MEMORY:
                self.older, self.memory = memory, {}
                memory, new = self.memory, set(words)
            before = self.older.get
            for w in new:
                memory[w] = before(w) or array("i", self.automaton.encode_word(w.encode())).tobytes()
            found = map(memory.__getitem__, words)
        return b"".join(found)

    def encode(self, text: str) -> np.ndarray:
        """Ids of ``text`` as int32."""
        if any(s in text for s in self.special):
            parts = [np.int32(self.special[p]).tobytes() if p in self.special else self._words(p)
                     for p in self.cut.split(text)]
            return np.frombuffer(b"".join(parts), np.int32)
        return np.frombuffer(self._words(text), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        return decoded(self.automaton.labels, ids)


_CODECS: dict[str, Codec] = {}
_LABELS: dict[str, list[bytes]] = {}


def _codec(spec: bytes) -> Codec:
    """The compiled automaton, once in a worker process."""
    key = hashlib.sha256(spec).hexdigest()
    if key not in _CODECS:
        _CODECS[key] = Codec(spec)
    return _CODECS[key]


def _labels(spec: bytes) -> list[bytes]:
    """The tokens' bytes, once in a worker process: workers that decode build no automaton."""
    key = hashlib.sha256(spec).hexdigest()
    if key not in _LABELS:
        conf = json.loads(spec)
        _LABELS[key] = token_bytes(conf["model"], {x["content"]: x["id"] for x in conf["added_tokens"]})
    return _LABELS[key]


def _spec(spark: SparkSession, path: str):
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())  # one vocabulary file, a few MB


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``ids`` (array<int>) of every row of ``docs``."""
    spec = _spec(docs.sparkSession, tokenizer_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(spec.value)
        for batch in batches:
            for k in range(0, batch.num_rows, BATCH):
                part = batch.slice(k, BATCH)
                ids = [codec.encode(t) for t in part.column(1).to_pylist()]
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], [id_col, "ids"])

    src = docs.select(F.col(id_col), text_or_empty(text_col).alias("content"))
    return src.mapInArrow(run, f"`{id_col}` {src.schema[id_col].dataType.simpleString()}, ids array<int>")


def decode(coded: DataFrame, tokenizer_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``coded`` with the text of its ids as a last column."""
    spec = _spec(coded.sparkSession, tokenizer_path)
    at = coded.columns.index(ids_col)
    schema = T.StructType([*coded.schema.fields, T.StructField(out_col, T.StringType())])
    names = coded.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels = _labels(spec.value)
        for batch in batches:
            for k in range(0, batch.num_rows, BATCH):
                part = batch.slice(k, BATCH)
                lists = part.column(at)
                ids, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
                texts = [decoded(labels, ids[i:j]) if ok else None
                         for i, j, ok in zip(ends, ends[1:], lists.is_valid().to_pylist(), strict=False)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*names, out_col])

    return coded.mapInArrow(run, schema)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes and decodes all documents; the digests of ids and decoded text."""
    import public_tokenizers
    path = public_tokenizers.path(TOKENIZER)
    coded = decode(encode(table(spark, sf_dir, "documents"), path), path)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
